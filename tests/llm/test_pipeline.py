import random

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_decontaminate import brute as hits
from test_pii import _docs, slow_base
from test_quality import slow_stats
from test_simhash import slow_components

from eventlens.llm import pii, quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    rng = random.Random(12)
    rows = [(i, t + " " + " ".join(f"v{rng.randint(0, 99999)}é" for _ in range(40))) for i, t, _, _ in _docs(240, seed=4)]
    junk = [(1000 + i, " ".join(f"{rng.choice('abc')}{rng.randint(0, 999)}***$$" for _ in range(50))) for i in range(60)]
    bench = [(i, " ".join(f"b{rng.randint(0, 9999)}" for _ in range(15))) for i in range(5)]
    leaked = [(2000 + i, rows[i][1].upper() + " x" + str(i) + " " + bench[i][1] + " and " + " ".join(f"u{rng.randint(0, 9999)}" for _ in range(30))) for i in range(5)]
    copies = [(3000 + i, rows[i % 7][1]) for i in range(21)]
    near = [(3100 + i, rows[i][1] + " more") for i in range(10)]
    edge = [(4000, None), (4001, ""), (None, rows[9][1] + " " + "alone " * 3), (5, rows[5][1]), (4002, "word%d " % 1 * 2000)]
    docs = [(i, t, "xx", "s", None if t is None else len(t)) for i, t in rows + junk + leaked + copies + near + edge]
    rng.shuffle(docs)
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    labels = [(i, 1, 0) for i, _ in rows[:150]] + [(i, 0, 0) for i, _ in junk[:40]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, docs, bench, junk


def test_every_stage_against_brute_force(spark, corpus):
    d, rows, bench, junk = corpus
    docs = spark.read.parquet(f"{d}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "pii", "best_fit_packing"]
    table = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)

    rules = quality.learn(docs, spark.read.parquet(f"{d}/labels.parquet"))
    junk_ids = {i for i, _ in junk}
    want = []
    for r in rows:
        n, _, _, _, repeats, _ = slow_stats(r[1])
        if n >= 20 and 100 * repeats <= 30 * n and r[0] not in junk_ids:
            want.append(r)
    one = corpus_pipeline.common.materialise(stages["quality_rules"](spark, docs, d), "t1")
    assert rules and one.columns == COLUMNS and table(one) == sorted(want, key=repr)

    two = corpus_pipeline.common.materialise(stages["simhash_near_dedup"](spark, one, d), "t2")
    # the row without an id counts last: it stays only where it is alone
    named = slow_components([(10**9 if r[0] is None else r[0], r[1]) for r in want])
    want = [r for r in want if named[10**9 if r[0] is None else r[0]][1] == (10**9 if r[0] is None else r[0])]
    assert two.columns == COLUMNS and table(two) == sorted(set(want), key=repr)

    three = corpus_pipeline.common.materialise(stages["benchmark_decontamination"](spark, two, d), "t3")
    bad = {i for i, _, n, _ in hits([(r[0], r[1]) for r in two.collect()], bench, 10) if n}
    assert len(bad) == 5
    assert three.columns == COLUMNS and table(three) == sorted((tuple(r) for r in two.collect() if repr(r[0]) not in bad), key=repr)

    four = corpus_pipeline.common.materialise(stages["pii"](spark, three, d), "t4")
    tagger = pii.train(three)
    want = []
    for r in three.collect():
        spans = pii.find(tagger, [r.text])[0][1]
        assert set(slow_base(r.text)) <= set(spans)
        t = pii.masked(r.text, spans)
        want.append((r.doc_id, t, r.lang, r.source, len(t)))
    assert four.columns == COLUMNS and table(four) == sorted(want, key=repr)
    assert not any(slow_base(t) for _, t, *_ in want)

    five = stages["best_fit_packing"](spark, four, d).collect()
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = {r.doc_id: len(t.encode(r.text, add_special_tokens=False).ids) + 1 for r in four.collect()}
    got = {}
    for r in five:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == total
    assert len({r.sequence_id for r in five}) <= -(-sum(total.values()) // 2048) + 1
    assert table(corpus_pipeline.run(spark, d)) == sorted(map(tuple, five), key=repr)


def test_null_and_shared_ids_keep_a_row_of_each_component(spark):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randint(0, 99999)}" for _ in range(60)) for _ in range(30)]
    ids = [None] * 12 + [7] * 8 + list(range(100, 110))
    rows = list(zip(ids, texts))
    # copies: of a null id under an id, of null ids under null, of a shared id under a larger one, a whole row again
    rows += [(500, texts[0]), (None, texts[1]), (600, texts[13]), rows[25], (None, texts[26])]
    assert len({c for _, c in slow_components(list(enumerate(texts))).values()}) == 30
    df = spark.createDataFrame([(i, t, "xx", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, df, "").collect()), key=repr)
    assert got == sorted([(500, texts[0]), *zip(ids[1:], texts[1:])], key=repr)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_on_the_driver_tables(spark):
    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf).collect()
    n = duckdb.sql(f"SELECT count(*) FROM read_parquet('{sf}/documents.parquet')").fetchall()[0][0]
    ids = {r.doc_id for r in out}
    assert 0.5 * n < len(ids) < n


def test_columns_of_any_name_and_type_pass_every_stage_unchanged(spark, tmp_path):
    rng = random.Random(2)
    body = lambda: " ".join(f"w{rng.randint(0, 9999)}é" for _ in range(40))
    texts = [body() for _ in range(12)]
    texts += [texts[0], texts[1] + " " + "0" * 5000 + ".1.1.1", body() + " a@bc.de", body() + " +1 415 555 0100 x"]
    rows = [(None if i == 3 else i, t, "k1", "k2", 7, "dotted", {"m": i}, [i], b"x", "r", 0) for i, t in enumerate(texts)]
    rows += [rows[3]] * 20 + [rows[5]] * 5
    names = "doc_id long, text string, __h1 string, __id string, row long, `a.b` string, extra map<string,int>, h1 array<int>, none binary, id string, rank int"
    df = spark.createDataFrame(rows, names)
    d = str(tmp_path)
    spark.createDataFrame([(1, "never " * 12)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(8)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.common.materialise(stage(spark, df, d), f"any-{name}")
        assert out.schema.names == df.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
        got = out.collect()
        assert len(got) >= 12
        for r in got:
            own = [x for x in rows if x[0] == r.doc_id]
            assert any(tuple(r)[2:] == x[2:] for x in own), name
        if name == "simhash_near_dedup":
            assert sorted(r.doc_id is None for r in got).count(True) == 1 and len(got) <= len(texts)
            again = stage(spark, df.repartition(5), d).collect()
            assert sorted(map(repr, again)) == sorted(map(repr, got))
    packed = dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, df, d)
    assert packed.select("doc_id", "start").count() >= len(rows)
