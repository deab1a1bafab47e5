import math
import random
import zlib
from collections import Counter

import numpy as np

from eventlens.llm import langid, queries

SCHEMA = "doc_id long, text string, lang string, score string, rejected string"


def test_counts_are_those_of_the_texts():
    texts = ["Ab, ab!", None, "", "123", "é", "a  b\n\nc", "xyz" * 50]

    def slow(t):
        import re
        t = re.sub(r"[\W\d_]+", " ", (t or "").lower() + "\n")
        return sum(1 for n in (1, 2, 3) for i in range(len(t) - n + 1) if t[i] != " " or t[i + n - 1] != " ")
    got = langid.ngram_counts(texts)
    assert got.sum(axis=1).tolist() == [slow(t) for t in texts]
    for t, row in zip(texts, got):  # a text's row does not depend on its neighbours
        assert (langid.ngram_counts([t])[0] == row).all()


def test_slices_add_up(monkeypatch):
    t = "some words here " * 40
    whole = langid.ngram_counts([t])[0]
    monkeypatch.setattr(langid, "SLICE", 100)
    cut = langid.ngram_counts([t, "b"])[0]
    assert 0 <= np.abs(whole - cut).sum() < 60


def _docs(n):
    rng = random.Random(6)
    syllables = {"aa": "the ing and tion er".split(), "bb": "que eau les ment oi".split(), "cc": "sch ung der eit ü".split()}
    rows = []
    for i in range(n):
        lang = rng.choice(list(syllables))
        text = " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(8, 80)))
        rows.append((i, text, lang))
    return rows


def test_held_out_accuracy_and_edges(spark):
    rows = [(i, t, lang, "s", "r") for i, t, lang in _docs(400)]
    rows += [(500, None, "aa", None, None), (501, "12 !", None, None, None), (None, "the ing and", None, None, None), (1, rows[1][1], None, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    train = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5]
    model = langid.train(spark.createDataFrame(train, SCHEMA), sample=80)
    assert model.languages == ["aa", "bb", "cc"]
    got = {(r.doc_id, i): r for i, r in enumerate(langid.identify(df, model).collect())}
    truth = {r[0]: r[2] for r in rows[:400]}
    hits = Counter(r.lang_pred == truth[r.doc_id] for r in got.values() if r.doc_id is not None and r.doc_id < 400)
    assert hits[True] >= 0.99 * sum(hits.values())
    by_id = {r.doc_id: r for r in got.values()}
    assert [by_id[500].lang_pred, by_id[501].lang_pred, by_id[None].lang_pred] == ["und", "und", "aa"]
    assert by_id[500].score == 0 and all(0 <= r.score <= 1 for r in got.values()) and len(got) == len(rows)
    again = langid.identify(df.repartition(3), langid.train(spark.createDataFrame(train[::-1], SCHEMA), sample=80)).collect()
    assert {(r.doc_id, r.lang_pred, round(r.score, 4)) for r in again} == {(r.doc_id, r.lang_pred, round(r.score, 4)) for r in got.values()}


def test_foreign_text_is_rejected(spark):
    rows = [(i, t, lang, "", "") for i, t, lang in _docs(150)]
    model = langid.train(spark.createDataFrame(rows, SCHEMA))
    df = spark.createDataFrame([(1, "жщюя " * 30, None, None, None), (2, rows[0][1], None, None, None)], SCHEMA)
    assert {r.doc_id: r.rejected for r in langid.identify(df, model).collect()} == {1: True, 2: False}


def test_nothing_to_learn_and_empty_table(spark):
    df = spark.createDataFrame([(1, "abc", None, None, None)], SCHEMA)
    model = langid.train(df)
    assert model is None and langid.identify(df, model).first().lang_pred == "und"
    assert langid.identify(df.limit(0), model).count() == 0


def test_query_is_accurate_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op6_language(spark, sf).collect()}
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [i for i in docs if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(held) == sorted(i for i, r in got.items() if r.held_out) and set(got) == set(docs)
    assert sum(got[i].lang_pred == docs[i] for i in held if docs[i]) >= 0.95 * sum(docs[i] is not None for i in held)


def test_prediction_equals_a_plain_loop(spark):
    rows = [(i, t, lang, "", "") for i, t, lang in _docs(90)] + [(200, "12", None, None, None), (201, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = langid.train(df, sample=25, centroids=3)
    weight = model.idf.tolist()
    centroids = [(model.languages[o], c.tolist()) for o, c in zip(model.owner, model.centroids)]
    for r in langid.identify(df, model).collect():
        text = next(x[1] for x in rows if x[0] == r.doc_id)
        v = {k: math.log1p(n) * weight[k] for k, n in enumerate(langid.ngram_counts([text])[0].tolist()) if n}
        if not v:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        norm = math.sqrt(sum(x * x for x in v.values()))
        cosines = [(sum(x * c[k] for k, x in v.items()) / norm, lang) for lang, c in centroids]
        best = max(x for x, _ in cosines)
        assert abs(r.score - min(1, best)) < 1e-4 and r.lang_pred in {lang for x, lang in cosines if x > best - 1e-4}


def test_every_language_is_learned_and_the_sample_is_bounded(spark):
    rows = [(i, f"{chr(0x4E00 + i % 1500) * 3} ab", f"l{i % 1500}", "", "") for i in range(3000)]
    rows += [(7, f"hot text {chr(0x3041 + i % 60)} {i}", "hot", "", "") for i in range(400)] + [(8, "same text", "hot", "", "")] * 300
    df = spark.createDataFrame(rows, SCHEMA)
    drawn = Counter(r.lang for r in langid._drawn(df, 20, "doc_id", "text", "lang").collect())
    assert len(drawn) == 1501 and max(drawn.values()) <= 20
    model = langid.train(df, sample=20)
    assert len(model.languages) == 1501
    got = langid.identify(df.where("lang != 'hot'").limit(300), model).collect()
    truth = {r[0]: r[2] for r in rows[:3000]}
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) > 0.6 * len(got)  # 1500 letters share 4096 columns
