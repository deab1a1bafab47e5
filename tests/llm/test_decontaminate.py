import random
import re

import pytest

from eventlens.llm import decontaminate

SCHEMA = "doc_id long, text string, hits string, items string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window):
    wins = {}
    for item, t in items:
        w = words(t)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[s:s + n]), set()).add(str(item) if item is not None else None)
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in wins:
                    hit.update(range(s, s + n))
                    names |= wins[tuple(w[s:s + n])]
        out.append((repr(i), len(w), len(hit), sorted(names - {None})))
    return sorted(out)


@pytest.mark.parametrize("block_bytes,max_blocks", [(1 << 20, 4), (150, 1000), (150, 1)])
def test_matches_brute_force(spark, block_bytes, max_blocks):
    rng = random.Random(2)
    vocab = [f"wé{chr(97 + i)}" for i in range(14)]
    items = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 5, 8, 12])))) for i in range(20)]
    items += [(50, None), (51, ""), (None, " ".join(vocab[:7])), (3, items[3][1]), (52, "...")]
    docs = [(i, " ".join(rng.choice(vocab + ["OUT", "x_y"]) for _ in range(rng.randint(0, 60))).title()) for i in range(60)]
    docs += [(60, None), (61, ""), (None, docs[2][1]), (7, docs[7][1]), (62, " ".join(vocab[:7]))]
    df = spark.createDataFrame([(i, t, "h", "i") for i, t in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((repr(r.doc_id), r.n_words, r.n_hit, list(r["items"]))
                 for r in decontaminate.contamination(df, bench, 5, block_bytes, max_blocks=max_blocks).collect())
    want = brute(docs, items, 5)
    assert got == want
    kept = decontaminate.decontaminate(df, bench, 5, block_bytes, max_blocks=max_blocks)
    assert kept.columns == df.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(i for i, _, n, _ in want if not n)


def test_empty_tables_and_long_text(spark):
    docs = spark.createDataFrame([(1, "a b " * 200_000, "", "")], SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, none).first()[:3] == (1, 400_000, 0)
    assert decontaminate.contamination(docs.limit(0), none).count() == 0
    one = spark.createDataFrame([(4, "b a b a b a b a b a")], "item_id long, text string")
    r = decontaminate.contamination(docs, one).first()
    assert (r.n_words, r.n_hit, r["items"]) == (400_000, 399_998, ["4"])


def test_long_items_and_copies_do_not_make_a_block_large(spark, monkeypatch):
    rng = random.Random(5)
    long = " ".join(f"w{rng.randint(0, 300)}" for _ in range(900))
    items = [(1, long)] + [(i, "one text that many items of the benchmark share word by word") for i in range(2, 120)]
    docs = [(i, " ".join(long.split()[s:s + rng.randint(4, 60)]) + " end") for i, s in enumerate(range(0, 880, 11))] + [(500, items[5][1] + " x"), (501, "other words")]
    df = spark.createDataFrame([(i, t, "", "") for i, t in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 50)
    blocks = decontaminate._blocks(*decontaminate._pieces(bench, 7, 3000, "item_id", "text"), 7)
    sizes = [len(index(df.select("text")).value.word) for _, index in blocks[:2]]
    assert len(blocks) > 3 and max(sizes) < 330
    got = sorted((repr(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.contamination(df, bench, 7, 8000).collect())
    assert got == brute(docs, items, 7)
    got = sorted((repr(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.contamination(df, bench, 7, 3000, max_blocks=1).collect())
    assert got == brute(docs, items, 7)


def test_a_shuffled_benchmark_with_copies_and_columns_of_any_name(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 1 << 8)   # nearly every shingle passes: words decide
    rng = random.Random(6)
    shared = "a notice that a third of the items hold and of the documents too"
    items = [(i, (shared + " " if i % 3 == 0 else "") + " ".join(f"w{rng.randint(0, 40)}" for _ in range(rng.randint(1, 30)))) for i in range(90)]
    docs = [(i, (shared.upper() + ". " if i % 3 == 0 else "") + " ".join(f"w{rng.randint(0, 40)}" for _ in range(rng.randint(0, 300)))) for i in range(40)]
    docs += [(100 + i, docs[5][1]) for i in range(60)] + [(None, docs[3][1])] * 3 + [(8, None), (9, "")]
    docs += [(200, "w1 w2 " * 3000 + items[4][1])]
    df = spark.createDataFrame([(i, t, {"k": 1}, "s", 7) for i, t in docs], "doc_id long, text string, `a.b` map<string,int>, sha string, key long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((repr(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.contamination(df, bench, 5, 100, max_blocks=1).collect())
    want = brute(docs, items, 5)
    assert got == want
    kept = decontaminate.decontaminate(df, bench, 5, 100, max_blocks=1)
    assert kept.schema == df.schema
    rows = kept.collect()
    assert sorted(repr(r.doc_id) for r in rows) == sorted(i for i, _, n, _ in want if not n)
    assert all((r["a.b"], r.sha, r.key) == ({"k": 1}, "s", 7) for r in rows)
    assert decontaminate.contamination(df.limit(0), bench, 5, 100, max_blocks=1).count() == 0
