import hashlib
import random

import pytest

from eventlens.llm import substrings

SCHEMA = "doc_id long, text string, anchor string, block string"


def brute(rows, window):
    """Rows with distinct ids."""
    docs = sorted((i, (t or "").replace("\t", " ").replace("\n", " ").split(" ")) for i, t in rows)
    docs = [(i, [w for w in ws if w]) for i, ws in docs]
    seen, out = set(), {}
    for i, ws in docs:
        gone = set()
        for s in range(len(ws) - window + 1):
            w = tuple(ws[s:s + window])
            if w in seen:
                gone.update(range(s, s + window))
            seen.add(w)
        out[i] = (len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone))
    return out


@pytest.mark.parametrize("vocab,window", [(3, 4), (40, 8), (2000, 20)])
def test_matches_brute_force(spark, vocab, window):
    rng = random.Random(vocab)
    words = [f"é{i}" for i in range(vocab)]
    passages = [[rng.choice(words) for _ in range(rng.randint(window - 2, 3 * window))] for _ in range(6)]
    rows = []
    for i in range(80):
        t = []
        for _ in range(rng.randint(0, 4)):
            t += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randint(1, 40))]
        rows.append((i * 3, rng.choice([" ", "\n", " \t "]).join(t)))
    rows += [(1, None), (2, ""), (4, rows[5][1]), (5, rows[5][1])]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept)
           for r in substrings.remove_repeats(df, window, gram=min(6, window), block_bytes=600, shard_segments=40).collect()}
    assert got == brute(rows, window)


def test_a_common_phrase_does_not_fill_a_shard(spark):
    rng = random.Random(8)
    phrase = [f"licence{i}" for i in range(19)]

    def text(i):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(50)]
        return " ".join(words[:25] + phrase * (i % 2) + words[25:])
    rows = [(i, text(i)) for i in range(400)]
    rows += [(1000, rows[1][1]), (1001, "x " + " ".join(rows[3][1].split()[15:45]) + " y"), (1002, rows[2][1])]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    docs = substrings._with_block(df, 8)
    sent = {}
    for r in substrings._sharded(docs, substrings._packed(docs), 20, 6, 40, 8).where("not done").collect():
        sent[r.shard] = sent.get(r.shard, 0) + len(substrings._unpack(r.blob)[0])
    assert max(sent.values()) < 100  # of the 200 documents with the phrase
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(df, shard_segments=40).collect()}
    assert got == brute(rows, 20)


def test_a_window_of_every_block_does_not_fill_a_shard(spark, monkeypatch):
    rng = random.Random(9)
    notice = [f"n{i}" for i in range(24)]

    def text(i):
        own = [f"w{rng.randint(0, 10**6)}" for _ in range(30)]
        return " ".join(own[:i % 30] + notice + own[i % 30:])
    rows = [(7 * i % 1009, text(i)) for i in range(300)]
    rows += [(2000, rows[4][1] + " " + rows[9][1]), (2001, rows[0][1])]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    monkeypatch.setattr(substrings, "MERGE_BLOCKS", 4)
    docs = substrings._with_block(df, 64)
    copies = {}
    for r in substrings._sharded(docs, substrings._packed(docs), 20, 6, 40, 64).where("hot").collect():
        for s in substrings._unpack(r.blob)[1].split(b"\n"):
            copies[s] = copies.get(s, 0) + 1
    whole = [" ".join(notice[k:k + 20]).encode() for k in range(5)]
    assert all(1 <= copies[w] <= 4 for w in whole)  # of 64 blocks
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept)
           for r in substrings.remove_repeats(df, block_bytes=600, shard_segments=40).collect()}
    assert got == brute(rows, 20)


def test_two_letter_alphabet_gives_the_same(monkeypatch):
    import pyarrow as pa
    words = [f"w{i % 50}" for i in range(400)]
    keys = [(1, 0, 0), (2, 0, 5)]
    blob = substrings._pack(keys, [" ".join(words[:300]).encode(), " ".join(words[100:]).encode()])
    t = pa.table({"block": [0], "done": [False], "blob": [blob]})
    one = substrings._locate(t, 20)
    monkeypatch.setattr(substrings, "ONE_LETTER", 10)
    two = substrings._locate(t, 20)
    assert substrings._unpack(one["ranges"][0].as_py())[0].tolist() == substrings._unpack(two["ranges"][0].as_py())[0].tolist()


def test_repeated_rows_null_ids_and_empty_table(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    t = " ".join(f"a{i}" for i in range(30))
    df = spark.createDataFrame([(None, t, None, None), (7, t, None, None), (7, t, None, None), (8, None, None, None)], SCHEMA)
    got = sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept_sha256)
                 for r in substrings.remove_repeats(df, digest=True).collect())
    full, none = (hashlib.sha256(x.encode()).hexdigest() for x in (t, ""))
    assert got == [("7", 30, 30, none), ("7", 30, 30, none), ("8", 0, 0, none), ("None", 30, 0, full)]


def test_very_long_text(spark):
    t = " ".join(f"{i % 5003}" for i in range(100_000))
    df = spark.createDataFrame([(1, t, "", "")], SCHEMA)
    r = substrings.remove_repeats(df).first()
    assert (r.n_words, r.n_removed) == (100_000, 100_000 - 5003)
