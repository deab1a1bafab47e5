import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from eventlens.llm import simhash

SCHEMA = "doc_id long, text string, fp string, root string"


def slow_fingerprint(text, n=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(rows, radius=4):
    fps = {i: slow_fingerprint(t) for i, t in rows}
    comp = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if comp[b] < comp[a] and (fps[a] ^ fps[b]).bit_count() <= radius:
                    comp[a] = comp[b]
                    changed = True
    return {i: (format(fps[i], "016x"), comp[i]) for i in fps}


def test_matches_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}é" for i in range(300)]
    rows = []
    for g in range(25):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, 200))]
        for _ in range(rng.randint(1, 5)):
            t = list(base)
            if rng.random() < 0.6:
                t[rng.randrange(len(t))] = rng.choice(vocab)
            rows.append((len(rows), (" \t" if rng.random() < 0.2 else " ").join(t).title()))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \n"), (len(rows) + 3, "x\xa0y one two")]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], SCHEMA)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df, group_rows=20).collect()}
    assert got == slow_components(rows)


def test_forest_keeps_every_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fp = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(60)]))
    old = simhash.TILE_ROWS, simhash.TILE_COLS
    simhash.TILE_ROWS, simhash.TILE_COLS = 16, 64
    try:
        u, v = simhash.link_forest(fp, None, 4)
        half = len(fp) // 2
        parts = [simhash.link_forest(fp[:half], None, 4), simhash.link_forest(fp[half:], None, 4),
                 simhash.link_forest(fp[:half], fp[half:], 4)]
    finally:
        simhash.TILE_ROWS, simhash.TILE_COLS = old

    def classes(edges):
        up = {int(x): int(x) for x in fp}

        def find(x):
            while up[x] != x:
                x = up[x]
            return x
        for a, b in edges:
            a, b = find(int(a)), find(int(b))
            up[max(a, b)] = min(a, b)
        return {x: find(x) for x in up}
    full = np.argwhere(np.triu(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4, 1))
    want = classes((fp[i], fp[j]) for i, j in full)
    assert classes(zip(u, v)) == want
    assert len(u) < len(fp)
    assert classes(e for p in parts for e in zip(*p)) == want


def test_empty_table_and_null_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(df).count() == 0
    df = spark.createDataFrame([(None, None, "a", "b"), (3, "", "a", "b"), (3, "", "a", "b"), (2, None, None, None)], SCHEMA)
    got = sorted((repr(r.doc_id), r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == [("2", 2), ("3", 2), ("3", 2), ("None", 2)]


def test_very_long_text(spark):
    long = " ".join(str(i % 977) for i in range(200_000))
    df = spark.createDataFrame([(1, long, "", ""), (2, long + " end", "", "")], SCHEMA)
    out = simhash.near_duplicates(df)
    assert [r.component_id for r in out.collect()] == [1, 1]
    assert out.select(F.max(F.length("fingerprint"))).first()[0] == 16
