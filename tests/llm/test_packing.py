import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventlens.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, length string, part string"


def check_plan(plan, counts, size):
    used = defaultdict(int)
    for filling, m in plan:
        assert m > 0 and sum(k * c for k, c in filling) <= size
        for k, c in filling:
            used[k] += c * m
    assert dict(used) == {k: n for k, n in counts.items() if n}
    return sum(m for _, m in plan)


def fewest(items, size):
    """Exact, by trying every sequence for the next item."""
    items = sorted(items, reverse=True)
    best = len(items)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for room in sorted(set(bins)):
            if room >= items[i]:
                rest = list(bins)
                rest.remove(room)
                go(i + 1, rest + [room - items[i]])
        go(i + 1, bins + [size - items[i]])
    go(0, [])
    return best


def test_plans_are_near_the_fewest():
    rng = random.Random(3)
    total = least = 0
    for _ in range(40):
        items = [rng.randint(1, 30) for _ in range(rng.randint(1, 9))]
        counts = {k: items.count(k) for k in items}
        exact = fewest(items, 30)
        assert packing.waste_bound(counts, 30) <= exact
        n = check_plan(packing.plan_lengths(counts, 30), counts, 30)
        assert n <= check_plan(packing.best_fit(counts, 30), counts, 30)
        total, least = total + n, least + exact
    assert total <= least + 1


def test_completion_beats_best_fit():
    counts = {25: 1, 44: 1, 45: 1, 18: 1, 40: 1, 35: 1, 33: 1, 38: 1, 21: 1}
    assert check_plan(packing.best_fit(counts, 100), counts, 100) == 4
    assert check_plan(packing.plan_lengths(counts, 100), counts, 100) == packing.waste_bound(counts, 100) == 3


@pytest.mark.parametrize("seed", range(4))
def test_large_histograms(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.lognormal(6, 1, 200_000).astype(int).clip(1, 2048)
    counts = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
    n = check_plan(packing.plan_lengths(counts, 2048), counts, 2048)
    assert n <= packing.waste_bound(counts, 2048) * 1.001 + 1


def test_pieces_and_places(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{rng.randint(0, 999)}é" for _ in range(rng.choice([0, 3, 50, 400, 3000]))), "l", "p") for i in range(60)]
    rows += [(100, None, None, None), (None, "x", None, None), (5, rows[5][1], "l", "p"), (101, "a " * 50_000, "", "")]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA), PATH, end=0, size=512).collect()
    t = Tokenizer.from_file(PATH)
    want = defaultdict(int)
    for i, text, _, _ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        head = len(ids) % 512 or 512
        cuts = [0, *range(head, len(ids) + 1, 512)]
        for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes())] += 1
    have = defaultdict(int)
    bins = defaultdict(list)
    for r in got:
        have[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        bins[r.sequence_id].append((r.offset, r.length))
    assert have == want
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 512
    total = sum(r.length for r in got)
    assert len(bins) <= -(-total // 512) + 2


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_small_cases_reach_the_optimum():
    nine = {k: n for k, n in ((12, 1), (15, 1), (17, 1), (26, 1), (35, 1), (39, 1), (42, 1), (55, 2))}
    assert check_plan(packing.best_fit(nine, 100), nine, 100) == 4
    assert check_plan(packing.plan_lengths(nine, 100), nine, 100) == 3
    rng = random.Random(8)
    for _ in range(150):
        items = [rng.randint(8, 60) for _ in range(rng.randint(5, 10))]
        counts = {k: items.count(k) for k in items}
        assert check_plan(packing.plan_lengths(counts, 100), counts, 100) == fewest(items, 100)


def test_fillings_are_all_undominated_ones_by_waste():
    rng = random.Random(9)
    for _ in range(60):
        items = [rng.randint(3, 30) for _ in range(8)]
        counts = {k: items.count(k) for k in items}
        lengths = sorted(counts)
        left = {**counts, lengths[-1]: counts[lengths[-1]] - 1}
        room = 40 - lengths[-1]
        pool = [k for k, n in left.items() for _ in range(n)]
        every = {tuple(sorted((x for j, x in enumerate(pool) if m >> j & 1), reverse=True)) for m in range(1 << len(pool))}
        every = {f for f in every if sum(f) <= room}
        want = {f for f in every if not packing._dominated(f, room - sum(f), left, lengths)}
        reach = packing._reachable(lengths, 40)
        got = list(packing._fillings(counts, lengths, 40, reach, 40, packing._Budget(10 ** 9, 10 ** 9)))
        assert set(got) == want and len(got) == len(want)
        waste = [room - sum(f) for f in got]
        assert waste == sorted(waste)
        # what is left out has a filling that is at least as good
        assert all(any(sum(g) >= sum(f) for g in want) for f in every)


def test_repeated_rows_without_an_id_are_spread(spark):
    df = spark.createDataFrame([(None, None, "", "")] * 3000 + [(1, "word " * 30, "", "")], SCHEMA).repartition(4)
    rows = packing.pack(df, PATH, size=64).collect()
    assert len(rows) == 3001
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    assert all([o for o, _ in sorted(v)] == np.cumsum([0] + [k for _, k in sorted(v)])[:-1].tolist() for v in by.values())
    assert len(by) == -(-sum(r.length for r in rows) // 64)
