"""Best-fit packing of token pieces by bin completion over lengths.

Pieces of one length are interchangeable, so the search runs over the
histogram of lengths: at most ``size`` rows, however many pieces there
are.  A *filling* is a multiset of lengths for one sequence; the plan is
a list of fillings with multiplicities.

``best_fit`` (longest first, into the fullest sequence with room) gives
the first incumbent.  ``complete`` is the branch-and-bound: it takes the
longest length left and goes through all undominated ways to complete a
sequence around it, by waste, each first as often as the counts allow
and then less often; it abandons a branch as soon as the waste so far
exceeds what the incumbent allows.  The fillings come one at a time from
a search that is pruned by the sums the lengths can reach.  It ends at
the waste bound (no plan can have fewer sequences), when every branch
is done (the incumbent is then the optimum), or at its budget of
``NODES`` fillings tried and ``STEPS`` steps of their search, and the
incumbent stands.

Spark does the rest: pieces are ranked within their length (hot lengths
are split into even groups of a measured count first) and look their
place up in the plan.

Defined results: null or empty text is one piece with the end id alone;
repeated rows are packed as often as they occur; an empty table packs
nothing.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, tokens

NODES = 6000
STEPS = 2_000_000
#: Longest filling whose subsets are all tried for dominance; of longer ones, single lengths and pairs are.
SUBSETS = 10
RANK_GROUPS = 8192
Filling = tuple[tuple[int, int], ...]  # ((length, copies), ...), longest first


def pieces(docs: DataFrame, tokenizer: str, end: int, size: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): texts cut to at most ``size`` ids.

    The remainder is the first piece; the others are full."""
    tail = np.array([end], "<u4").tobytes()

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = tokens.encoder(tokenizer)
        row, piece, start, length, crc = [], [], [], [], []
        texts, at = b.column("text"), 0
        for lo, hi in common.text_spans(texts):
            for ids in enc.encode(texts.slice(lo, hi - lo).to_pylist()):
                ids += tail
                n = len(ids) // 4
                s, k = 0, 0
                while s < n:
                    e = s + (n % size or size) if s == 0 else s + size
                    row.append(at)
                    piece.append(k)
                    start.append(s)
                    length.append(e - s)
                    crc.append(zlib.crc32(ids[4 * s:4 * e]))
                    s, k = e, k + 1
                at += 1
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
             pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
            ["doc_id", "piece", "start", "length", "ids_crc32"])
    return common.id_text(docs).mapInArrow(
        common.per_batch(batch), "doc_id long, piece int, start long, length long, ids_crc32 long")


def waste_bound(counts: dict[int, int], size: int) -> int:
    """Fewest sequences any packing needs: the larger of the volume bound
    and, for thresholds t, that of pieces too long to share with one of t."""
    lengths = sorted(counts)
    total = sum(k * n for k, n in counts.items())
    best = -(-total // size)
    for t in sorted({1} | {k for k in lengths if 2 * k <= size}):
        alone = sum(n for k, n in counts.items() if k > size - t)
        large = [(k, n) for k, n in counts.items() if size - t >= k and 2 * k > size]
        rest = sum(k * n for k, n in counts.items() if t <= k and 2 * k <= size)
        room = sum((size - k) * n for k, n in large)
        best = max(best, alone + sum(n for _, n in large) + max(0, -(-(rest - room) // size)))
    return best


def best_fit(counts: dict[int, int], size: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing over the histogram: groups of equal sequences at a time."""
    by_room: dict[int, list[tuple[Filling, int]]] = {}
    rooms: list[int] = []

    def put(room: int, filling: Filling, m: int) -> None:
        if m:
            if room not in by_room:
                by_room[room] = []
                rooms.insert(bisect_right(rooms, room), room)
            by_room[room].append((filling, m))
    for k in sorted(counts, reverse=True):
        left = counts[k]
        i = bisect_right(rooms, k - 1)
        moved = []
        while left and i < len(rooms):
            room = rooms[i]
            groups, q = by_room[room], room // k
            while left and groups:
                filling, m = groups.pop()
                full = min(m, left // q)
                moved.append((room - q * k, (*filling, (k, q)), full))
                left -= full * q
                m -= full
                if m and left:  # fewer than q are left: they share one sequence
                    moved.append((room - left * k, (*filling, (k, left)), 1))
                    m, left = m - 1, 0
                if m:
                    groups.append((filling, m))
                    break
            i += 1
        if left:
            q = size // k
            moved.append((size - q * k, ((k, q),), left // q))
            if left % q:
                moved.append((size - left % q * k, ((k, left % q),), 1))
        for room, filling, m in moved:
            put(room, filling, m)
    return [(f, m) for room in rooms for f, m in by_room[room]]


def _reachable(lengths: list[int], size: int) -> dict[int, int]:
    """For each length, a bit for every sum up to ``size`` of any number of lengths up to it."""
    out, sums, full = {}, 1, (1 << size + 1) - 1
    for x in lengths:
        step = x
        while step <= size:  # doubled: any number of copies
            sums |= sums << step & full
            step *= 2
        out[x] = sums
    return out


class _Budget:
    """Nodes and steps left; a search that is out of steps ends early."""

    def __init__(self, nodes: int, steps: int):
        self.nodes, self.steps = nodes, steps

    def spent(self) -> bool:
        return self.nodes <= 0 or self.steps <= 0


def _exact(left: dict[int, int], lengths: list[int], reach: dict[int, int], top: int, total: int, budget: _Budget) -> Iterator[tuple[int, ...]]:
    """All multisets of ``lengths[:top]`` (longest first) within ``left`` that sum to ``total``."""
    if not total:
        yield ()
        return
    i = min(top, bisect_right(lengths, total)) - 1
    while i >= 0 and not budget.spent():
        budget.steps -= 1
        x = lengths[i]
        if not reach[x] >> total & 1:
            return  # nor do shorter lengths reach it
        for k in range(min(left[x], total // x), 0, -1):
            for rest in _exact(left, lengths, reach, i, total - k * x, budget):
                yield (x,) * k + rest
        i -= 1


def _dominated(filling: tuple[int, ...], waste: int, left: dict[int, int], lengths: list[int]) -> bool:
    """Whether a length that is left can take the place of some of the filling's and be at least their sum."""
    most = len(filling) if len(filling) <= SUBSETS else 2
    for n in range(most + 1):
        for some in set(combinations(filling, n)):
            total = sum(some)
            i = bisect_right(lengths, total + waste) - 1
            while i >= 0 and lengths[i] >= max(total, 1):
                x = lengths[i]
                # the same length alone changes nothing
                if left[x] - filling.count(x) + some.count(x) > 0 and not (n == 1 and x == total):
                    return True
                i -= 1
    return False


def _fillings(counts: dict[int, int], lengths: list[int], size: int, reach: dict[int, int], waste: int, budget: _Budget) -> Iterator[tuple[int, ...]]:
    """Undominated completions of the longest length that waste at most ``waste``, by waste."""
    first = lengths[-1]
    left = {**counts, first: counts[first] - 1}
    room = size - first
    for w in range(min(waste, room) + 1):
        for f in _exact(left, lengths, reach, len(lengths), room - w, budget):
            if not _dominated(f, w, left, lengths):
                yield f
        if budget.spent():
            return


def complete(counts: dict[int, int], size: int, incumbent: list[tuple[Filling, int]], nodes: int = NODES, steps: int = STEPS) -> list[tuple[Filling, int]]:
    """Bin completion: a plan of fewer sequences than the incumbent, or the incumbent."""
    bound = waste_bound(counts, size)
    total = sum(k * n for k, n in counts.items())
    best, best_n = incumbent, sum(m for _, m in incumbent)
    left = {k: n for k, n in counts.items() if n}
    lengths = sorted(left)
    if best_n <= bound or not lengths:
        return best
    reach = _reachable(lengths, size)
    budget = _Budget(nodes, steps)
    plan: list[tuple[Filling, int]] = []
    used_n, waste = 0, 0

    def take(f: tuple[int, ...], m: int) -> None:
        for x in set(f):
            left[x] -= m * f.count(x)
            if not left[x]:
                del left[x]
                lengths.pop(bisect_right(lengths, x) - 1)

    def give(f: tuple[int, ...], m: int) -> None:
        for x in set(f):
            if x not in left:
                left[x] = 0
                lengths.insert(bisect_right(lengths, x), x)
            left[x] += m * f.count(x)

    def options() -> Iterator[tuple[tuple[int, ...], int]]:
        first = lengths[-1]
        own, at = dict(left), list(lengths)
        for f in _fillings(own, at, size, reach, (best_n - 1) * size - total - waste, budget):
            f = (first, *f)
            for m in range(min(own[x] // f.count(x) for x in set(f)), 0, -1):
                yield f, m
    stack: list[list] = [[options(), None]]
    while stack and best_n > bound and not budget.spent():
        step = next(stack[-1][0], None)
        if step is None:
            stack.pop()
            if stack:
                f, m, w = stack[-1][1]
                give(f, m)
                plan.pop()
                used_n, waste = used_n - m, waste - w
            continue
        f, m = step
        w = (size - sum(f)) * m
        budget.nodes -= 1
        if waste + w > (best_n - 1) * size - total:
            continue  # a plan with one sequence fewer cannot waste so much
        take(f, m)
        plan.append((tuple((x, f.count(x)) for x in sorted(set(f), reverse=True)), m))
        used_n, waste = used_n + m, waste + w
        if lengths:
            stack[-1][1] = (f, m, w)
            stack.append([options(), None])
        else:
            if used_n < best_n:
                best, best_n = list(plan), used_n
            give(f, m)
            plan.pop()
            used_n, waste = used_n - m, waste - w
    return best


def plan_lengths(counts: dict[int, int], size: int, nodes: int = NODES) -> list[tuple[Filling, int]]:
    return complete(counts, size, best_fit(counts, size), nodes)


def _slots(plan: list[tuple[Filling, int]]) -> np.ndarray:
    """Per length and filling: (length, first rank, copies, first sequence, offset), in order of rank."""
    rows, taken, sequence = [], {}, 0
    for filling, m in plan:
        at = 0
        for k, copies in filling:
            rank = taken.get(k, 0)
            rows.append((k, rank, copies, sequence, at))
            taken[k] = rank + copies * m
            at += k * copies
        sequence += m
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, end: int = 0, size: int = 2048, nodes: int = NODES) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    spark = docs.sparkSession
    # a row's number holds once the table is written
    cut = common.materialise(pieces(docs, tokenizer, end, size).withColumn("row", F.monotonically_increasing_id()), "pieces")
    # at most ``size`` rows
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(plan_lengths(counts, size, nodes)))
    # a length is ranked in groups of about ``target`` pieces: at most size + RANK_GROUPS groups in all
    target = max(1000, math.ceil(sum(counts.values()) / RANK_GROUPS))
    groups = spark.createDataFrame([(k, math.ceil(n / target)) for k, n in counts.items()], "length long, groups int")
    key = F.xxhash64("row")  # rows that are equal in all columns are dealt, too
    dealt = cut.join(F.broadcast(groups), "length").withColumn("part", F.pmod(key, F.col("groups")).cast("int")).drop("groups")
    sums = sorted((r.length, r.part, r.n) for r in dealt.groupBy("length", "part").agg(F.count("*").alias("n")).collect())
    before, last, at = {}, None, 0
    for k, part, n in sums:
        at = 0 if k != last else at
        before[k, part] = at
        last, at = k, at + n
    before = spark.sparkContext.broadcast(before)
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("rank", F.row_number().over(order) - 1)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        s, at = slots.value, before.value
        k = b.column("length").to_numpy()
        parts = b.column("part").to_numpy()
        rank = b.column("rank").to_numpy() + np.array([at[x] for x in zip(k.tolist(), parts.tolist())], np.int64)
        shift = np.int64(1) << np.int64(48)
        i = np.searchsorted(s[:, 0] * shift + s[:, 1], k * shift + rank, side="right") - 1
        j = rank - s[i, 1]
        return pa.RecordBatch.from_arrays(
            [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            + [pa.array(s[i, 3] + j // s[i, 2]), pa.array(s[i, 4] + j % s[i, 2] * k)],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return ranked.mapInArrow(
        common.per_batch(batch),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
