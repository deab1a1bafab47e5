"""Periodic runs of words, by recompression.

A run is a stretch of consecutive words whose smallest period is q, of
``least`` words and ``exponent`` periods at least, that no neighbouring
word extends.

The words of a block of texts (parted by marks that occur once) are
compressed into a run-length grammar: block compression names every
maximal repetition of one symbol, pair compression splits the symbols at
random into left and right ones and names every left-right pair, and the
two alternate up to a single symbol.  A symbol's place among the pairs
follows from the symbol itself, so equal stretches are parsed alike but
at their rims.  A longest common extension climbs from two words while
the symbols are equal, taking at most one symbol or block a level, and
comes down again from the first difference the same way; all queries of a
block climb together.  Extensions to the left are those of the grammar
read backwards.

Candidates lie on harmonic grids: for each period q, the words at the
multiples of q.  A run of four periods holds three neighbouring grid
pairs of equal words; a chain of such pairs is asked once, and again
behind each extension that ends inside it.

Defined results: a null or empty text has no runs and collapses to ''.
Every row gives a row, whatever its id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common

LEAST, EXPONENT = 6, 4
#: Bytes of text compressed into one grammar.
BLOCK = 1 << 21
RUN = T.StructType([T.StructField(k, T.LongType()) for k in ("start", "length", "period")])
Run = tuple[int, int, int]


@dataclass
class Level:
    """Symbols, and how they meet in those of the next level (``starts`` has the end, too)."""

    sym: np.ndarray
    starts: np.ndarray
    parent: np.ndarray
    right: np.ndarray | None  # pairs: a parent ends behind the symbol; None: blocks

    def mirrored(self) -> "Level":
        return Level(self.sym[::-1], len(self.sym) - self.starts[::-1], len(self.starts) - 2 - self.parent[::-1],
                     None if self.right is None else ~self.right[::-1])


def _bits(sym: np.ndarray, level: int) -> np.ndarray:
    h = (sym.astype(np.uint64) + np.uint64(level * 0x632BE5AB + 1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    return (h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(63)).astype(bool)


def _joined(sym: np.ndarray, head: np.ndarray, key: np.ndarray, new: np.ndarray, names: int) -> tuple[np.ndarray, int]:
    """Symbols of the parents: the only child's, or a new name for each distinct key."""
    out = sym[head].copy()
    if new.any():
        distinct, at = np.unique(key[new], return_inverse=True)
        out[new] = names + at
        names += len(distinct)
    return out, names


def grammar(sym: np.ndarray) -> list[Level]:
    """Levels from the words up; the last has one symbol and no parents."""
    levels: list[Level] = []
    sym = sym.astype(np.int64)
    names, turn = int(sym.max(initial=0)) + 1, 0
    while len(sym) > 1:
        differs = np.append(True, sym[1:] != sym[:-1])
        if not differs.all():  # block compression
            starts = np.append(np.flatnonzero(differs), len(sym))
            size = np.diff(starts)
            up, names = _joined(sym, starts[:-1], sym[starts[:-1]] * (len(sym) + 1) + size, size > 1, names)
            levels.append(Level(sym, starts, np.cumsum(differs) - 1, None))
            sym = up
        if len(sym) > 1:  # pair compression
            turn += 1
            right = _bits(sym, turn)
            pair = np.append(~right[:-1] & right[1:], False)
            if pair.any():
                head = np.append(True, ~pair[:-1])
                starts = np.append(np.flatnonzero(head), len(sym))
                key = sym[starts[:-1]] * names + sym[np.minimum(starts[:-1] + 1, len(sym) - 1)]
                up, names = _joined(sym, starts[:-1], key, pair[starts[:-1]], names)
                levels.append(Level(sym, starts, np.cumsum(head) - 1, right))
                sym = up
    levels.append(Level(sym, np.zeros(1, np.int64), np.zeros(len(sym), np.int64), None))
    return levels


def extensions(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from ``i`` on equal those from ``j`` on (i < j).

    The texts' marks occur once, so no extension passes one."""
    p, q = i.copy(), j.copy()
    left: list[np.ndarray] = []  # queries whose symbols differ at each level
    open_ = np.arange(len(i))
    for level in levels:
        same = level.sym[p[open_]] == level.sym[q[open_]]
        differ = [open_[~same]]
        open_ = open_[same]
        x, y = p[open_], q[open_]
        if level.right is None:
            up_x, up_y = level.parent[x], level.parent[y]
            rest_x, rest_y = level.starts[up_x + 1] - x, level.starts[up_y + 1] - y
            even = rest_x == rest_y
            less = np.minimum(rest_x, rest_y)
            p[open_], q[open_] = np.where(even, up_x + 1, x + less), np.where(even, up_y + 1, y + less)
            differ.append(open_[~even])
            open_ = open_[even]
        else:
            step = level.right[x]
            p[open_], q[open_] = level.parent[x + step], level.parent[y + step]
        left.append(np.concatenate(differ))
        if not len(open_):
            break
    down = np.zeros(0, np.int64)
    for k in range(len(left) - 1, 0, -1):
        down = np.concatenate([down, left[k]])
        level = levels[k - 1]
        up_x, up_y = p[down], q[down]
        x, y = level.starts[up_x], level.starts[up_y]
        step = (level.sym[x] == level.sym[y]).astype(np.int64)
        if level.right is None:
            step *= np.minimum(level.starts[up_x + 1] - x, level.starts[up_y + 1] - y)
        p[down], q[down] = x + step, y + step
    return p - i


def candidates(sym: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(period, grid place) where three neighbouring grid pairs of words are equal, in order."""
    periods, places = [], []
    for q in range(1, longest // EXPONENT + 1):
        x = sym[::q]
        same = x[1:] == x[:-1]
        at = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        if len(at):
            places.append(at)
            periods.append(np.full(len(at), q))
    none = [np.zeros(0, np.int64)]
    return np.concatenate(periods or none), np.concatenate(places or none)


def block_runs(sym: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, period) of the runs in ``sym``, whose texts of at most ``longest`` words are parted by single marks."""
    q, k = candidates(sym, longest)
    if not len(q):
        return np.zeros((0, 3), np.int64)
    key = q * (len(sym) + 1) + k
    new = np.append(True, np.diff(key) != 1)
    chain = np.cumsum(new) - 1
    levels = grammar(sym)
    back = [x.mirrored() for x in levels]
    at = np.flatnonzero(new)
    found = []
    while len(at):
        i, period = q[at] * k[at], q[at]
        ahead = extensions(levels, i, i + period)
        behind = extensions(back, len(sym) - i - period, len(sym) - i)
        start, length = i - behind, behind + ahead + period
        ok = length >= np.maximum(LEAST, EXPONENT * period)
        found.append(np.stack([start[ok], length[ok], period[ok]], 1))
        # the first grid place of the same chain behind the extension
        after = np.searchsorted(key, period * (len(sym) + 1) + (i + ahead) // period + 1)
        go = after < len(key)
        go[go] = chain[after[go]] == chain[at[go]]
        at = after[go]
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # one stretch of several periods has the smallest
    first = np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)) if len(runs) else np.zeros(0, bool)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _strongest(runs: list[Run]) -> Run | None:
    """The run of most periods; ties by start, then period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def find(texts: list[str | None]) -> list[tuple[list[Run], str]]:
    """(runs by start and period, collapsed text) of each text."""
    words = [(t or "").encode().split() for t in texts]  # bytes split at the six ASCII blanks alone
    flat = pa.array([w for x in words for w in x], pa.binary()).dictionary_encode()
    ids = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.array([len(x) for x in words], np.int64)
    first = np.cumsum(size) - size
    out: list[tuple[list[Run], str] | None] = [None] * len(texts)
    # texts of about one length together: the periods to try follow the longest
    classes = np.where(size >= LEAST, np.log2(np.maximum(size, 1)).astype(np.int64), -1)
    for c in np.unique(classes):
        some = np.flatnonzero(classes == c)
        if c < 0:
            own, starts = np.zeros((0, 3), np.int64), np.zeros(len(some), np.int64)
        else:
            n = size[some]
            starts = np.cumsum(n + 1) - n  # a mark before each text, and one at the end
            sym = np.empty(int(n.sum()) + len(some) + 1, np.int64)
            marks = np.append(starts - 1, len(sym) - 1)
            sym[marks] = len(flat.dictionary) + np.arange(len(marks))
            word = np.ones(len(sym), bool)
            word[marks] = False
            sym[word] = ids[np.repeat(first[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            own = block_runs(sym, int(n.max()))
        of = np.searchsorted(starts, own[:, 0], "right") - 1 if len(own) else np.zeros(0, np.int64)
        bounds = np.searchsorted(of, np.arange(len(some) + 1))
        for m, t in enumerate(some.tolist()):
            lo, hi = bounds[m], bounds[m + 1]
            body = words[t]
            runs: list[Run] = []
            if hi > lo:
                mine = own[lo:hi] - np.array([starts[m], 0, 0])
                runs = [tuple(r) for r in mine.tolist()]
                step = np.zeros(len(body) + 1, np.int64)
                np.add.at(step, mine[:, 0] + mine[:, 2], 1)
                np.add.at(step, mine[:, 0] + mine[:, 1], -1)
                body = [body[x] for x in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]
            out[t] = (runs, b" ".join(body).decode())
    return out


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, runs, strongest, collapsed): all runs by start and period, the one of most
    periods, and the words without those that a run repeats, one space between."""
    struct = pa.struct([(k, pa.int64()) for k in RUN.names])

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = b.column("text")
        found = [f for lo, hi in common.text_spans(texts, BLOCK) for f in find(texts.slice(lo, hi - lo).to_pylist())]

        def named(r: Run | None) -> dict | None:
            return None if r is None else dict(zip(RUN.names, r))
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([[named(r) for r in f[0]] for f in found], pa.list_(struct)),
             pa.array([named(_strongest(f[0])) for f in found], struct), pa.array([f[1] for f in found], pa.string())],
            ["doc_id", "runs", "strongest", "collapsed"])
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
                           T.StructField("strongest", RUN), T.StructField("collapsed", T.StringType())])
    return common.id_text(docs, id_col, text_col).mapInArrow(common.per_batch(batch), schema)
