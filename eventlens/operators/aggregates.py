"""User-written aggregates that merge (the reference's create / add / result / merge).

An :class:`Aggregate` is run as partial states: every task folds the rows
of its (pane, key) groups into states, only states are shuffled, and
states of one group are merged in order of arrival without holding the
group.  So a key with most of the rows costs its tasks their rows and the
shuffle one state per task and pane.

Sliding windows use the blocks of :mod:`eventlens.operators.overlaps`: a
window is a suffix of one block of panes merged with a prefix of the
next, so a pane's state is merged a fixed number of times, however many
windows hold it.  The same aggregate runs on streams
(:func:`eventlens.streaming.aggregates.stream_aggregate`).

A state is anything that pickles.  Rows without an event time are left
out; a null value reaches ``add`` as ``None``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from math import gcd

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.functions.time import duration_us, floor_to, from_micros, to_micros

#: Groups a task holds before it passes their states on.
HELD = 50_000


class Aggregate:
    """Subclass it: the state of no rows, a row added, two states merged, and the value of a state.

    ``add`` and ``merge`` may change and return their first argument; ``merge``
    leaves its second as it is and must not depend on how rows were grouped.
    ``returns`` is the DDL type of the value."""

    returns = "long"

    def create(self):
        raise NotImplementedError

    def add(self, state, *values):
        raise NotImplementedError

    def merge(self, state, other):
        raise NotImplementedError

    def result(self, state):
        return state


def fold(agg: Aggregate, states) -> object:
    """The merge of some pickled states, of one at least (any value may be a state, ``None`` too)."""
    it = iter(states)
    out = pickle.loads(next(it))
    for s in it:
        out = agg.merge(out, pickle.loads(s))
    return out


def partial_states(agg: Aggregate, n_keys: int, held: int = HELD):
    """A mapInArrow function: rows (p, t, keys, values) -> (p, keys, t, state) per task, ``t`` the group's newest time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, list] = {}
        schema: list[pa.Field] = []

        def out() -> pa.RecordBatch:
            cols = list(zip(*states)) or [()] * (1 + n_keys)
            arrays = [pa.array(c, f.type) for c, f in zip(cols, schema)]
            times = pa.array([s[0] for s in states.values()], pa.int64())
            packed = pa.array([pickle.dumps(s[1]) for s in states.values()], pa.binary())
            states.clear()
            return pa.RecordBatch.from_arrays([*arrays, times, packed], ["p", *(f"k{i}" for i in range(n_keys)), "t", "state"])
        for b in batches:
            if not schema:
                schema += [b.schema.field("p"), *(b.schema.field(f"k{i}") for i in range(n_keys))]
            cols = [c.to_pylist() for c in b.columns]
            for p, t, *rest in zip(*cols):
                key = (p, *rest[:n_keys])
                s = states.get(key)
                if s is None:
                    s = states[key] = [t, agg.create()]
                s[0] = max(s[0], t)
                s[1] = agg.add(s[1], *rest[n_keys:])
            if len(states) > held:
                yield out()
        if states:
            yield out()
    return run


def partials(df: DataFrame, ts: str, pane_us: int, keys: list[str], columns: list[str], agg: Aggregate) -> DataFrame:
    """(p, k0.., t, state): states per task, pane start ``p`` and keys, under fixed names."""
    us = to_micros(ts, dict(df.dtypes)[ts])
    rows = df.where(F.col(ts).isNotNull()).select(
        floor_to(us, pane_us).alias("p"), us.alias("t"), *(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)),
        *(F.col(c).alias(f"v{i}") for i, c in enumerate(columns)))
    schema = T.StructType([T.StructField("p", T.LongType()), *(T.StructField(f"k{i}", df.schema[k].dataType) for i, k in enumerate(keys)),
                           T.StructField("t", T.LongType()), T.StructField("state", T.BinaryType())])
    return rows.mapInArrow(partial_states(agg, len(keys)), schema)


def _in_groups(parts: DataFrame, group: list[str], order: list[str], fn, schema: T.StructType) -> DataFrame:
    """``fn`` on each run of equal ``group`` columns as its rows stream by, sorted by group and ``order``.

    ``fn(keys, rows)`` gets an iterator of row tuples and yields result tuples."""
    names = parts.columns
    at = [names.index(g) for g in group]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        it = rows(batches)
        row = next(it, None)

        def pack() -> pa.RecordBatch:
            cols = list(zip(*held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], schema.names)
        while row is not None:
            key, first, after = [row[i] for i in at], row, None

            def same() -> Iterator[tuple]:
                nonlocal after
                yield first
                for r in it:
                    if [r[i] for i in at] != key:
                        after = r
                        return
                    yield r
            for out in fn(key, same()):
                held.append(out)
                if len(held) >= 4096:
                    yield pack()
            row = after
        if held:
            yield pack()
    from pyspark.sql.pandas.types import to_arrow_type
    types = [to_arrow_type(f.dataType) for f in schema]
    placed = parts.repartition(*group).sortWithinPartitions(*group, *order)
    return placed.mapInArrow(run, schema)


def merged(parts: DataFrame, agg: Aggregate, n_keys: int) -> DataFrame:
    """One state per (p, keys)."""
    group = ["p", *(f"k{i}" for i in range(n_keys))]
    schema = T.StructType([parts.schema[g] for g in group] + [T.StructField("state", T.BinaryType())])

    def one(key: list, rows: Iterator[tuple]) -> Iterator[tuple]:
        yield (*key, pickle.dumps(fold(agg, (r[-1] for r in rows))))
    return _in_groups(parts.select(*group, "state"), group, [], one, schema)


def block_values(agg: Aggregate, size_us: int, slide_us: int, block: int, own: list[tuple[int, bytes]], later: list[tuple[int, bytes]]):
    """(first start, last start, value) of the windows that begin in a block.

    ``own`` and ``later``: (pane, state) of this block and the next, by pane."""
    def after(us: int) -> int:
        return us // slide_us * slide_us + slide_us
    lo, hi = (-(-b * size_us // slide_us) * slide_us for b in (block, block + 1))
    prefixes: list[tuple[int, bytes]] = []  # holds from a start on
    for p, s in later:
        prefixes.append((after(p - size_us), pickle.dumps(fold(agg, [prefixes[-1][1], s])) if prefixes else s))
    suffixes: list[tuple[int, bytes]] = []  # holds for starts below
    for p, s in reversed(own):
        suffixes.append((after(p), pickle.dumps(fold(agg, [s, suffixes[-1][1]])) if suffixes else s))
    suffixes.reverse()
    changes = sorted({lo, *(s for s, _ in prefixes if lo <= s < hi), *(s for s, _ in suffixes if s < hi)})
    i = j = 0
    for at, end in zip(changes, [*changes[1:], hi]):
        while i < len(prefixes) and prefixes[i][0] <= at:
            i += 1
        while j < len(suffixes) and suffixes[j][0] <= at:
            j += 1
        parts = [s for _, s in suffixes[j:j + 1] + prefixes[max(i - 1, 0):i]]
        if parts and end > at:
            yield at, end - slide_us, agg.result(fold(agg, parts))


def aggregate_windows(df: DataFrame, ts: str, size, slide, keys, columns, agg: Aggregate, name: str = "value") -> DataFrame:
    """``window_start, window_end, *keys, name``: the value of each window that holds a row.

    ``columns`` are handed to ``add`` in order; ``slide=None`` tumbles."""
    keys, columns = list(keys), list(columns)
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    dtype = dict(df.dtypes)[ts]
    pane_us = gcd(size_us, slide_us)
    panes = merged(partials(df, ts, pane_us, keys, columns, agg), agg, len(keys))
    kn = [f"k{i}" for i in range(len(keys))]
    value = T.StructField("value", T._parse_datatype_string(agg.returns))
    key_fields = [panes.schema[k] for k in kn]
    if slide_us == size_us:
        schema = T.StructType([T.StructField("_w", T.LongType()), *key_fields, value])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_type
            for b in batches:
                got = [agg.result(pickle.loads(s)) for s in b.column("state").to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, to_arrow_type(value.dataType))], schema.names)
        each = panes.mapInArrow(run, schema)
    else:
        own = F.floor(F.col("p") / size_us).cast("long")
        sent = panes.select(F.explode(F.array(F.struct(own.alias("b"), F.lit(0).alias("role")), F.struct((own - 1).alias("b"), F.lit(1).alias("role")))).alias("x"),
                            *kn, "p", "state").select("x.*", *kn, "p", "state")
        schema = T.StructType([T.StructField("_s", T.LongType()), T.StructField("_last", T.LongType()), *key_fields, value])

        def block(key: list, rows: Iterator[tuple]) -> Iterator[tuple]:
            parts: tuple[list, list] = ([], [])
            for r in rows:  # the panes of two blocks at most
                parts[r[1]].append((r[-2], r[-1]))
            for first, last, v in block_values(agg, size_us, slide_us, key[0], *parts):
                yield (first, last, *key[1:], v)
        found = _in_groups(sent.select("b", "role", *kn, "p", "state"), ["b", *kn], ["role", "p"], block, schema)
        each = found.select(*kn, "value", F.explode(F.sequence("_s", "_last", F.lit(slide_us))).alias("_w"))
    return each.select(from_micros("_w", dtype).alias("window_start"), from_micros(F.col("_w") + F.lit(size_us), dtype).alias("window_end"),
                       *(F.col(k).alias(n) for k, n in zip(kn, keys)), F.col("value").alias(name))
