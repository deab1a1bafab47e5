"""Keyed state where keys are many: keys are dealt into groups, and the keys of a group share their state.

An engine call per key and micro-batch (rows, state, timers) costs far more
than the work on a key's few rows.  So each task packs its rows by group
into Arrow streams (``dealt``), and only those are shuffled, buffered and
handed to Python: :class:`KeyGroups` keeps a group's streams as they came
until the watermark passes their rows, replays the ready rows in order,
each with the carry of its own key, and holds one timer.  The number of
engine calls follows the groups, not the keys or rows; a group's rows are a
thousandth of a micro-batch unless one key has more.  Results leave as one
frame per call, and machines that know how (``columns``) take a group's rows
as columns instead of one by one.  A second operator under fewer keys can
take a first one's results the same way, packed by its own groups
(:class:`Relay`).

The engine's watermark lies a millisecond behind the stream's, so that it
drops no packed row that is in time; late rows are dropped one by one here.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from eventlens.functions.time import duration_us

#: Groups of keys of a query; fixed, as a restart must find its state again.
GROUPS = 1024
#: Rows that a task packs at a time, and rows of one packed stream at most.
HELD, PACKED = 1 << 18, 1 << 12

_PLAIN = {"tinyint", "smallint", "int", "bigint", "string", "boolean", "date", "binary"}
#: A packed stream: its group, the newest time of its rows, the rows.
PACKET = ["evl_group", "us", "rows"]
_PACKET = T.StructType([T.StructField("evl_group", T.IntegerType()), T.StructField("at", T.TimestampType()), T.StructField("rows", T.BinaryType())])
_BLOB = T.StructType([T.StructField("blob", T.BinaryType())])


def plain_keys(schema: T.StructType, keys) -> bool:
    """Whether Python tells the keys apart as the engine does (not so -0.0, NaN, nested values)."""
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    return all(types[k] in _PLAIN or types[k].startswith("decimal") for k in keys)


def _encode(rows: pa.RecordBatch | pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as w:
        w.write(rows)
    return sink.getvalue().to_pybytes()


def _decode(blob) -> pa.Table:
    return pa.ipc.open_stream(bytes(blob)).read_all()


def by_group(rows: pa.Table, group: np.ndarray, us_at: int, newest: int) -> pa.RecordBatch:
    """Rows packed by group: (group, newest time, rows), the last of them under the time ``newest``."""
    order = np.argsort(group, kind="stable")
    group = group[order]
    rows = rows.take(pa.array(order)).combine_chunks()
    us = rows.column(us_at).to_numpy()
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    cuts = [at for lo, hi in zip(starts, [*starts[1:], len(group)]) for at in range(lo, hi, PACKED)]
    spans = list(zip(cuts, [*cuts[1:], len(group)]))
    times = [*(us[lo:hi].max() for lo, hi in spans[:-1]), newest]
    return pa.RecordBatch.from_arrays(
        [pa.array([group[lo] for lo, _ in spans], pa.int32()), pa.array(times, pa.int64()),
         pa.array([_encode(rows.slice(lo, hi - lo)) for lo, hi in spans], pa.binary())], PACKET)


def packer(us_at: int, need_at: int | None = None):
    """A mapInArrow function: rows (columns, group) -> (group, newest time, rows), per task.

    Rows whose column ``need_at`` is not true stay behind, but their times count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            t = t.cast(pa.schema([pa.field(f.name, f.type) for f in t.schema]))  # the same fields for all sides of a union
            held.clear()
            if t.column(us_at).null_count:
                raise ValueError("a row has no event time")
            newest = pc.max(t.column(us_at)).as_py()
            group = t.column(t.num_columns - 1).to_numpy()
            rows = t.remove_column(t.num_columns - 1)
            if need_at is not None:
                need = pc.fill_null(rows.column(need_at), False).to_numpy()
                rows = rows.remove_column(need_at)
                if not need.any():
                    return pa.RecordBatch.from_arrays([pa.array(group[:1], pa.int32()), pa.array([newest], pa.int64()),
                                                       pa.array([_encode(rows.slice(0, 0))], pa.binary())], PACKET)
                group, rows = group[need], rows.filter(pa.array(need))
            return by_group(rows, group, us_at, newest)
        n = 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= HELD:
                yield out()
                n = 0
        if held:
            yield out()
    return run


def dealt(rows: DataFrame, n_keys: int, delay, groups: int = GROUPS, need: bool = False) -> DataFrame:
    """``evl_group, at, rows`` with a watermark on ``at``, from rows of (keys, epoch µs, others).

    With ``need``, the last column tells which rows go on; the others only move the watermark."""
    x = rows.toDF(*(f"c{i}" for i in range(len(rows.columns))))
    keys = [F.col(f"c{i}") for i in range(n_keys)]
    x = x.withColumn("evl_group", F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int") if keys else F.lit(0))
    packed = x.mapInArrow(packer(n_keys, len(rows.columns) - 1 if need else None), "evl_group int, us long, rows binary")
    return (packed.select("evl_group", F.timestamp_micros("us").alias("at"), "rows")
            .withWatermark("at", f"{duration_us(delay) + 1000} microseconds"))


def pylist(c: pa.ChunkedArray) -> list:
    """As ``to_pylist``, which makes a scalar of each value."""
    if c.null_count == 0 and (pa.types.is_integer(c.type) or pa.types.is_boolean(c.type)):
        return c.to_numpy().tolist()
    return c.to_pylist()


def coded(t: pa.Table, n: int) -> np.ndarray:
    """A number from 0 for each different value of the first ``n`` columns, row by row."""
    code = np.zeros(t.num_rows, np.int64)
    for i in range(n):
        one = t.column(i).combine_chunks().dictionary_encode(null_encoding="encode")
        code = code * len(one.dictionary) + one.indices.to_numpy()
        code = np.unique(code, return_inverse=True)[1] if i else code
    return code


class Logic:
    """What a group does with the rows of a key; the carry is any value that pickles."""

    ordered = True  # False: rows are taken as they come, without waiting for the watermark

    def __init__(self, machine):
        self.machine = machine

    def step(self, c, row: tuple) -> list:
        """``row``: epoch µs and the columns after it."""
        raise NotImplementedError

    def run(self, carries: dict, rows: pa.Table, n: int, n_order: int, schema: pa.Schema) -> pa.Table:
        """Results of ``rows`` (``n`` keys, ``n_order`` columns of their order, others)."""
        order = np.lexsort([rows.column(i).to_numpy() for i in reversed(range(n, n + n_order))])
        outs: list[tuple] = []
        for b in rows.take(pa.array(order)).to_batches(max_chunksize=1 << 16):
            for row in zip(*(pylist(pa.chunked_array([c])) for c in b.columns)):
                key = row[:n]
                c = carries.get(key)
                if c is None:
                    c = carries[key] = self.machine.init()
                for o in self.step(c, row[n:]):
                    outs.append((key, o))
        return as_table(outs, n, schema)


def typed(values, kind: pa.DataType):
    """Values as a column of a type; instants may be epoch µs."""
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        return values if values.type == kind else values.cast(kind)
    if pa.types.is_timestamp(kind) and (isinstance(values, np.ndarray) or any(isinstance(v, int) for v in values)):
        return pa.array(values, pa.int64()).cast(kind)
    return pa.array(values, kind)


def as_table(outs: list[tuple], n: int, schema: pa.Schema) -> pa.Table:
    """Pairs of key and result as columns."""
    return pa.table([typed([k[i] for k, _ in outs] if i < n else [o.get(f.name) for _, o in outs], f.type) for i, f in enumerate(schema)], schema=schema)


class Relay:
    """Packs results for an operator that follows under keys of its own: those whose column ``keep`` has ``value``.

    ``columns``: places of what it takes, its keys, the time, others."""

    def __init__(self, columns: list[int], n_keys: int, keep: int, value, groups: int = GROUPS):
        self.columns, self.n_keys, self.keep, self.value, self.groups = columns, n_keys, keep, value, groups

    def __call__(self, t: pa.Table) -> pa.Table:
        n = self.n_keys
        t = t.filter(pc.equal(t.column(self.keep), self.value)).select(self.columns)
        if not t.num_rows:
            return t
        t = t.set_column(n, "us", t.column(n).cast(pa.int64()))
        code = coded(t, n)
        keys = t.select(range(n)).take(pa.array(np.unique(code, return_index=True)[1]))
        # of the values themselves, so that all tasks agree
        own = [zlib.crc32(repr(k).encode()) % self.groups for k in (zip(*(pylist(c) for c in keys.columns)) if n else [()])]
        group, us, rows = by_group(t, np.array(own, np.int32)[code], n, pc.max(t.column(n)).as_py()).columns
        return pa.table([group, us.cast(pa.timestamp("us", "UTC")), rows], names=_PACKET.names)


class KeyGroups(StatefulProcessor):
    """``n_order``: the columns from the time on that give the order of rows (numbers, no nulls).

    ``relay`` packs the results; ``chained``: rows come from a relay, as the watermark passes them."""

    def __init__(self, logic: Logic, key_names: list[str], n_order: int, schema: pa.Schema, relay: Relay | None = None, chained: bool = False):
        self.logic, self.key_names, self.n_order, self.schema = logic, list(key_names), n_order, schema
        self.relay, self.chained = relay, chained

    def init(self, handle):
        self.handle = handle
        self.rows = handle.getListState("rows", _BLOB)
        self.keys = handle.getValueState("keys", _BLOB)  # carries by key, the timer, the oldest buffered time

    def _us(self, t: pa.Table) -> pa.ChunkedArray:
        return t.column(len(self.key_names))

    def _ready(self, fresh: list[pa.Table], oldest: int | None, wm: int) -> tuple[list[pa.Table], int | None]:
        """Rows to replay now, and the oldest time that stays buffered."""
        if not self.logic.ordered:
            return fresh, None
        if self.chained:
            return self._released(fresh, oldest, wm)
        if oldest is None or oldest >= wm:  # fresh rows are not older than the watermark either
            if fresh:
                self.rows.appendList([(_encode(t),) for t in fresh])
            return [], min([pc.min(self._us(t)).as_py() for t in fresh] + ([] if oldest is None else [oldest]), default=None)
        held = pa.concat_tables([_decode(r[0]) for r in self.rows.get()])
        over = pc.less(self._us(held), wm)
        rest = held.filter(pc.invert(over)).combine_chunks()
        fresh = ([rest] if rest.num_rows else []) + fresh
        if fresh:
            self.rows.put([(_encode(t),) for t in fresh])
        else:
            self.rows.clear()
        return [held.filter(over)], min((pc.min(self._us(t)).as_py() for t in fresh), default=None)

    def _released(self, fresh: list[pa.Table], oldest: int | None, wm: int) -> tuple[list[pa.Table], int | None]:
        """``_ready`` where fresh rows may be over already; none that come later are older than they."""
        if not fresh and (oldest is None or oldest >= wm):
            return [], oldest
        rows = pa.concat_tables([*(_decode(r[0]) for r in (self.rows.get() if oldest is not None else ())), *fresh])
        over = pc.less(self._us(rows), wm)
        rest = rows.filter(pc.invert(over)).combine_chunks()
        if rest.num_rows:
            self.rows.put([(_encode(rest),)])
        elif oldest is not None:
            self.rows.clear()
        ready = rows.filter(over)
        return [ready] if ready.num_rows else [], pc.min(self._us(rest)).as_py()

    def _drain(self, wm_ms: int, blobs=(), fired: bool = False):
        raw = self.keys.get()
        carries, timer, oldest = pickle.loads(bytes(raw[0])) if raw else ({}, None, None)
        timer = None if fired else timer
        wm_ms = wm_ms + 1 if wm_ms > 0 else 0
        wm = wm_ms * 1000
        fresh = [_decode(b) for b in blobs]
        if wm and not self.chained:
            fresh = [t.filter(pc.greater_equal(self._us(t), wm)) for t in fresh]
        ready, oldest = self._ready([t for t in fresh if t.num_rows], oldest, wm)
        logic, machine, n = self.logic, self.logic.machine, len(self.key_names)
        found = []
        if ready:
            found.append(logic.run(carries, pa.concat_tables(ready), n, self.n_order, self.schema))
        outs: list[tuple] = []
        want = [] if oldest is None else [oldest // 1000 + 1]
        live, due = {}, None
        for key, c in carries.items():
            if wm:
                outs += [(key, o) for o in machine.advance(c, wm)]
            if machine.idle(c):
                continue
            live[key] = c
            d = machine.deadline(c)
            if d is not None and (due is None or d < due):
                due = d
        if due is not None:
            want.append(max(-(-due // 1000), wm_ms + 1))
        at = min(want) - 1 if want else None  # on the engine's clock
        if at != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if at is not None:
                self.handle.registerTimer(at)
        if live or oldest is not None:
            self.keys.update((pickle.dumps((live, at, oldest)),))
        elif raw:
            self.keys.clear()
        if outs:
            found.append(as_table(outs, n, self.schema))
        if self.relay is not None:
            found = [self.relay(t) for t in found]
        return (t.to_pandas(types_mapper=pd.ArrowDtype) for t in found if t.num_rows)

    def handleInputRows(self, key, rows, timerValues):
        return self._drain(max(timerValues.getCurrentWatermarkInMs(), 0), [b for r in rows for b in r["rows"]])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return self._drain(timerValues.getCurrentWatermarkInMs(), fired=True)

    def close(self):
        pass


def run_groups(packed: DataFrame, logic: Logic, key_fields: list[T.StructField], n_order: int, out_fields: list[T.StructField],
               event_time_field: str | None = None, relay: Relay | None = None, chained: bool = False) -> DataFrame:
    """Key columns and outputs of ``logic`` over ``dealt`` rows, or (``chained``) over those of an operator with a ``relay``."""
    out = T.StructType([*key_fields, *out_fields])
    schema = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in out.fields])
    proc = KeyGroups(logic, [f.name for f in key_fields], n_order, schema, relay, chained)
    if relay is not None:
        out, event_time_field = _PACKET, "at"
    return packed.groupBy("evl_group").transformWithStateInPandas(proc, out, "Append", "EventTime", eventTimeColumnName=event_time_field or "")
