"""Streaming D1-D4, C1, C2 with ``transformWithState`` (event-time timers).

``OrderedReplay`` buffers each key's rows in list state until the
watermark passes them, then replays them in (ts, seq) order through a
machine from :mod:`eventlens.streaming.machines`; the machine's carry
lives in value state.  Each key holds at most one timer -- at its
earliest buffered row (+1 ms) or the machine's deadline -- so a key costs
one timer call per micro-batch, not one per row; results come out as
soon as the watermark allows and state is dropped when a key goes idle.  Rows older
than the watermark on arrival are late and dropped, as Spark's own
stateful operators do.

Event times cross the JVM/Python boundary as epoch microseconds (longs),
so no Python-side time zone is involved.  State lives in the RocksDB
provider; the checkpoint goes under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from eventlens.functions.time import duration_us, event_time
from eventlens.session import ship_package
from eventlens.streaming import machines as M
from eventlens.streaming.groups import Logic, Relay, coded, dealt, plain_keys, pylist, run_groups, typed

_DDL = {"long": LongType(), "string": StringType()}

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


class OrderedReplay(StatefulProcessor):
    def __init__(self, machine: M.Machine, key_names: list, payload_types: dict, event_time_field=None, chained: bool = False):
        self.machine = machine
        self.chained = chained  # rows come from a stateful operator, which releases them as the watermark passes them
        self.key_names = list(key_names)
        self.payload = list(machine.fields)
        self.payload_types = payload_types
        self.event_time_field = event_time_field

    def init(self, handle):
        self.handle = handle
        buf = StructType([StructField("ts", LongType()), StructField("seq", LongType())] +
                         [StructField(f, self.payload_types[f]) for f in self.payload])
        self.buf = handle.getListState("buf", buf)
        # one value per key: machine carry, pending timer and buffer size as JSON,
        # so a key costs a handful of state calls per micro-batch
        self.state = handle.getValueState("state", StructType([StructField("json", StringType())]))

    def _rows_out(self, key, outs):
        kv = dict(zip(self.key_names, key))
        et = self.event_time_field
        for o in outs:
            vals = {n: o.get(n) for n, _ in self.machine.out_fields}
            if et is not None and vals[et] is not None:
                # a zone-aware instant converts exactly, whatever the worker's zone
                vals[et] = _EPOCH + timedelta(microseconds=vals[et])
            yield Row(**kv, **vals)

    def _drain(self, key, wm_ms: int, fresh=(), fired: bool = False):
        wm = wm_ms * 1000
        raw = self.state.get()
        st = json.loads(raw[0]) if raw else {"m": self.machine.init(), "tm": None, "nb": 0}
        if fired:
            st["tm"] = None
        pending = (list(self.buf.get()) if st["nb"] else []) + list(fresh)
        ready = sorted((r for r in pending if r[0] < wm), key=lambda r: (r[0], r[1] if r[1] is not None else 0))
        rest = [r for r in pending if r[0] >= wm] if ready else pending
        c = st["m"]
        outs = []
        for r in ready:
            outs += self.machine.step(c, dict(zip(["ts", "seq", *self.payload], r)))
        if wm_ms > 0:
            outs += self.machine.advance(c, wm)
        if ready or fresh:
            if rest:
                self.buf.put(rest)
            elif st["nb"]:
                self.buf.clear()
        st["nb"] = len(rest)
        # one timer per key: the earliest buffered row (+1 ms) or the deadline
        want = [min(r[0] for r in rest) // 1000 + 1] if rest else []
        idle = self.machine.idle(c)
        d = None if idle else self.machine.deadline(c)
        if d is not None:
            want.append(-(-d // 1000))
        if want and (st["tm"] is None or min(want) < st["tm"]):
            if st["tm"] is not None:
                self.handle.deleteTimer(st["tm"])
            st["tm"] = min(want)
            self.handle.registerTimer(st["tm"])
        if idle and not rest and st["tm"] is None:
            if raw:
                self.state.clear()
        else:
            st["m"] = c if not idle else self.machine.init()
            self.state.update((json.dumps(st),))
        return self._rows_out(key, outs)

    def handleInputRows(self, key, rows, timerValues):
        wm_ms = timerValues.getCurrentWatermarkInMs()
        fresh = []
        for r in rows:
            t = r["evl_ts_us"]
            if wm_ms > 0 and t < wm_ms * 1000 and not self.chained:
                continue  # late
            fresh.append((t, r["evl_seq"], *[r[f] for f in self.payload]))
        return self._drain(key, max(wm_ms, 0), fresh)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return self._drain(key, timerValues.getCurrentWatermarkInMs(), fired=True)

    def close(self):
        pass


class MachineRows(Logic):
    """A machine's rows, packed by groups of keys."""

    def __init__(self, machine: M.Machine):
        super().__init__(machine)
        self.names = ("ts", "seq", *machine.fields)

    def step(self, c, row):
        return self.machine.step(c, dict(zip(self.names, row)))

    def run(self, carries, rows, n, n_order, schema):
        columns = M.of_step(self.machine, "columns")
        if columns is None:
            return super().run(carries, rows, n, n_order, schema)
        code = coded(rows, n)
        order = np.lexsort([*(rows.column(i).to_numpy() for i in reversed(range(n, n + n_order))), code])
        starts = np.flatnonzero(np.diff(code[order], prepend=-1))
        rows = rows.take(pa.array(order))
        keys = rows.select(range(n)).take(pa.array(starts))
        own = []
        for key in zip(*(pylist(c) for c in keys.columns)) if n else [()]:
            if key not in carries:
                carries[key] = self.machine.init()
            own.append(carries[key])
        at, got = columns(M.Runs(own, starts, dict(zip(self.names, rows.columns[n:]))))
        keys = keys.take(pa.array(at))
        return pa.table([typed(keys.column(i) if i < n else got[f.name], f.type) for i, f in enumerate(schema)], schema=schema)


def replay(df: DataFrame, keys, ts: str, seq, delay, machine: M.Machine, payload: dict,
            event_time_field: str | None = None, then: tuple | None = None) -> DataFrame:
    """Run ``machine`` per key over a watermarked stream; returns key columns +
    the machine's outputs (``*_ts`` longs turned back into timestamps).

    This is the user-level form of a keyed process function: subclass
    :class:`eventlens.streaming.machines.Machine` (``step`` per row in
    event-time order, ``advance`` when the watermark moves, ``deadline`` for
    timers) and pass the payload columns it reads.

    ``event_time_field`` names an output that becomes the event time of the
    result (``eventTimeColumnName``), so a windowed aggregation can follow.

    ``then`` (a machine, the outputs it takes as time, tiebreak and payload, and the
    output and value that tell which results go on) runs under the keys but the last
    on the results of ``machine``; it needs plain keys and a delay."""
    keys = list(keys)
    spark = df.sparkSession
    ship_package(spark)
    # transformWithState runs on the RocksDB state store only
    prov = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in (spark.conf.get(prov, "") or ""):
        spark.conf.set(prov, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    x = event_time(df, ts)
    packed = delay is not None and plain_keys(x.schema, keys)
    if delay is not None and not packed:  # None: the event time of a stateful operator before
        x = x.withWatermark(ts, delay)
    if seq and seq not in df.columns:
        raise ValueError(f"no tiebreak column {seq}; pass seq=None if event times never tie")
    # a null tiebreak sorts first, as in batch
    seq_col = F.coalesce(F.col(seq).cast("long"), F.lit(-(1 << 63))) if seq else F.lit(0).cast("long")
    x = x.select(*keys, F.col(ts), F.unix_micros(F.col(ts)).alias("evl_ts_us"), seq_col.alias("evl_seq"),
                 *[c.alias(n) for n, c in payload.items()])
    types = {f.name: f.dataType for f in x.schema.fields}
    key_fields = [StructField(k, types[k]) for k in keys]

    def fields(m):
        return [StructField(n, TimestampType() if n == event_time_field else types[n] if t is None else _DDL[t]) for n, t in m.out_fields]
    out_fields = fields(machine)
    if then and not packed:
        raise ValueError("a second machine needs plain keys and a delay")
    if packed:
        only = M.of_step(machine, "only")
        need = [reduce(or_, (F.col(f) for f in only))] if only else []
        rows = dealt(x.select(*keys, "evl_ts_us", "evl_seq", *machine.fields, *need), len(keys), delay, need=bool(need))
        if then:
            second, sent, (keep, value) = then
            at = {f.name: len(keys) + i for i, f in enumerate(out_fields)}
            relay = Relay([*range(len(keys) - 1), *(at[c] for c in sent)], len(keys) - 1, at[keep], value)
            rows = run_groups(rows, MachineRows(machine), key_fields, 2, out_fields, event_time_field, relay)
            out = run_groups(rows, MachineRows(second), key_fields[:-1], 2, fields(second), event_time_field, chained=True)
            machine = second
        else:
            out = run_groups(rows, MachineRows(machine), key_fields, 2, out_fields, event_time_field)
    else:
        # the Row interface: a pandas frame per key costs more where machines emit many rows
        proc = OrderedReplay(machine, keys, {n: types[n] for n in machine.fields}, event_time_field, delay is None)
        out = x.groupBy(*keys).transformWithState(proc, StructType(key_fields + out_fields), "Append", "EventTime",
                                                  eventTimeColumnName=event_time_field or "")
    for n, t in machine.out_fields:
        if n != event_time_field and t == "long" and (n.endswith("_ts") or n == "ts_out"):
            out = out.withColumn(n, F.timestamp_micros(n))
    return out


def stream_consecutive_pairs(df, keys, is_event, within, ts="ts", seq="seq", delay="0 seconds"):
    """Streaming D3 / C1."""
    return replay(df, keys, ts, seq, delay, M.Pairs(duration_us(within)), {"m": is_event})


def stream_fail_bursts(df, keys, is_fail, span, min_count=2, ts="ts", seq="seq", delay="0 seconds"):
    """Streaming D2."""
    return replay(df, keys, ts, seq, delay, M.Bursts(duration_us(span), min_count), {"f": is_fail})


def stream_followed_by(df, keys, first, then, within, ts="ts", seq="seq", delay="0 seconds"):
    """Streaming C2: timeouts come out when the watermark passes first + within."""
    return replay(df, keys, ts, seq, delay, M.FollowedBy(duration_us(within)), {"a": first, "b": then})


def stream_match_outcomes(df, keys, is_create, is_pay, bound, grace=None, ts="ts", seq="seq",
                          delay="0 seconds"):
    """Streaming D4.  Only create/pay rows are kept -- before the watermark,
    so only they advance it (Catalyst would push the filter there anyway).
    With ``grace=None`` a create with no following row never times out on a
    stream (a pay may still come); give a finite grace to close it."""
    kept = df.filter(is_create | is_pay)
    g = None if grace is None else duration_us(grace)
    return replay(kept, keys, ts, seq, delay, M.MatchOutcomes(duration_us(bound), g), {"cr": is_create})


def _deal(ts, seq, slices):
    return F.pmod(F.xxhash64(F.col(ts), *([F.col(seq)] if seq else [F.lit(0)])), F.lit(int(slices))).cast("int")


def stream_click_cap(df, keys, cap=100, ts="ts", seq="seq", delay="0 seconds", carry=(), slices=None):
    """Streaming D1: tagged rows ``passed`` / ``warning`` per (keys, UTC day).

    Returns ``*keys, day, tag, ts, seq, *carry``; ``ts`` is the result's
    event time.  Split with :func:`eventlens.sources.sinks.split_by_tag` or
    a tagged sink.

    ``slices`` deals the rows of each key by hash first: every (key, slice)
    forwards its first cap + 1 rows of a day, and only those meet in the key.
    A row beyond them is beyond cap + 1 of the key, too, so the result is the
    same, and a hot key reaches no task whole.  Forwarded rows go on packed by groups of keys,
    and a key takes its rows as columns (keys of floating or nested types: row by row).
    """
    x = event_time(df, ts)
    sliced = delay is not None and plain_keys(x.schema, keys)
    if slices and not sliced:
        names = [c for c in df.columns if c not in keys and c not in (ts, seq)]
        day = F.unix_micros(F.date_trunc("day", F.col(ts)))
        first = replay(x.withColumn("evl_slice", _deal(ts, seq, slices)), [*keys, "evl_slice"], ts, seq, delay, M.Cap(cap + 1, names),
                       {"day": day, **{c: F.col(c) for c in names}}, event_time_field="ts_out")
        few = first.where(F.col("tag") == "passed").select(
            *keys, F.col("ts_out").alias(ts), *([F.col("seq_out").alias(seq)] if seq else []), *names)
        return stream_click_cap(few, keys, cap, ts, seq, None, carry)
    # keyed by ``keys`` only; the machine resets its count at each UTC day
    # (rows replay in time order), so state is one small value per key
    day = F.unix_micros(F.date_trunc("day", F.col(ts)))
    carry = [c for c in carry if c not in keys]
    payload = {"day": day, **{c: F.col(c) for c in carry}}
    if slices:
        out = replay(x.withColumn("evl_slice", _deal(ts, seq, slices)), [*keys, "evl_slice"], ts, seq, delay, M.Cap(cap + 1, carry), payload,
                     event_time_field="ts_out", then=(M.Cap(cap, carry), ("ts_out", "seq_out", "day_out", *carry), ("tag", "passed")))
    else:
        out = replay(x, list(keys), ts, seq, delay, M.Cap(cap, carry), payload, event_time_field="ts_out")
    return out.select(*keys, F.timestamp_micros("day_out").alias("day"), "tag",
                      F.col("ts_out").alias("ts"), F.col("seq_out").alias("seq"), *carry)


def stream_capped_window_counts(df, cap_keys, count_keys, size, slide=None, cap=100, ts="ts", seq="seq",
                                delay="0 seconds", carry=()) -> DataFrame:
    """Streaming D1b: passed rows of the cap feed a windowed count in the same
    query (the cap's output carries event time).  ``count_keys`` not among
    ``cap_keys`` travel through the cap as carried columns."""
    from eventlens.streaming.windows import stream_window_counts
    carry = list(carry) + [k for k in count_keys if k not in cap_keys and k not in carry]
    capped = stream_click_cap(df, cap_keys, cap, ts, seq, delay, carry=carry)
    passed = capped.filter(F.col("tag") == "passed")
    return stream_window_counts(passed, "ts", size, slide, count_keys, delay=None)
