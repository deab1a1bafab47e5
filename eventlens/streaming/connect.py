"""Two connected streams with one keyed state (the reference's ``connect`` and CoProcessFunction).

Both streams become one, tagged by side, and a :class:`CoMachine` sees a
key's rows of both in event-time order, with timers.  A null key is a key
like any other.

``spread`` cuts a key by time, so that a hot one is not replayed in one
task: a row goes home to the bucket of its time and, as a guest, to the
other buckets that lie within ``spread`` of it.  A machine whose decisions
about a row depend on rows within ``spread`` of it alone decides about its
home rows and uses the guests; a row has two places at most.

:func:`reconcile_stream` is J2 on it: rows of equal keys within a
tolerance pair as in SQL, and a row without a partner comes out once the
watermark has passed all it could have had.
"""

from __future__ import annotations

import pickle

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from eventlens.functions.time import duration_us, event_time
from eventlens.session import ship_package
from eventlens.streaming.groups import Logic, dealt, plain_keys, run_groups

LEFT, RIGHT = 0, 1
_STATE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class CoMachine:
    """Subclass it.  Rows are dicts of their side's columns, ``ts`` is in epoch µs, ``home`` tells a row
    from its copies; the carry is any value that pickles.  Results are dicts of ``out`` names."""

    out: tuple = ()  # (name, DDL type); None: the type of the input column of that name
    ordered = True  # False: rows are taken as they come, without waiting for the watermark

    def init(self):
        return {}

    def on_left(self, c, row: dict, ts: int, home: bool) -> list:
        return []

    def on_right(self, c, row: dict, ts: int, home: bool) -> list:
        return []

    def advance(self, c, wm: int) -> list:
        """Every row before ``wm`` has been seen."""
        return []

    def deadline(self, c):
        """The next time at which ``advance`` has something to decide, or None."""
        return None

    def idle(self, c) -> bool:
        return not c


class CoProcess(StatefulProcessor):
    def __init__(self, machine: CoMachine, key_names: list[str], sides: tuple[list[str], list[str]]):
        self.machine, self.key_names, self.sides = machine, key_names, sides

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState("both", T.StructType([T.StructField("blob", T.BinaryType())]))

    def _drain(self, key, wm_ms: int, fresh=(), fired: bool = False):
        raw = self.state.get()
        carry, held, timer = pickle.loads(bytes(raw[0])) if raw else (self.machine.init(), [], None)
        timer = None if fired else timer
        wm = wm_ms * 1000
        held += [r for r in fresh if not (wm_ms > 0 and r[0] < wm)]
        # one instant: left rows first, then in the order of the tie column
        ready = sorted((r for r in held if r[0] < wm or not self.machine.ordered), key=lambda r: (r[0], r[1], r[2]))
        held = [r for r in held if r[0] >= wm] if self.machine.ordered else []
        out = []
        for ts, side, _, home, values in ready:
            step = self.machine.on_left if side == LEFT else self.machine.on_right
            out += step(carry, dict(zip(self.sides[side], values)), ts, home)
        if wm_ms > 0:
            out += self.machine.advance(carry, wm)
        idle = self.machine.idle(carry)
        want = [min(r[0] for r in held) // 1000 + 1] if held else []
        d = None if idle else self.machine.deadline(carry)
        if d is not None:
            want.append(max(-(-d // 1000), wm_ms + 1))
        if want and (timer is None or min(want) < timer):
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = min(want)
            self.handle.registerTimer(timer)
        if idle and not held and timer is None:
            if raw:
                self.state.clear()
        else:
            self.state.update((pickle.dumps((carry, held, timer)),))
        kv = dict(zip(self.key_names, key))
        return iter([Row(**kv, **{n: o.get(n) for n, _ in self.machine.out}) for o in out])

    def handleInputRows(self, key, rows, timerValues):
        fresh = []
        for r in rows:
            side = r["side"]
            prefix = "lr"[side]
            fresh.append((r["us"], side, r["tie"], r["home"], [r[f"{prefix}{i}"] for i in range(len(self.sides[side]))]))
        return self._drain(key, max(timerValues.getCurrentWatermarkInMs(), 0), fresh)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return self._drain(key, timerValues.getCurrentWatermarkInMs(), fired=True)

    def close(self):
        pass


class CoRows(Logic):
    """Both sides' rows, packed by groups of keys."""

    def __init__(self, machine: CoMachine, sides: tuple[list[str], list[str]]):
        super().__init__(machine)
        self.ordered, self.sides = machine.ordered, sides

    def step(self, c, row):
        us, side, _, home, *values = row
        n = len(self.sides[LEFT])
        if side == LEFT:
            return self.machine.on_left(c, dict(zip(self.sides[LEFT], values)), us, home)
        return self.machine.on_right(c, dict(zip(self.sides[RIGHT], values[n:])), us, home)


def _tagged(df: DataFrame, side: int, keys: list, ts: str, tie: str | None, other: DataFrame, spread) -> DataFrame:
    """Rows of one side with both sides' columns, under fixed names, in the buckets they go to."""
    def numbered(d: DataFrame, mark: str, own: bool) -> list[Column]:
        return [(F.col(f"`{f.name}`") if own else F.lit(None).cast(f.dataType)).alias(f"{mark}{i}") for i, f in enumerate(d.schema.fields)]
    l, r = (df, other) if side == LEFT else (other, df)
    tie_col = F.coalesce(F.col(tie).cast("long"), F.lit(-(1 << 63))) if tie else F.lit(0).cast("long")
    x = event_time(df, ts)
    flat = x.select(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.lit(side).alias("side"), F.col(ts).alias("at"),
                    F.unix_micros(F.col(ts)).alias("us"), tie_col.alias("tie"), *numbered(l, "l", side == LEFT), *numbered(r, "r", side == RIGHT))
    if spread is None:
        return flat.withColumns({"bucket": F.lit(0).cast("long"), "home": F.lit(True)})
    us = duration_us(spread)
    width = max(2 * us, 1)
    own = F.floor(F.col("us") / width).cast("long")
    to = F.sequence(F.floor((F.col("us") - F.lit(us)) / width).cast("long"), F.floor((F.col("us") + F.lit(us)) / width).cast("long"))
    return flat.withColumn("bucket", F.explode(to)).withColumn("home", F.col("bucket") == own)


def connect(left: DataFrame, right: DataFrame, left_keys, right_keys, left_ts: str, right_ts: str, machine: CoMachine,
            delay="0 seconds", left_tie: str | None = None, right_tie: str | None = None, spread=None) -> DataFrame:
    """Run ``machine`` per key over both streams: ``left_keys`` (by the left names) and the machine's outputs.

    Rows need an event time; ``delay`` is how far either side may be out of order."""
    spark = left.sparkSession
    ship_package(spark)
    if "RocksDB" not in (spark.conf.get(_STATE, "") or ""):
        spark.conf.set(_STATE, _ROCKS)
    left_keys, right_keys = list(left_keys), list(right_keys)
    sides = [_tagged(left, LEFT, left_keys, left_ts, left_tie, right, spread), _tagged(right, RIGHT, right_keys, right_ts, right_tie, left, spread)]
    schema = sides[0].unionByName(sides[1]).schema
    kn = [f"k{i}" for i in range(len(left_keys))]
    types = {f.name: f.dataType for f in [*left.schema.fields, *right.schema.fields]}
    key_fields = [T.StructField(n, schema[n].dataType) for n in (*kn, "bucket")]
    out_fields = [T.StructField(n, types[n] if t is None else T._parse_datatype_string(t)) for n, t in machine.out]
    # each side has a watermark of its own: the query's is the smaller, so a slow side loses no rows
    if plain_keys(schema, kn):
        order = [*kn, "bucket", "us", "side", "tie", "home"]
        cols = [F.col(n).cast(schema[n].dataType) for n in (*order, *(n for n in schema.names if n not in (*order, "at")))]
        packed = [dealt(x.select(*cols), len(key_fields), delay) for x in sides]
        got = run_groups(packed[0].unionByName(packed[1]), CoRows(machine, (left.columns, right.columns)), key_fields, 3, out_fields)
    else:
        marked = [x.withWatermark("at", f"{duration_us(delay)} microseconds") for x in sides]
        proc = CoProcess(machine, [*kn, "bucket"], (left.columns, right.columns))
        got = (marked[0].unionByName(marked[1]).groupBy(*kn, "bucket")
               .transformWithState(proc, T.StructType(key_fields + out_fields), "Append", "EventTime"))
    return got.select(*(F.col(k).alias(n) for k, n in zip(kn, left_keys)), *(n for n, _ in machine.out))


class Pairing(CoMachine):
    """Every left row with every right row within ``tolerance``, as soon as both are there; others
    alone, once the watermark has passed all partners they could have had."""

    ordered = False

    def __init__(self, tolerance_us: int, left: list[str], right: list[str]):
        self.us, self.left, self.right = tolerance_us, left, right
        self.out = (("outcome", "string"), *((n, None) for n in (*left, *right)))

    def init(self):
        return {LEFT: [], RIGHT: []}

    def _meet(self, c, row: dict, ts: int, home: bool, side: int) -> list:
        out, entry = [], [ts, row, home, False]
        for other in c[RIGHT if side == LEFT else LEFT]:
            if abs(other[0] - ts) <= self.us:
                entry[3] = other[3] = True
                if home if side == LEFT else other[2]:  # a pair comes out where its left row is at home
                    out.append({"outcome": "matched", **row, **other[1]})
        c[side].append(entry)
        return out

    def on_left(self, c, row, ts, home):
        return self._meet(c, row, ts, home, LEFT)

    def on_right(self, c, row, ts, home):
        return self._meet(c, row, ts, home, RIGHT)

    def advance(self, c, wm):
        out = []
        for side, outcome in ((LEFT, "left_only"), (RIGHT, "right_only")):
            over = [e for e in c[side] if e[0] + self.us < wm]
            out += [{"outcome": outcome, **e[1]} for e in over if e[2] and not e[3]]
            c[side] = [e for e in c[side] if e[0] + self.us >= wm]
        return out

    def deadline(self, c):
        times = [e[0] for side in (LEFT, RIGHT) for e in c[side]]
        return min(times) + self.us + 1 if times else None

    def idle(self, c):
        return not c[LEFT] and not c[RIGHT]


def reconcile_stream(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_ts: str, right_ts: str, tolerance,
                     delay="0 seconds", key_name: str = "key") -> DataFrame:
    """``outcome, <key_name>, <left cols>, <right cols>`` as the batch ``reconcile``, null keys and times included.

    A row with a null key or time cannot have a partner: it comes out at once."""
    us = duration_us(tolerance)
    machine = Pairing(us, left.columns, right.columns)
    l, r = event_time(left, left_ts), event_time(right, right_ts)

    def usable(key: str, ts: str) -> Column:
        return F.col(key).isNotNull() & F.col(ts).isNotNull()
    got = connect(l.where(usable(left_key, left_ts)), r.where(usable(right_key, right_ts)),
                  [left_key], [right_key], left_ts, right_ts, machine, delay, spread=us)
    names = [n for n, _ in machine.out[1:]]
    key = F.when(F.col("outcome") == "right_only", F.col(right_key)).otherwise(F.col(left_key)).alias(key_name)

    def alone(df: DataFrame, usable_rows: Column, outcome: str, own: list[str], other: DataFrame, key_col: str) -> DataFrame:
        types = dict(other.dtypes)
        return df.where(~usable_rows).select(F.lit(outcome).alias("outcome"), F.col(key_col).alias(key_name),
                                             *(F.col(n) if n in own else F.lit(None).cast(types[n]).alias(n) for n in names))
    # the key column comes first, under the left name, and again among the outputs
    flat = got.toDF("_key", *got.columns[1:]).select("outcome", key, *names)
    return (flat.unionByName(alone(l, usable(left_key, left_ts), "left_only", l.columns, r, left_key))
            .unionByName(alone(r, usable(right_key, right_ts), "right_only", r.columns, l, right_key)))
