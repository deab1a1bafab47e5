"""User-written aggregates on streams, with early results and refinements (A1, A2, T4).

Each micro-batch is folded into states per task, pane and key first; only
states reach the keyed state, so a key with most of the rows costs it one
state per task and pane.  A key keeps the states of the panes that an
open window still needs, in one value, and one timer.

A window is emitted when the watermark (newest time less ``delay``)
passes its end, and again, as a refinement, after every micro-batch that
brings it a late row, until the watermark passes its end by ``lateness``.
A row all whose windows are over by then is dropped.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from math import gcd

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from eventlens.functions.time import duration_us, event_time
from eventlens.operators.aggregates import Aggregate, fold, partials
from eventlens.operators.topn import top_n_per_window
from eventlens.session import drop_path, ship_package

_STATE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class WindowStates(StatefulProcessor):
    """Panes of one key; all times in epoch µs but the engine's, which are ms."""

    def __init__(self, agg: Aggregate, key_names: list[str], size: int, slide: int, lateness: int, slack_ms: int):
        self.agg, self.key_names = agg, key_names
        self.size, self.slide, self.lateness, self.slack_ms = size, slide, lateness, slack_ms

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState("panes", T.StructType([T.StructField("blob", T.BinaryType())]))

    def _ends(self, pane: int) -> range:
        """Ends of the windows that hold a pane."""
        last = pane // self.slide * self.slide
        first = (pane - self.size) // self.slide * self.slide + self.slide
        return range(first + self.size, last + self.size + 1, self.slide)

    def _value(self, panes: dict[int, bytes], order: list[int], end: int):
        held = order[bisect_left(order, end - self.size):bisect_left(order, end)]
        return self.agg.result(fold(self.agg, (panes[p] for p in held)))

    def _drain(self, key, wm_ms: int, rows=(), fired_timer: bool = False):
        now = (wm_ms + self.slack_ms) * 1000 if wm_ms > 0 else None
        raw = self.state.get()
        panes, fired, timer = pickle.loads(bytes(raw[0])) if raw else ({}, None, None)
        if fired_timer:
            timer = None
        out = []

        def emit(ends: set[int], refined: bool) -> None:
            order = sorted(panes)
            for e in sorted(ends):
                out.append(Row(**dict(zip(self.key_names, key)), w=e - self.size, value=self._value(panes, order, e), refined=refined))
        if now is not None:  # windows that close, from the rows that came in time
            emit({e for p in panes for e in self._ends(p) if e <= now and (fired is None or e > fired)}, False)
        touched = set()
        for r in rows:
            p = r["p"]
            if now is not None and self._ends(p)[-1] + self.lateness <= now:
                continue  # late for all its windows
            s = bytes(r["state"])
            panes[p] = pickle.dumps(fold(self.agg, [panes[p], s])) if p in panes else s
            touched.add(p)
        if now is not None:
            emit({e for p in touched for e in self._ends(p) if e <= now < e + self.lateness}, True)
            fired = now if fired is None else max(fired, now)
            for p in [p for p in panes if self._ends(p)[-1] + self.lateness <= now]:
                del panes[p]
        if not panes:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if raw:
                self.state.clear()
            return iter(out)
        # the next window to close, or the next pane that no window needs
        want = [next(e for e in self._ends(p) if fired is None or e > fired) for p in panes if fired is None or self._ends(p)[-1] > fired]
        want += [self._ends(p)[-1] + self.lateness for p in panes]
        at = -(-min(want) // 1000) - self.slack_ms
        if timer is None or at < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = at
            self.handle.registerTimer(timer)
        self.state.update((pickle.dumps((panes, fired, timer)),))
        return iter(out)

    def handleInputRows(self, key, rows, timerValues):
        return self._drain(key, timerValues.getCurrentWatermarkInMs(), list(rows))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return self._drain(key, timerValues.getCurrentWatermarkInMs(), fired_timer=True)

    def close(self):
        pass


def stream_aggregate(df: DataFrame, ts: str, size, slide, keys, columns, agg: Aggregate, delay="0 seconds",
                     lateness="0 seconds", name: str = "value") -> DataFrame:
    """``window_start, window_end, *keys, name, refined``: each window when it closes (``refined`` false) and
    again after late rows within ``lateness``."""
    spark = df.sparkSession
    ship_package(spark)
    if "RocksDB" not in (spark.conf.get(_STATE, "") or ""):
        spark.conf.set(_STATE, _ROCKS)
    keys, columns = list(keys), list(columns)
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    late_us = duration_us(lateness)
    parts = partials(event_time(df, ts), ts, gcd(size_us, slide_us), keys, columns, agg)
    # the engine's own watermark lies behind by all that a live row may be late, so it drops none
    slack_ms = -(-(late_us + size_us) // 1000) + 1
    parts = parts.withColumn("at", F.timestamp_micros("t")).withWatermark("at", f"{duration_us(delay) + slack_ms * 1000} microseconds")
    kn = [f"k{i}" for i in range(len(keys))]
    if not kn:
        parts, kn = parts.withColumn("k0", F.lit(0)), ["k0"]
    schema = T.StructType([*(T.StructField(k, parts.schema[k].dataType) for k in kn), T.StructField("w", T.LongType()),
                           T.StructField("value", T._parse_datatype_string(agg.returns)), T.StructField("refined", T.BooleanType())])
    proc = WindowStates(agg, kn, size_us, slide_us, late_us, slack_ms)
    out = parts.select(*kn, "p", "at", "state").groupBy(*kn).transformWithState(proc, schema, "Append", "EventTime")
    return out.select(F.timestamp_micros("w").alias("window_start"), F.timestamp_micros(F.col("w") + F.lit(size_us)).alias("window_end"),
                      *(F.col(k).alias(n) for k, n in zip(kn, keys)), F.col("value").alias(name), "refined")


# ---- N2 with refinements ---------------------------------------------------------------


def _batches(spark, root: str) -> list[int]:
    """Numbers of the batches under ``root`` that were written to their end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/batch=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def rank_again(new: DataFrame, last: DataFrame, key: str, n: int, cnt: str) -> tuple[DataFrame, DataFrame]:
    """(rankings of the windows that ``new`` touches, rows of ``last`` of all other windows).

    Joins are by shuffle: counts and windows grow with the stream, and a broadcast would bring them to the driver."""
    touched = new.select("window_end").distinct().hint("shuffle_merge")
    last = last.select(*new.columns)
    # counts only grow, so the newest of a key is its largest
    cand = (new.unionByName(last.join(touched, "window_end", "left_semi").select(*new.columns))
            .groupBy("window_start", "window_end", key).agg(F.max(cnt).alias(cnt)))
    return top_n_per_window(cand, key, n, cnt), last.join(touched, "window_end", "left_anti").select(*new.columns)


def start_refined_topn(counts: DataFrame, key: str, n: int, out_path: str, lateness, checkpoint: str | None = None,
                       trigger: dict | None = None, cnt: str = "cnt"):
    """N2 on counts that late rows refine: every micro-batch logs the new ranking of each window it touches.

    ``counts``: ``window_start, window_end, key, cnt`` of windows that closed or were refined; counts
    only grow, so a window's new top n lies in its last ranking and the changed counts.  The log is
    ``{out_path}/log/batch=<id>``, a retried batch overwrites its own; ``open`` carries the last rankings of
    windows that may still be refined."""
    late_us = duration_us(lateness)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # a window that closes and takes late rows in one micro-batch is ranked once
        new = batch.groupBy("window_start", "window_end", key).agg(F.max(cnt).alias(cnt)).persist()
        try:
            earlier = [b for b in _batches(spark, f"{out_path}/open") if b < batch_id]
            if earlier:
                ranked, rest = rank_again(new, spark.read.parquet(f"{out_path}/open/batch={earlier[-1]}"), key, n, cnt)
            else:
                ranked, rest = top_n_per_window(new, key, n, cnt), None
            ranked.write.mode("overwrite").parquet(f"{out_path}/log/batch={batch_id}")
            ranked = spark.read.parquet(f"{out_path}/log/batch={batch_id}").select(*new.columns)
            held = ranked if rest is None else ranked.unionByName(rest)
            newest = held.agg(F.max(F.unix_micros("window_end"))).first()[0]
            if newest is not None:  # windows that ended too long before the newest closed one take no more rows
                held = held.where(F.unix_micros("window_end") + F.lit(late_us) > F.lit(newest))
            held.write.mode("overwrite").parquet(f"{out_path}/open/batch={batch_id}")
            if len(earlier) > 1:
                drop_path(spark, f"{out_path}/open/batch={earlier[0]}")
        finally:
            new.unpersist()
    ship_package(counts.sparkSession)
    w = (counts.writeStream.outputMode("append").foreachBatch(write)
         .option("checkpointLocation", checkpoint or f"{out_path.rstrip('/')}-checkpoint"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def ranking_log(spark, out_path: str) -> DataFrame:
    """All rankings ever emitted: ``batch, window_start, window_end, rank, key, cnt``."""
    done = _batches(spark, f"{out_path}/log")
    return spark.read.option("basePath", f"{out_path}/log").parquet(*(f"{out_path}/log/batch={b}" for b in done))


def newest_rankings(spark, out_path: str) -> DataFrame:
    """The ranking emitted last for each window."""
    log = ranking_log(spark, out_path)
    last = log.groupBy("window_end").agg(F.max("batch").alias("batch")).hint("shuffle_merge")
    return log.join(last, ["window_end", "batch"], "left_semi").drop("batch")
