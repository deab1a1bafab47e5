"""Streaming windows (W1-W3, A1-A5, T2-T4) and top-n.

* Counts: ``withWatermark`` + ``groupBy(window, key)``; append mode emits
  each window once, when the watermark passes its end.  With many
  overlaps, two chained aggregations: per-pane counts, then the sliding
  window over the pane's event time (``window_time``), so state and
  expansion are per pane aggregate, not per row.
* Distinct (A5): streams reject count(distinct); two chained
  aggregations, (window, key, value) then (window, key).
* Top-n: streams reject row_number.  In append mode every (window, key)
  count arrives exactly once and all keys of a window arrive in the same
  micro-batch (they close together), so each micro-batch is ranked with
  the batch operator (WindowGroupLimit) inside ``foreachBatch``.
* Allowed lateness (T4): append with delay = out-of-orderness + lateness
  gives the final answer once; ``output_mode="update"`` on the count
  stage gives early results and refinements.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions.time import duration_us, event_time
from eventlens.operators.topn import top_n_per_window
from eventlens.operators.windows import PANE_THRESHOLD
from eventlens.session import ship_package


def _w(ts, size_us, slide_us=None):
    if slide_us is None or slide_us == size_us:
        return F.window(ts, f"{size_us} microseconds")
    return F.window(ts, f"{size_us} microseconds", f"{slide_us} microseconds")


def _flat(df, win="_w"):
    rest = [c for c in df.columns if c != win]
    return df.select(F.col(f"{win}.start").alias("window_start"), F.col(f"{win}.end").alias("window_end"), *rest)


def watermarked(df: DataFrame, ts: str, delay) -> DataFrame:
    """T2/T2'/T3: bounded out-of-orderness (delay 0 = ascending timestamps).

    ``delay=None`` keeps an event time set upstream (e.g. by a stateful
    operator's output) instead of adding a watermark."""
    if delay is None:
        return df
    return event_time(df, ts).withWatermark(ts, f"{duration_us(delay)} microseconds")


def lateness_delay(out_of_order, lateness) -> str:
    """T4: a window's final answer waits for out-of-orderness + allowed lateness."""
    return f"{duration_us(out_of_order) + duration_us(lateness)} microseconds"


def stream_window_counts(df: DataFrame, ts: str, size, slide=None, keys=(), delay="0 seconds",
                         method: str = "auto", name: str = "cnt") -> DataFrame:
    keys = list(keys)
    x = watermarked(df, ts, delay)
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide else None
    many = slide_us is not None and size_us / slide_us > PANE_THRESHOLD
    if method == "panes" or (method == "auto" and many):
        pane = gcd(size_us, slide_us)
        p = x.groupBy(_w(ts, pane).alias("_p"), *keys).agg(F.count(F.lit(1)).alias("_c"))
        out = p.groupBy(_w(F.window_time("_p"), size_us, slide_us).alias("_w"), *keys) \
               .agg(F.sum("_c").cast("long").alias(name))
    else:
        out = x.groupBy(_w(ts, size_us, slide_us).alias("_w"), *keys).agg(F.count(F.lit(1)).alias(name))
    return _flat(out)


def stream_window_distinct(df: DataFrame, ts: str, size, slide=None, distinct_col: str = "user_id",
                           keys=(), delay="0 seconds", name: str = "uv") -> DataFrame:
    keys = list(keys)
    x = watermarked(df, ts, delay)
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide else None
    first = x.groupBy(_w(ts, size_us, slide_us).alias("window"), *keys, distinct_col).agg(F.count(F.lit(1)).alias("_n"))
    second = first.groupBy("window", *keys).agg(F.count(F.lit(1)).alias(name))
    return _flat(second, "window")


def rank_batch(counts: DataFrame, key: str, n: int, cnt: str = "cnt") -> DataFrame:
    """Top-n of one micro-batch of closed window counts."""
    return top_n_per_window(counts, key, n, cnt)


def start_stream_topn(counts: DataFrame, key: str, n: int, out_path: str, checkpoint: str | None = None,
                      trigger: dict | None = None, cnt: str = "cnt"):
    """N1/N2 on a stream of closed window counts; each micro-batch's ranking
    is written to ``{out_path}/batch=<id>`` (overwrite -> idempotent on retry).
    The default checkpoint lies beside the output, so a restart resumes."""
    def write(batch: DataFrame, batch_id: int):
        rank_batch(batch, key, n, cnt).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    ship_package(counts.sparkSession)
    w = (counts.writeStream.outputMode("append").foreachBatch(write)
         .option("checkpointLocation", checkpoint or f"{out_path.rstrip('/')}-checkpoint"))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
