"""Stream-stream J1 and J2.

Both sides carry a watermark; the time-range condition lets Spark purge
join state once the watermark passes it.  As in batch, the interval join
adds an event-time bucket to the join key (left rows copied to the at
most two buckets their interval touches), so a hot key is spread over
state-store partitions.  Streaming reconciliation needs a tolerance (the
state bound) and runs on two connected streams (``connect``), which
spread a hot key over time without repeating unmatched rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions.time import _interval, duration_us
from eventlens.operators.joins import _pairs, _signed_us
from eventlens.streaming.connect import reconcile_stream
from eventlens.streaming.windows import watermarked


def stream_interval_join(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str,
                         lower, upper, left_delay="0 seconds", right_delay="0 seconds",
                         bucket=None) -> DataFrame:
    lo_us, hi_us = _signed_us(lower), _signed_us(upper)
    width = duration_us(bucket) if bucket else max(hi_us - lo_us, 1_000_000)
    l = watermarked(left, left_ts, left_delay)
    r = watermarked(right, right_ts, right_delay)
    lt = F.unix_micros(F.col(left_ts))
    l = l.withColumn("_jb", F.explode(F.sequence(F.floor((lt + F.lit(lo_us)) / width).cast("long"),
                                                 F.floor((lt + F.lit(hi_us)) / width).cast("long"))))
    r = r.withColumn("_jb2", F.floor(F.unix_micros(F.col(right_ts)) / width).cast("long"))
    cond = [l[a] == r[b] for a, b in _pairs(on)] + [
        F.col("_jb") == F.col("_jb2"),
        F.col(right_ts) >= F.col(left_ts) + _interval(lo_us),
        F.col(right_ts) <= F.col(left_ts) + _interval(hi_us)]
    return l.join(r, reduce(lambda a, b: a & b, cond), "inner").drop("_jb", "_jb2")


def stream_reconcile(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     left_ts: str, right_ts: str, tolerance, left_delay="0 seconds",
                     right_delay="0 seconds", key_name: str = "key") -> DataFrame:
    """matched / left_only / right_only, as in batch; unmatched rows come out once the
    watermark passes ts + tolerance, rows with a null key or time at once."""
    return reconcile_stream(left, right, left_key, right_key, left_ts, right_ts, tolerance,
                            max(duration_us(left_delay), duration_us(right_delay)), key_name)
