"""J1 interval join and J2 two-stream reconciliation (batch).

J1 (``interval_join``): pairs with equal keys and
``left.ts + lower <= right.ts <= left.ts + upper`` (both ends inclusive).
A plain equi-join on the key would put every row of a hot key into one
task and test all its pairs.  Instead the right side is placed in
event-time buckets of width ``upper - lower`` and each left row is
copied to the (at most two) buckets its interval touches; the join key
is (key, bucket), so a hot key spreads over time and each task only
tests rows that are near in time.  Every right row lives in exactly one
bucket, so each pair is produced once.

J2 (``reconcile``): rows of equal keys pair as in SQL (every left with
every right row); a row without a partner comes out alone.  With a
``tolerance`` the pairs are those of the interval join, and the rows
without one come from two anti joins on the same (key, bucket).  A row
with a null key or time has no partner and is kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions.time import _interval, duration_us, epoch_micros


def _pairs(on):
    return [(k, k) if isinstance(k, str) else tuple(k) for k in on]


def interval_join(left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str,
                  lower, upper, bucket=None) -> DataFrame:
    """Inner interval join; ``lower``/``upper`` are signed durations
    (e.g. ``-5 seconds``/``5 seconds``).  Column names must not clash:
    rename one side first.  Returns all left and right columns.
    """
    lo_us = _signed_us(lower)
    hi_us = _signed_us(upper)
    if hi_us < lo_us:
        raise ValueError("upper must be >= lower")
    width = duration_us(bucket) if bucket else max(hi_us - lo_us, 1_000_000)
    keys = _pairs(on)
    lt = epoch_micros(left_ts)
    lb = F.explode(F.sequence(F.floor((lt + F.lit(lo_us)) / width).cast("long"),
                              F.floor((lt + F.lit(hi_us)) / width).cast("long"))).alias("_jb")
    lx = left.select("*", lb)
    rx = right.withColumn("_jb2", F.floor(epoch_micros(right_ts) / width).cast("long"))
    cond = [lx[lk] == rx[rk] for lk, rk in keys] + [
        F.col("_jb") == F.col("_jb2"),
        F.col(right_ts) >= F.col(left_ts) + _interval(lo_us),
        F.col(right_ts) <= F.col(left_ts) + _interval(hi_us),
    ]
    return lx.join(rx, reduce(lambda a, b: a & b, cond), "inner").drop("_jb", "_jb2")


def _signed_us(d) -> int:
    s = str(d).strip()
    if isinstance(d, str) and s.startswith("-"):
        return -duration_us(s[1:])
    return duration_us(d)


def _anti(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_ts: str, right_ts: str, us: int) -> DataFrame:
    """Left rows without a right row of the key within ``us``: the right side
    is copied to the buckets its interval touches, so each left row meets
    all its possible partners in its own bucket."""
    width = max(2 * us, 1_000_000)
    rt = epoch_micros(right_ts)
    lx = left.withColumn("_jb", F.floor(epoch_micros(left_ts) / width).cast("long"))
    rx = right.select(F.col(right_key).alias("_rk"), F.col(right_ts).alias("_rt"), F.explode(F.sequence(
        F.floor((rt - F.lit(us)) / width).cast("long"), F.floor((rt + F.lit(us)) / width).cast("long"))).alias("_jb2"))
    cond = ((F.col(left_key) == F.col("_rk")) & (F.col("_jb") == F.col("_jb2"))
            & (F.col("_rt") >= F.col(left_ts) - _interval(us)) & (F.col("_rt") <= F.col(left_ts) + _interval(us)))
    return lx.join(rx, cond, "left_anti").drop("_jb")


def reconcile(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              left_ts: str, right_ts: str, tolerance=None, key_name: str = "key") -> DataFrame:
    """Full reconciliation; returns ``outcome, <key_name>, <left cols>, <right cols>``.

    ``outcome`` is ``matched`` (one row per pair), ``left_only`` or
    ``right_only``.  Left and right column names must be distinct.
    """
    lcols, rcols = left.columns, right.columns

    def shaped(df: DataFrame, outcome, key, have_left: bool = True, have_right: bool = True) -> DataFrame:
        return df.select(
            outcome.alias("outcome"), key.alias(key_name),
            *[F.col(c) if have_left else F.lit(None).cast(t).alias(c) for c, t in left.dtypes],
            *[F.col(c) if have_right else F.lit(None).cast(t).alias(c) for c, t in right.dtypes])
    if tolerance is None:
        # markers, not keys, tell which sides a row has: keys may be null
        j = (left.withColumn("_l", F.lit(True)).join(right.withColumn("_r", F.lit(True)),
                                                     F.col(left_key) == F.col(right_key), "full_outer"))
        outcome = (F.when(F.col("_l").isNull(), F.lit("right_only")).when(F.col("_r").isNull(), F.lit("left_only"))
                   .otherwise(F.lit("matched")))
        return shaped(j, outcome, F.when(F.col("_l").isNull(), F.col(right_key)).otherwise(F.col(left_key)))
    us = duration_us(tolerance)
    pairs = interval_join(left, right, [(left_key, right_key)], left_ts, right_ts, -us, us)
    alone_l = _anti(left, right, left_key, right_key, left_ts, right_ts, us)
    alone_r = _anti(right, left, right_key, left_key, right_ts, left_ts, us)
    return (shaped(pairs.select(*lcols, *rcols), F.lit("matched"), F.col(left_key))
            .unionByName(shaped(alone_l, F.lit("left_only"), F.col(left_key), have_right=False))
            .unionByName(shaped(alone_r, F.lit("right_only"), F.col(right_key), have_left=False)))
