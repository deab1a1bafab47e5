"""D1 click cap with blacklist warning; D1b capped rows feeding a window count.

Per (key, UTC day) the first ``cap`` rows in (ts, seq) order pass, the
rest are dropped, and the first dropped row raises one warning.  The
reference's reset timer is computed from the processing clock; ours resets
at each event-time UTC midnight (``reset=None``: a lifetime cap).

A row can only be among the first ``cap + 1`` of its group if it is
among the first ``cap + 1`` of its (group, time bucket), so rows are
ranked there first -- a hot group, or ``reset=None``, spreads over its
buckets -- and only the rows left meet in the group.  Where Spark plans a
partial WindowGroupLimit, map tasks already forward at most cap + 1 rows
per bucket.  The plan is the same for every cap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions.time import bucket_of, utc_day
from eventlens.operators.sequence import DEFAULT_BUCKET
from eventlens.operators.windows import window_counts

def _ranked(df: DataFrame, keys, cap: int, ts: str, seq: str | None, reset, bucket) -> tuple[DataFrame, list]:
    group = list(keys)
    if reset == "day":
        df = df.withColumn("_day", utc_day(ts).cast(dict(df.dtypes)[ts]))
        group.append("_day")
    elif reset is not None:
        raise ValueError("reset must be 'day' or None")
    if seq and seq not in df.columns:
        raise ValueError(f"no tiebreak column {seq}")
    order = [F.col(ts), *([F.col(seq)] if seq else [])]
    r = df.withColumn("_b", bucket_of(ts, bucket))
    for part in ([*group, "_b"], group):
        r = r.withColumn("_rank", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).filter(F.col("_rank") <= cap + 1)
    return r.drop("_b"), group


def click_cap(df: DataFrame, keys, cap: int = 100, ts: str = "ts", seq: str | None = "seq",
              reset: str | None = "day", bucket=DEFAULT_BUCKET) -> tuple[DataFrame, DataFrame]:
    """Return (passed rows, warnings).

    warnings: ``*keys, [day,] ts, msg`` -- one per group that exceeds the
    cap, at its first dropped row.
    """
    r, _ = _ranked(df, keys, cap, ts, seq, reset, bucket)
    passed = r.filter(F.col("_rank") <= cap).drop("_rank", "_day")
    warn = (r.filter(F.col("_rank") == cap + 1)
             .select(*keys, *([F.col("_day").alias("day")] if reset else []), F.col(ts).alias("ts"),
                     F.concat(F.lit("click over "), F.lit(str(cap)), F.lit(" times")).alias("msg")))
    return passed, warn


def capped_window_counts(df: DataFrame, cap_keys, count_keys, size, slide, cap: int = 100,
                         ts: str = "ts", seq: str | None = "seq", reset="day", method="auto") -> DataFrame:
    """Window counts over the rows that pass the cap."""
    passed, _ = click_cap(df, cap_keys, cap, ts, seq, reset)
    return window_counts(passed, ts, size, slide, count_keys, method)
