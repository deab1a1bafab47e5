"""Top-n keys per window; M5: ranked report text.

``rank <= n`` over ``row_number() OVER (PARTITION BY window ORDER BY cnt
DESC, key ASC)`` is planned by Spark with a *partial* WindowGroupLimit
before the shuffle: every map task keeps at most n rows per window, so a
window with millions of keys never reaches one task whole.  Ties are
broken by key ascending (the reference leaves them unspecified).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions.text import ranked_report
from eventlens.operators.windows import window_counts


def top_n_per_group(df: DataFrame, group_cols, order_cols, n: int, rank_col: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows of each group by ``order_cols`` (Columns)."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) <= n)
              .withColumn(rank_col, F.col(rank_col).cast("long")))


def top_n_per_window(counts: DataFrame, key: str, n: int, cnt: str = "cnt",
                     window_cols=("window_start", "window_end"), rank_col: str = "rank") -> DataFrame:
    """N1/N2 on an existing (window, key, cnt) table."""
    return top_n_per_group(counts, list(window_cols), [F.col(cnt).desc(), F.col(key).asc()], n, rank_col)


def hot_keys(df: DataFrame, ts: str, key: str, size, slide, n: int, method: str = "auto") -> DataFrame:
    """Count per (sliding window, key), then the top ``n`` keys per window."""
    return top_n_per_window(window_counts(df, ts, size, slide, [key], method), key, n)


def window_report(ranked: DataFrame, key: str, cnt: str = "cnt", rank_col: str = "rank",
                  window_cols=("window_start", "window_end")) -> DataFrame:
    """M5: one text block per window end from the ranked rows.

    The group holds at most n rows (already limited), so collecting it is
    bounded.  Grouping by the same window columns as the ranking reuses its
    partitioning (no extra shuffle).
    """
    return (ranked.groupBy(*window_cols)
                  .agg(F.collect_list(F.struct(F.col(rank_col).alias("rank"), F.col(key).alias("key"),
                                               F.col(cnt).alias("cnt"))).alias("_r"))
                  .select("window_end", ranked_report("window_end", "_r").alias("report")))
