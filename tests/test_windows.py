"""Boundaries, pane form == direct form, ties."""

import random

from pyspark.sql import functions as F

from conftest import ts
from eventlens.operators.topn import hot_keys, top_n_per_window, window_report
from eventlens.operators.windows import window_agg, window_counts, window_distinct, window_sum

T0 = 1511658000  # an hour boundary (2017-11-26 01:00:00 UTC)


def _df(spark, rows):
    return spark.createDataFrame([(k, ts(t), v, i) for i, (k, t, v) in enumerate(rows)],
                                 "key string, ts timestamp, value long, seq long")


def test_row_on_edge_belongs_to_window_starting_there(spark):
    df = _df(spark, [("a", T0, 1), ("a", T0 - 1, 1)])
    out = {(r.window_start, r.window_end): r.cnt for r in window_counts(df, "ts", "1 hour").collect()}
    assert out[(ts(T0), ts(T0 + 3600))] == 1
    assert out[(ts(T0 - 3600), ts(T0))] == 1


def test_sliding_membership_count(spark):
    df = _df(spark, [("a", T0 + 7, 1)])
    for method in ("direct", "panes"):
        rows = window_counts(df, "ts", "1 minute", "5 seconds", ["key"], method=method).collect()
        assert len(rows) == 12
        assert all(r.window_start <= ts(T0 + 7) < r.window_end for r in rows)


def test_panes_equal_direct_random(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("abc"), T0 + rnd.randint(0, 7200), rnd.randint(-5, 50)) for _ in range(400)]
    df = _df(spark, rows)
    aggs = {"cnt": "count", "total": ("sum", "value"), "lo": ("min", "value"), "hi": ("max", "value")}
    for size, slide in [("1 hour", "5 minutes"), ("10 minutes", "1 minute"), ("25 minutes", "10 minutes")]:
        a = window_agg(df, "ts", size, slide, ["key"], aggs, method="direct")
        b = window_agg(df, "ts", size, slide, ["key"], aggs, method="panes")
        assert sorted(a.collect()) == sorted(b.collect()), (size, slide)


def test_distinct_panes_equal_direct(spark):
    rnd = random.Random(3)
    rows = [(str(rnd.randint(0, 20)), T0 + rnd.randint(0, 5000), 0) for _ in range(300)]
    df = _df(spark, rows)
    a = window_distinct(df, "ts", "30 minutes", "1 minute", distinct_col="key", method="direct")
    b = window_distinct(df, "ts", "30 minutes", "1 minute", distinct_col="key", method="panes")
    assert sorted(a.collect()) == sorted(b.collect())


def test_sum_with_labels(spark):
    df = _df(spark, [("a", T0, 2), ("b", T0 + 1, 3)])
    r = window_sum(df, "ts", "1 hour", value="value", labels={"channel": "all", "behavior": "all"}).collect()[0]
    assert (r.total, r.channel, r.behavior) == (5, "all", "all")


def test_topn_ties_by_key_ascending(spark):
    rows = [("b", T0, 0), ("b", T0 + 1, 0), ("a", T0 + 2, 0), ("a", T0 + 3, 0), ("c", T0 + 4, 0),
            ("c", T0 + 5, 0), ("d", T0 + 6, 0)]
    out = hot_keys(_df(spark, rows), "ts", "key", "1 hour", None, 2).orderBy("rank").collect()
    assert [(r.key, r.cnt, r.rank) for r in out] == [("a", 2, 1), ("b", 2, 2)]


def test_topn_per_window_and_report(spark):
    rows = [("x", T0 + 10, 0), ("x", T0 + 20, 0), ("y", T0 + 30, 0), ("y", T0 + 70, 0), ("y", T0 + 80, 0)]
    counts = window_counts(_df(spark, rows), "ts", "2 minutes", "1 minute", ["key"])
    top = top_n_per_window(counts, "key", 1).orderBy("window_end").collect()
    assert [(r.key, r.cnt) for r in top] == [("x", 2), ("y", 3), ("y", 2)]
    rep = window_report(top_n_per_window(counts, "key", 2), "key").orderBy("window_end").collect()
    assert rep[0].report.startswith("time: 2017-11-26 01:01:00\nNo.1: key=x count=2\nNo.2: key=y count=1")


def test_timestamp_ntz_input(spark):
    df = _df(spark, [("a", T0, 1)]).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    r = window_counts(df, "ts", "1 hour", "10 minutes", method="panes").orderBy("window_start").collect()
    assert len(r) == 6 and dict(window_counts(df, "ts", "1 hour").dtypes)["window_start"] == "timestamp_ntz"


def test_custom_aggregate_pandas_udaf(spark):
    """§2.10: a user aggregate (grouped-agg pandas_udf) per window."""
    import pandas as pd

    @F.pandas_udf("double")
    def spread(v: pd.Series) -> float:
        return float(v.max() - v.min())

    df = _df(spark, [("a", T0 + 1, 5), ("a", T0 + 2, 9), ("a", T0 + 3700, 1)])
    # (Spark runs pandas aggregates in their own aggregation: not mixed with built-ins)
    out = window_agg(df, "ts", "1 hour", None, ["key"], {"spread": spread(F.col("value"))})
    got = sorted((r.window_start, r.spread) for r in out.collect())
    assert got == [(ts(T0), 4.0), (ts(T0 + 3600), 0.0)]
    out2 = window_agg(df, "ts", "1 hour", "5 minutes", ["key"], {"spread": spread(F.col("value"))}, method="panes")
    assert out2.count() == 24


def test_sum_type_does_not_depend_on_the_overlap(spark):
    from decimal import Decimal
    from eventlens.operators.windows import window_sum
    df = spark.createDataFrame([(ts(0), Decimal("1.50")), (ts(61), Decimal("2.25"))], "ts timestamp, v decimal(10,2)")
    a = window_sum(df, "ts", "1 hour", "10 minutes", value="v")
    b = window_sum(df, "ts", "1 hour", "1 minute", value="v")
    assert dict(a.dtypes)["total"] == dict(b.dtypes)["total"] == "decimal(20,2)"
    assert max(r.total for r in b.collect()) == Decimal("3.75")
