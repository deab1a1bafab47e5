"""J1 interval join, J2 reconciliation, D1 click cap."""

from pyspark.sql import functions as F

from conftest import ts
from eventlens.operators.joins import interval_join, reconcile
from eventlens.operators.limits import click_cap
from eventlens.plans import jobs

ORDER = "order_id long, event_type string, tx_id string, ts timestamp, seq long"
RECEIPT = "tx_id string, pay_channel string, ts timestamp, seq long"
C = 1558430000


def test_interval_join_inclusive_bounds(spark):
    o = spark.createDataFrame([(1, "pay", "tx", ts(C), 0)], ORDER)
    r = spark.createDataFrame([("tx", "wechat", ts(C + d), i) for i, d in enumerate([-6, -5, 0, 5, 6])], RECEIPT)
    got = sorted((r.r_ts - r.o_ts).total_seconds() for r in jobs.tx_match_interval(o, r).collect())
    assert got == [-5.0, 0.0, 5.0]


def test_interval_join_asymmetric_and_bucket_edges(spark):
    left = spark.createDataFrame([(1, ts(C + i * 7)) for i in range(50)], "k long, lt timestamp")
    right = spark.createDataFrame([(1, ts(C + i * 3)) for i in range(120)], "rk long, rt timestamp")
    for bucket in (None, "1 second", "13 seconds"):
        got = interval_join(left, right, [("k", "rk")], "lt", "rt", "-10 seconds", "4 seconds", bucket)
        exp = left.join(right, (F.col("k") == F.col("rk")) & (F.col("rt") >= F.col("lt") - F.expr("INTERVAL 10 SECONDS"))
                        & (F.col("rt") <= F.col("lt") + F.expr("INTERVAL 4 SECONDS")))
        assert sorted(got.collect()) == sorted(exp.collect())


def test_reconcile_outcomes(spark):
    o = spark.createDataFrame([
        (1, "create", "", ts(C), 0), (1, "pay", "a", ts(C + 1), 1),
        (2, "pay", "b", ts(C + 2), 2),                       # no receipt
        (3, "pay", "d", ts(C + 3), 3), (4, "pay", "d", ts(C + 4), 4),   # duplicate tx id
        (5, "pay", "", ts(C + 5), 5)], ORDER)                 # empty tx id: ignored
    r = spark.createDataFrame([("a", "wechat", ts(C + 2), 0), ("c", "alipay", ts(C), 1),
                               ("d", "alipay", ts(C + 3), 2), ("", "wechat", ts(C), 3)], RECEIPT)
    out = sorted((x.outcome, x.tx_id, x.order_id) for x in jobs.tx_reconcile(o, r).collect())
    assert out == [("left_only", "b", 2), ("matched", "a", 1), ("matched", "d", 3), ("matched", "d", 4),   # as SQL pairs
                   ("right_only", "c", None)]


def test_reconcile_tolerance_splits_pair(spark):
    left = spark.createDataFrame([(1, ts(C))], "k long, lt timestamp")
    right = spark.createDataFrame([(1, ts(C + 10))], "rk long, rt timestamp")
    out = sorted(r.outcome for r in reconcile(left, right, "k", "rk", "lt", "rt", tolerance="5 seconds").collect())
    assert out == ["left_only", "right_only"]
    out = [r.outcome for r in reconcile(left, right, "k", "rk", "lt", "rt", tolerance="10 seconds").collect()]
    assert out == ["matched"]


CLICK = "user_id long, ad_id long, province string, city string, ts timestamp, seq long"
MIDNIGHT = 1511740800  # 2017-11-27 00:00:00 UTC


def test_click_cap_boundaries(spark):
    rows = [(1, 9, "beijing", "beijing", ts(MIDNIGHT - 200 + i), i) for i in range(102)]   # 102 clicks before midnight
    rows += [(1, 9, "beijing", "beijing", ts(MIDNIGHT + i), 200 + i) for i in range(3)]    # new day
    rows += [(2, 9, "henan", "zhengzhou", ts(MIDNIGHT - 50 + i), 300 + i) for i in range(100)]  # exactly at cap
    df = spark.createDataFrame(rows, CLICK)
    passed, warn = click_cap(df, ["user_id", "ad_id"], cap=100)
    counts = {(r.user_id, r.day): r.n for r in
              passed.withColumn("day", F.to_date("ts")).groupBy("user_id", "day").agg(F.count("*").alias("n")).collect()}
    assert sorted(counts.values()) == [3, 50, 50, 100]
    w = warn.collect()
    assert len(w) == 1 and w[0].user_id == 1 and w[0].ts == ts(MIDNIGHT - 200 + 100)


def test_click_cap_lifetime_and_big_cap(spark):
    rows = [(1, 9, "p", "c", ts(MIDNIGHT - 5 + i), i) for i in range(10)]
    df = spark.createDataFrame(rows, CLICK)
    passed, warn = click_cap(df, ["user_id", "ad_id"], cap=6, reset=None)
    assert passed.count() == 6 and warn.collect()[0].ts == ts(MIDNIGHT + 1)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "3")
    try:
        passed2, warn2 = click_cap(df, ["user_id", "ad_id"], cap=6, reset=None)
        assert sorted(passed2.collect()) == sorted(passed.collect())
        assert [r.ts for r in warn2.collect()] == [ts(MIDNIGHT + 1)]
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_blacklist_job_counts_only_passed(spark):
    rows = [(1, 9, "beijing", "b", ts(MIDNIGHT + i), i) for i in range(5)] + [(2, 9, "henan", "z", ts(MIDNIGHT), 9)]
    counts, warn = jobs.ad_clicks_with_blacklist(spark.createDataFrame(rows, CLICK), cap=3)
    top = {r.province: r.cnt for r in counts.filter(F.col("window_end") == ts(MIDNIGHT + 5)).collect()}
    assert top == {"beijing": 3, "henan": 1}
    assert warn.count() == 1


def test_reconcile_keeps_null_times_and_pairs_within_tolerance(spark):
    left = spark.createDataFrame([("k", ts(1000), 1), ("n", None, 2), (None, ts(5), 3)], "k string, lt timestamp, l long")
    right = spark.createDataFrame([("k", ts(0), 1), ("k", ts(1001), 2), ("n", None, 3), (None, ts(5), 4)], "rk string, rt timestamp, r long")
    got = sorted((x.outcome, x.l or 0, x.r or 0) for x in reconcile(left, right, "k", "rk", "lt", "rt", tolerance="5 seconds").collect())
    assert got == [("left_only", 2, 0), ("left_only", 3, 0), ("matched", 1, 2), ("right_only", 0, 1), ("right_only", 0, 3), ("right_only", 0, 4)]
    got = sorted((x.outcome, x.key or "", x.l or 0, x.r or 0) for x in reconcile(left, right, "k", "rk", "lt", "rt").collect())
    assert got == [("left_only", "", 3, 0), ("matched", "k", 1, 1), ("matched", "k", 1, 2), ("matched", "n", 2, 3), ("right_only", "", 0, 4)]


def test_reconcile_pairs_duplicates_as_sql(spark):
    left = spark.createDataFrame([("k", ts(1), 1), ("k", ts(2), 2)], "k string, lt timestamp, l long")
    right = spark.createDataFrame([("k", ts(1), 1), ("k", ts(2), 2), ("k", ts(99), 3)], "rk string, rt timestamp, r long")
    assert reconcile(left, right, "k", "rk", "lt", "rt").count() == 6
    got = reconcile(left, right, "k", "rk", "lt", "rt", tolerance="5 seconds").collect()
    assert sorted(x.outcome for x in got) == ["matched"] * 4 + ["right_only"]


def test_click_cap_keeps_a_column_called_day(spark):
    df = spark.createDataFrame([(1, ts(10 * i), i, "mine") for i in range(5)], "u long, ts timestamp, seq long, day string")
    for reset in ("day", None):
        passed, warn = click_cap(df, ["u"], cap=3, reset=reset)
        assert {r.day for r in passed.collect()} == {"mine"} and passed.count() == 3
        assert warn.count() == 1


def test_hot_group_without_reset_spreads_over_buckets(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(0, ts(600 * i), i) for i in range(2000)], "u long, ts timestamp, seq long")
    for cap in (7, 1500):
        passed, warn = click_cap(df, ["u"], cap=cap, reset=None)
        assert sorted(r.seq for r in passed.collect()) == list(range(cap))
        assert warn.select(F.unix_timestamp("ts").alias("s")).first().s == 600 * cap
