"""A key holding a third of all rows is spread over several tasks, and the
results stay exact (compared with plain whole-key computations)."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import ts
from eventlens.operators.joins import interval_join
from eventlens.operators.sequence import ordered_context

T0 = 1700000000


@pytest.fixture(autouse=True)
def no_coalescing(spark):
    """Tiny test data would be coalesced into one partition by AQE; switch
    that off to see the distribution the plan gives at scale."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def hot_rows(n=3000, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if i % 3 == 0 else rnd.randint(1, 200)      # key 0: a third of all rows
        rows.append((k, ts(T0 + rnd.randint(0, 30 * 86400)), i))
    return rows


def test_ordered_scan_spreads_hot_key(spark):
    df = spark.createDataFrame(hot_rows(), "k long, ts timestamp, seq long")
    ctx = ordered_context(df, ["k"], "ts", "seq", "1 day", prev=["seq"], rank=True, split_rows=500)
    # rows of the hot key are ranked in many tasks
    tasks = (ctx.filter("k = 0").select(F.spark_partition_id().alias("p")).distinct().count())
    assert tasks > 1
    w = Window.partitionBy("k").orderBy("ts", "seq")
    exp = df.select("seq", F.lag("seq").over(w).alias("prev_seq"), F.row_number().over(w).cast("long").alias("rank"))
    assert sorted(ctx.select("seq", "prev_seq", "rank").collect()) == sorted(exp.collect())


def test_interval_join_spreads_hot_key(spark):
    rows = hot_rows(2000, 2)
    left = spark.createDataFrame(rows, "k long, lt timestamp, lseq long")
    right = spark.createDataFrame(hot_rows(2000, 3), "rk long, rt timestamp, rseq long")
    j = interval_join(left, right, [("k", "rk")], "lt", "rt", "-1 hour", "1 hour")
    assert j.filter("k = 0").select(F.spark_partition_id()).distinct().count() > 1
    exp = left.join(right, (F.col("k") == F.col("rk")) & (F.col("rt") >= F.col("lt") - F.expr("INTERVAL 1 HOUR"))
                    & (F.col("rt") <= F.col("lt") + F.expr("INTERVAL 1 HOUR")))
    assert sorted(j.select("lseq", "rseq").collect()) == sorted(exp.select("lseq", "rseq").collect())


def test_hot_bucket_is_range_split(spark):
    """One (key, bucket) with a third of all rows -- half of them at the very
    same instant -- is split into ordered sub-ranges; results stay exact."""
    rnd = random.Random(4)
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            t = T0 + 100 if i % 2 == 0 else T0 + rnd.randint(0, 3599)     # key 0: inside one hour
            rows.append((0, ts(t), i))
        else:
            rows.append((rnd.randint(1, 200), ts(T0 + rnd.randint(0, 30 * 86400)), i))
    df = spark.createDataFrame(rows, "k long, ts timestamp, seq long")
    ctx = ordered_context(df, ["k"], "ts", "seq", "1 day", prev=["seq"], next=["seq"], rank=True,
                          running_count={"n_even": F.col("seq") % 2 == 0}, split_rows=100)
    assert ctx.filter("k = 0").select(F.spark_partition_id()).distinct().count() > 1
    w = Window.partitionBy("k").orderBy("ts", "seq")
    exp = df.select("seq", F.lag("seq").over(w).alias("prev_seq"), F.lead("seq").over(w).alias("next_seq"),
                    F.row_number().over(w).cast("long").alias("rank"),
                    F.sum(F.when(F.col("seq") % 2 == 0, 1).otherwise(0)).over(
                        w.rowsBetween(Window.unboundedPreceding, 0)).cast("long").alias("n_even"))
    cols = ["seq", "prev_seq", "next_seq", "rank", "n_even"]
    assert sorted(ctx.select(*cols).collect()) == sorted(exp.select(*cols).collect())


def places(ctx, df):
    """Rows per window partition of the hot key: one task's share."""
    from eventlens.operators.sequence import _PLACE, _placed
    x, kc = _placed(df, ["k"], "ts", ["seq"], "1 day", 100)
    return [r["count"] for r in x.filter("k = 0").groupBy(*kc, *_PLACE).count().collect()]


def test_one_instant_is_split_by_measured_quantiles(spark):
    rows = [(0, ts(T0 + 100), i) for i in range(1000)] + [(0, ts(T0), 5000), (0, ts(T0 + 3000), 5001)]
    df = spark.createDataFrame(rows, "k long, ts timestamp, seq long")
    assert max(places(None, df)) <= 200
    ctx = ordered_context(df, ["k"], "ts", "seq", "1 day", rank=True, prev=["seq"], split_rows=100)
    w = Window.partitionBy("k").orderBy("ts", "seq")
    exp = df.select("seq", F.lag("seq").over(w).alias("prev_seq"), F.row_number().over(w).cast("long").alias("rank"))
    assert sorted(ctx.select("seq", "prev_seq", "rank").collect(), key=repr) == sorted(exp.collect(), key=repr)


@pytest.mark.parametrize("split_rows", [None, 4, 10, 1000])
def test_limit_never_changes_results(spark, split_rows):
    """Null keys, null times, null tiebreaks and ties give the plain window's answer."""
    rnd = random.Random(7)
    rows = [(rnd.choice([0, 0, 1, None]), rnd.choice([None, *(ts(T0 + 60 * i) for i in range(8))]), i if i % 9 else None)
            for i in range(120)]
    rows = list({(k, t, s): (k, t, s, i) for i, (k, t, s) in enumerate(rows)}.values())   # no full ties
    df = spark.createDataFrame(rows, "k long, ts timestamp, seq long, id long")
    ctx = ordered_context(df, ["k"], "ts", "seq", "5 minutes", prev=["id"], next=["id"], rank=True,
                          running_count={"n3": F.col("id") % 3 == 0},
                          first_next_where={"five": (F.col("id") % 5 == 0, ["id"])}, split_rows=split_rows)
    w = Window.partitionBy("k").orderBy("ts", "seq")
    exp = df.select("id", F.lag("id").over(w).alias("prev_id"), F.lead("id").over(w).alias("next_id"),
                    F.row_number().over(w).cast("long").alias("rank"),
                    F.sum(F.when(F.col("id") % 3 == 0, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("n3"),
                    F.first(F.when(F.col("id") % 5 == 0, F.col("id")), ignorenulls=True).over(
                        w.rowsBetween(1, Window.unboundedFollowing)).alias("five_id"))
    cols = ["id", "prev_id", "next_id", "rank", "n3", "five_id"]
    assert sorted(map(repr, ctx.select(*cols).collect())) == sorted(map(repr, exp.select(*cols).collect()))


def test_missing_tiebreak_raises(spark):
    df = spark.createDataFrame([(0, ts(T0))], "k long, ts timestamp")
    with pytest.raises(ValueError):
        ordered_context(df, ["k"], "ts", "seq", rank=True)
