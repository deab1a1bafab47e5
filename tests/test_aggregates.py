"""User aggregates that merge (§2.10), in batch and on streams, and refined rankings (N2 with T4)."""

import random
import sys
from collections import defaultdict
from datetime import timedelta

import pytest
from conftest import ts
from pyspark import cloudpickle
from pyspark.sql import functions as F

from eventlens.operators import aggregates as A
from eventlens.plans.aggregates import Count, CountAndSum, Spread
from eventlens.session import scratch_path
from eventlens.streaming.aggregates import newest_rankings, ranking_log, start_refined_topn, stream_aggregate
from eventlens.streaming.runner import run_once

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import a test


class Latest(A.Aggregate):
    """The value of the newest row: a state that is neither a number nor null for no rows."""

    returns = "string"

    def create(self):
        return ()

    def add(self, state, at, v):
        return max(state, (at, v))

    def merge(self, state, other):
        return max(state, other)

    def result(self, state):
        return state[1] if state else "none"


def _rows(n=300, seed=1):
    rng = random.Random(seed)
    rows = [(rng.randrange(5000), rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 1, 2, 7]), i) for i in range(n)]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(ts(t), k, v, i) for t, k, v, i in rows], "t timestamp, k string, v int, i long").repartition(5)


def _windows(rows, size, slide):
    out = defaultdict(list)
    for t, k, v, i in rows:
        s = t // slide * slide
        while s > t - size:
            out[s, k].append((t, v, i))
            s -= slide
    return out


@pytest.mark.parametrize("size,slide", [(600, 60), (600, 45), (100, 100), (300, 7)])
def test_windows_equal_a_loop(spark, size, slide):
    rows = _rows()
    df = _frame(spark, rows).unionByName(spark.createDataFrame([(None, "a", 1, 0)], "t timestamp, k string, v int, i long"))
    args = (df, "t", f"{size} seconds", f"{slide} seconds", ["k"])
    want = _windows(rows, size, slide)
    got = {(r.window_start, r.k): (r.window_end - r.window_start, r.value) for r in A.aggregate_windows(*args, ["v"], Spread()).collect()}

    def spread(x):
        vs = [v for _, v, _ in x if v is not None]
        return max(vs) - min(vs) if vs else None
    assert got == {(ts(s), k): (timedelta(seconds=size), spread(x)) for (s, k), x in want.items()}
    got = {(r.window_start, r.k): tuple(r.value) for r in A.aggregate_windows(*args, ["v"], CountAndSum()).collect()}
    assert got == {(ts(s), k): (sum(v is not None for _, v, _ in x), sum(v or 0 for _, v, _ in x), sum(v is None for _, v, _ in x)) for (s, k), x in want.items()}
    got = {(r.window_start, r.k): r.value for r in A.aggregate_windows(df.withColumn("v", F.col("i").cast("string")), *args[1:], ["i", "v"], Latest()).collect()}
    assert got == {(ts(s), k): str(max(i for _, _, i in x)) for (s, k), x in want.items()}


def test_only_states_are_shuffled(spark, monkeypatch):
    rows = [(t % 1000, "hot", 1, t) for t in range(6000)] + [(5, "cold", 2, 0)]
    df = _frame(spark, rows)
    parts = A.partials(df, "t", 100_000_000, ["k"], ["v"], Count())
    assert parts.count() <= 5 * 11  # a state per task, pane and key, whatever the rows
    assert {r.value for r in A.aggregate_windows(df, "t", "100 seconds", None, ["k"], ["v"], Count()).where("k = 'hot'").collect()} == {600}
    small = df.select(F.lit(0).cast("long").alias("p"), F.col("i").alias("t"), F.col("k").alias("k0")).mapInArrow(
        A.partial_states(Count(), 1, held=1), "p long, k0 string, t long, state binary")
    assert A.merged(small, Count(), 1).count() == 2
    assert A.aggregate_windows(df.limit(0), "t", "100 seconds", "10 seconds", [], ["v"], Count()).count() == 0


def at(seconds):
    """Well after the epoch, before which there is no watermark."""
    return ts(1_000_000 + seconds)


def _stream(spark, batches):
    """One file per micro-batch of (seconds, key) rows."""
    path = scratch_path(spark, "agg-in")
    for i, rows in enumerate(batches):
        spark.createDataFrame([(at(t), k) for t, k in rows], "t timestamp, k string").coalesce(1).write.parquet(f"{path}/{i:03d}")
    return spark.readStream.schema("t timestamp, k string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


BATCHES = [[(5, "a"), (7, "a"), (8, "b"), (31, "a")],  # closes [0, 10)
           [(6, "b"), (9, "c"), (33, "a")],  # late by 25 and 22 for [0, 10)
           [(200, "z")], [(4, "a"), (190, "b")], [(5000, "end")]]


def test_refinements_and_late_rows(spark):
    s = stream_aggregate(_stream(spark, BATCHES), "t", "10 seconds", None, ["k"], [], Count(), "0 seconds", "60 seconds", "cnt")
    got = sorted((r.window_start, r.k, r.cnt, r.refined) for r in run_once(s, "refined").collect())
    # [0, 10) closes with a: 2, b: 1; the late b and c refine it; the a of the fourth batch is too late; b of 190 is late but allowed
    assert got == sorted([(at(0), "a", 2, False), (at(0), "b", 1, False), (at(0), "b", 2, True), (at(0), "c", 1, True),
                          (at(30), "a", 2, False), (at(190), "b", 1, True), (at(200), "z", 1, False)])


def test_newest_ranking_wins(spark):
    s = stream_aggregate(_stream(spark, [BATCHES[0], [(32, "a")], *BATCHES[1:]]), "t", "10 seconds", None, ["k"], [], Count(), "0 seconds", "60 seconds", "cnt")
    out = scratch_path(spark, "refined-top")
    start_refined_topn(s.drop("refined"), "k", 2, out, "60 seconds").awaitTermination()
    newest = {}
    for r in newest_rankings(spark, out).collect():
        newest.setdefault(r.window_start, []).append((r["rank"], r.k, r.cnt))
    assert sorted(newest[at(0)]) == [(1, "a", 2), (2, "b", 2)]  # c: 1 is third
    log = ranking_log(spark, out).where(F.col("window_start") == F.lit(at(0))).collect()
    assert len({r.batch for r in log}) == 2
    first = min(r.batch for r in log)
    assert sorted((r["rank"], r.k, r.cnt) for r in log if r.batch == first) == [(1, "a", 2), (2, "b", 1)]


def test_closing_and_refining_in_one_batch_ranks_the_newest_count(spark):
    s = stream_aggregate(_stream(spark, BATCHES), "t", "10 seconds", None, ["k"], [], Count(), "0 seconds", "60 seconds", "cnt")
    out = scratch_path(spark, "refined-once")
    start_refined_topn(s.drop("refined"), "k", 2, out, "60 seconds").awaitTermination()
    got = ranking_log(spark, out).where(F.col("window_start") == F.lit(at(0))).collect()
    assert sorted((r["rank"], r.k, r.cnt) for r in got) == [(1, "a", 2), (2, "b", 2)]


def test_rankings_of_open_windows_are_joined_without_broadcasts(spark):
    """Counts and windows grow with the stream; a broadcast would bring them to the driver (F1)."""
    from eventlens.streaming.aggregates import rank_again
    cols = "window_start long, window_end long, k long, cnt long"
    new = spark.createDataFrame([(0, 6, 1, 9), (0, 6, 3, 1)], cols)
    last = spark.createDataFrame([(0, 6, 1, 4), (0, 6, 2, 5), (6, 12, 1, 7)], cols)
    ranked, rest = rank_again(new, last, "k", 2, "cnt")
    assert sorted((r.window_end, r["rank"], r.k, r.cnt) for r in ranked.collect()) == [(6, 1, 1, 9), (6, 2, 2, 5)]
    assert [tuple(r) for r in rest.collect()] == [(6, 12, 1, 7)]
    for df in (ranked, rest):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
