"""Streaming forms equal the batch forms on the same rows (SURVEY §5 (3)).

Input: driver table ``events`` (sf0.001) cut into several files by time,
rows near each cut pushed into the next file (out of order by less than
the watermark delay), plus a sentinel view a year later (user -1, which no
other row has) so every window and timer closes; the sentinel's own
windows stay open and never reach the results.
"""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from eventlens.operators.joins import interval_join
from eventlens.operators.limits import click_cap
from eventlens.operators.patterns import consecutive_pairs, fail_bursts, followed_by, match_outcomes
from eventlens.operators.topn import top_n_per_window
from eventlens.operators.windows import window_counts, window_distinct
from eventlens.session import scratch_path
from eventlens.streaming import (
    run_to_memory, start_stream_topn, stream_click_cap, stream_consecutive_pairs, stream_fail_bursts,
    stream_followed_by, stream_interval_join, stream_match_outcomes, stream_window_counts,
    stream_window_distinct,
)

SF = "/root/testdata/sf0.001"
DELAY = "2 hours"


@pytest.fixture(scope="module")
def split_events(spark):
    ev = (spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
          .withColumn("seq", F.col("event_id")))
    rows = ev.collect()  # 1,000 test rows
    rnd = random.Random(5)
    span = 7 * 86400
    t0 = min(r.ts for r in rows).timestamp()
    files = {}
    for r in rows:
        jitter = rnd.uniform(0, 3600)            # < DELAY: never late
        files.setdefault(int((r.ts.timestamp() - t0 + jitter) // span), []).append(r)
    far = max(r.ts for r in rows).replace(year=max(r.ts for r in rows).year + 1)
    sentinel = ev.limit(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit(far).alias("ts"),
                                  F.lit(-1).cast("long").alias("user_id"), F.lit("view").alias("event_type"),
                                  F.lit(0.0).alias("value"), F.lit("{}").alias("props"), F.lit(-1).cast("long").alias("seq"))
    root = scratch_path(spark, "stream-test-input")
    for i, k in enumerate(sorted(files)):
        part = files[k]
        rnd.shuffle(part)
        spark.createDataFrame(part, ev.schema).coalesce(1).write.parquet(f"{root}/f{i:03d}")
    sentinel.coalesce(1).write.parquet(f"{root}/f999")
    batch = spark.createDataFrame(rows, ev.schema)
    return root, ev.schema, batch


def stream_of(spark, split_events):
    root, schema, _ = split_events
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(root))


def same(a, b, cols=None):
    cols = cols or a.columns
    return sorted(tuple(r) for r in a.select(*cols).collect()) == sorted(tuple(r) for r in b.select(*cols).collect())


def name():
    return "q" + uuid.uuid4().hex[:10]


def test_stream_window_counts_direct_and_panes(spark, split_events):
    _, _, batch = split_events
    for size, slide in [("1 day", "6 hours"), ("2 hours", "10 minutes")]:
        s = stream_window_counts(stream_of(spark, split_events), "ts", size, slide, ["event_type"], delay=DELAY)
        got = run_to_memory(s, name())
        assert same(got, window_counts(batch, "ts", size, slide, ["event_type"])), (size, slide)


def test_stream_distinct(spark, split_events):
    _, _, batch = split_events
    s = stream_window_distinct(stream_of(spark, split_events).filter("event_type = 'view'"), "ts", "1 day",
                               distinct_col="user_id", delay=DELAY)
    got = run_to_memory(s, name())
    assert same(got, window_distinct(batch.filter("event_type = 'view'"), "ts", "1 day", distinct_col="user_id"))


def test_stream_topn_per_batch(spark, split_events):
    _, _, batch = split_events
    counts = stream_window_counts(stream_of(spark, split_events).filter("event_type = 'view'"), "ts",
                                  "1 day", "6 hours", ["user_id"], delay=DELAY)
    out = scratch_path(spark, "topn-out")
    q = start_stream_topn(counts, "user_id", 3, out)
    q.awaitTermination()
    got = spark.read.parquet(out).drop("batch")
    exp = top_n_per_window(window_counts(batch.filter("event_type = 'view'"), "ts", "1 day", "6 hours",
                                         ["user_id"]), "user_id", 3)
    assert same(got, exp, ["window_start", "window_end", "user_id", "cnt", "rank"])


def test_stream_pairs_and_bursts(spark, split_events):
    _, _, batch = split_events
    err = F.col("event_type") == "error"
    s = stream_consecutive_pairs(stream_of(spark, split_events), ["user_id"], err, "1 day", delay=DELAY)
    assert same(run_to_memory(s, name()), consecutive_pairs(batch, ["user_id"], err, "1 day"))
    s = stream_fail_bursts(stream_of(spark, split_events), ["user_id"], err, "1 day", 2, delay=DELAY)
    assert same(run_to_memory(s, name()), fail_bursts(batch, ["user_id"], err, "1 day", 2))


def test_stream_followed_by_and_outcomes(spark, split_events):
    _, _, batch = split_events
    a, b = F.col("event_type") == "signup", F.col("event_type") == "purchase"
    s = stream_followed_by(stream_of(spark, split_events), ["user_id"], a, b, "1 day", delay=DELAY)
    assert same(run_to_memory(s, name()), followed_by(batch, ["user_id"], a, b, "1 day"))
    # D4 keeps only create/pay rows, so only they move its watermark: the
    # sentinel must be one of them to close the last deadlines.
    src = stream_of(spark, split_events).withColumn(
        "event_type", F.when(F.col("user_id") == -1, "signup").otherwise(F.col("event_type")))
    s = stream_match_outcomes(src, ["user_id"], a, b, "1 day", "1 day", delay=DELAY)
    got = run_to_memory(s, name()).filter("user_id >= 0")
    assert same(got, match_outcomes(batch, ["user_id"], a, b, "1 day", "1 day"))


def test_stream_click_cap(spark, split_events):
    _, _, batch = split_events
    s = stream_click_cap(stream_of(spark, split_events), ["user_id", "event_type"], cap=2, delay=DELAY)
    got = run_to_memory(s, name()).filter("user_id >= 0")
    passed, warn = click_cap(batch, ["user_id", "event_type"], cap=2)
    assert same(got.filter("tag = 'passed'"), passed, ["user_id", "event_type", "ts", "seq"])
    assert same(got.filter("tag = 'warning'"), warn, ["user_id", "event_type", "day", "ts"])


def test_stream_interval_join(spark, split_events):
    _, _, batch = split_events

    def sides(df):
        c = df.filter("event_type = 'click'").select("user_id", F.col("ts").alias("c_ts"), F.col("event_id").alias("c_id"))
        p = df.filter("event_type = 'purchase'").select(F.col("user_id").alias("p_user"), F.col("ts").alias("p_ts"),
                                                        F.col("event_id").alias("p_id"))
        return c, p
    sc, sp = sides(stream_of(spark, split_events))
    s = stream_interval_join(sc, sp, [("user_id", "p_user")], "c_ts", "p_ts", "-6 hours", "6 hours", DELAY, DELAY)
    bc, bp = sides(batch)
    exp = interval_join(bc, bp, [("user_id", "p_user")], "c_ts", "p_ts", "-6 hours", "6 hours")
    assert same(run_to_memory(s, name()), exp, ["c_id", "p_id"])


def test_stream_capped_window_counts(spark, split_events):
    """D1b in one streaming query: cap output carries event time into a window count."""
    from eventlens.streaming import stream_capped_window_counts
    _, _, batch = split_events
    s = stream_capped_window_counts(stream_of(spark, split_events), ["user_id"], ["event_type"], "1 day",
                                    "6 hours", cap=5, delay=DELAY)
    got = run_to_memory(s, name())
    passed, _ = click_cap(batch, ["user_id"], cap=5)
    assert same(got, window_counts(passed, "ts", "1 day", "6 hours", ["event_type"]))


def test_update_mode_refines_with_lateness(spark, split_events):
    """T4: update mode emits a window early and again when more rows arrive."""
    from eventlens.streaming import lateness_delay
    s = stream_window_counts(stream_of(spark, split_events), "ts", "7 days", None, [],
                             delay=lateness_delay("1 hour", "1 hour"))
    got = run_to_memory(s, name(), output_mode="update")
    per_window = {}
    for r in got.collect():
        per_window.setdefault(r.window_start, []).append(r.cnt)
    assert any(len(v) > 1 for v in per_window.values())        # refinements
    final = {k: max(v) for k, v in per_window.items()}
    _, _, batch = split_events
    exp = {r.window_start: r.cnt for r in window_counts(batch, "ts", "7 days").collect()}
    assert all(final[k] == v for k, v in exp.items())


def test_user_defined_machine(spark, split_events):
    """KeyedProcessFunction surface: a user machine -- running count of views
    per user, emitted on every 10th view -- equals the batch answer."""
    from pyspark.sql import Window

    from eventlens.streaming import replay
    from eventlens.streaming.machines import Machine

    class EveryTenth(Machine):
        fields = ("v",)
        out_fields = (("n", "long"), ("at_ts", "long"))

        def step(self, c, r):
            if not r["v"]:
                return []
            c["n"] = c.get("n", 0) + 1
            return [{"n": c["n"], "at_ts": r["ts"]}] if c["n"] % 10 == 0 else []

        def idle(self, c):
            return False

    _, _, batch = split_events
    s = replay(stream_of(spark, split_events).filter("user_id >= 0"), ["user_id"], "ts", "seq", DELAY,
               EveryTenth(), {"v": F.col("event_type") == "view"})
    got = run_to_memory(s, name())
    w = Window.partitionBy("user_id").orderBy("ts", "seq")
    exp = (batch.filter("event_type = 'view'").withColumn("n", F.row_number().over(w).cast("long"))
           .filter("n % 10 = 0").select("user_id", "n", F.col("ts").alias("at_ts")))
    assert same(got, exp)
