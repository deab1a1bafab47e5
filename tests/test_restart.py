"""A stream stopped and restarted from its checkpoint gives the batch answer
(SURVEY §5 (4)): state (window counts, transformWithState buffers and
timers) survives the restart, and the file sink does not duplicate."""

from pyspark.sql import functions as F

from eventlens.operators.patterns import consecutive_pairs
from eventlens.operators.windows import window_counts
from eventlens.session import scratch_path
from eventlens.streaming import run_to_parquet, stream_consecutive_pairs, stream_window_counts

SF = "/root/testdata/sf0.001"


def test_restart_from_checkpoint(spark):
    ev = (spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
          .withColumn("seq", F.col("event_id")))
    root = scratch_path(spark, "restart-in")
    cut = ev.selectExpr("percentile_approx(event_id, 0.5)").first()[0]
    ev.filter(F.col("event_id") < cut).coalesce(1).write.parquet(f"{root}/a")
    late = ev.filter(F.col("event_id") >= cut)
    sentinel = ev.limit(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit("2030-01-01").cast("timestamp").alias("ts"),
                                  F.lit(-1).cast("long").alias("user_id"), F.lit("view").alias("event_type"),
                                  F.lit(0.0).alias("value"), F.lit("{}").alias("props"), F.lit(-1).cast("long").alias("seq"))

    def stream():
        return (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
                .option("recursiveFileLookup", "true").parquet(root))

    out_c, ck_c = scratch_path(spark, "restart-counts"), scratch_path(spark, "restart-counts-ck")
    out_p, ck_p = scratch_path(spark, "restart-pairs"), scratch_path(spark, "restart-pairs-ck")
    err = F.col("event_type") == "error"

    def run_both():
        c = run_to_parquet(stream_window_counts(stream(), "ts", "1 day", "6 hours", ["event_type"], delay="1 hour"),
                           "restart_counts", out_c, ck_c)
        p = run_to_parquet(stream_consecutive_pairs(stream(), ["user_id"], err, "1 day", delay="1 hour"),
                           "restart_pairs", out_p, ck_p)
        return c, p

    run_both()                                      # first half, then stop
    late.coalesce(1).write.parquet(f"{root}/b")     # more data arrives
    sentinel.coalesce(1).write.parquet(f"{root}/c")
    counts, pairs = run_both()                      # resume from the checkpoints

    exp_c = window_counts(ev, "ts", "1 day", "6 hours", ["event_type"])
    got_c = counts.filter("window_start < '2029-01-01'")
    assert sorted(got_c.collect()) == sorted(exp_c.collect())
    assert sorted(pairs.collect()) == sorted(consecutive_pairs(ev, ["user_id"], err, "1 day").collect())


def test_restart_by_name_alone(spark):
    """The default paths come from the query's name: a second run resumes."""
    import uuid
    name = f"by_name_{uuid.uuid4().hex[:8]}"
    root = scratch_path(spark, "by-name-in")
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    half = ev.filter("event_id % 2 = 0")
    half.coalesce(1).write.parquet(f"{root}/a")

    def run():
        s = spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").parquet(root)
        return run_to_parquet(s.select("event_id"), name).count()
    assert run() == half.count()
    assert run() == half.count()                     # nothing new: nothing read again
    ev.filter("event_id % 2 = 1").coalesce(1).write.parquet(f"{root}/b")
    assert run() == ev.count()


def test_no_machine_local_folder_off_a_local_master():
    import pytest
    from eventlens.session import ensure_checkpoint_dir

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())
