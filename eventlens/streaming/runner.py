"""Run a streaming DataFrame to completion into a table under the shared
checkpoint folder, and read it back as a batch DataFrame.

The checkpoint and output live under ``spark.checkpoint.dir`` (read from
the session) in folders named after the query, so a restarted driver that
passes the same name resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventlens.session import drop_path, scratch_path, stable_path, state_stores


def run_to_parquet(stream: DataFrame, name: str, out_path: str | None = None, checkpoint: str | None = None,
                   trigger: dict | None = None, timeout_s: float | None = None) -> DataFrame:
    """Append-mode file sink (exactly-once via its metadata log); returns the result."""
    spark = stream.sparkSession
    out_path = out_path or stable_path(spark, f"{name}-out")
    checkpoint = checkpoint or stable_path(spark, f"{name}-ckpt")
    with state_stores(spark):
        q = (stream.writeStream.format("parquet").outputMode("append")
             .option("path", out_path).option("checkpointLocation", checkpoint)
             .trigger(**(trigger or {"availableNow": True})).queryName(name).start())
    q.awaitTermination(timeout_s)
    if q.exception():
        raise q.exception()
    return spark.read.schema(stream.schema).parquet(out_path)


def run_once(stream: DataFrame, name: str) -> DataFrame:
    """A bounded stream from its start to its end into a folder of its own;
    its checkpoint goes when it is done."""
    spark = stream.sparkSession
    root = scratch_path(spark, name)
    out = run_to_parquet(stream, name, f"{root}/out", f"{root}/checkpoint")
    drop_path(spark, f"{root}/checkpoint")
    return out


def run_to_memory(stream: DataFrame, name: str, output_mode: str = "append", checkpoint: str | None = None):
    """Memory sink for tests (driver-side table: small results only)."""
    spark = stream.sparkSession
    q = (stream.writeStream.format("memory").queryName(name).outputMode(output_mode)
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"{name}-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.table(name)
