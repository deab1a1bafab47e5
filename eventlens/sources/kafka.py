"""Kafka topic source and sink.

Thin option builders over Spark's Kafka connector.  The connector jar is
not on this machine's class path, so these are not exercised in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_stream(spark: SparkSession, servers: str, topic: str, group_id: str | None = None,
                 starting_offsets: str = "latest", extra: dict | None = None) -> DataFrame:
    """Topic values as a stream of strings in ``value`` (plus ``kafka_ts``)."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"),
                           F.col("timestamp").alias("kafka_ts"))


def write_lines_to_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """S4 re-aimed: publish a text DataFrame's ``value`` column to a topic (batch write)."""
    (df.select(F.col("value").cast("string").alias("value"))
       .write.format("kafka")
       .option("kafka.bootstrap.servers", servers)
       .option("topic", topic)
       .save())
