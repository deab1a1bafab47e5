"""Text-file line sources (batch and stream).

``seq`` is a tiebreak for rows with equal event time: it follows line
order inside a file split and is stable on re-execution because it is
computed directly on the file scan.  ``read_numbered_lines`` gives true
line numbers, the same for every split size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, with_seq: bool = True) -> DataFrame:
    df = spark.read.text(path)
    if with_seq:
        df = df.withColumn("seq", F.monotonically_increasing_id())
    return df


def read_numbered_lines(spark: SparkSession, path) -> DataFrame:
    """``value, file, line``: every line with its number in its file, from 0, whatever the split size.

    Lines are counted per (file, block) first, one row each; the running sum
    over a file's blocks says where each block begins, and a line's place
    in its block is its place in the scan.  No file is read as one value."""
    scan = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    blocks = scan.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select("file", "_block", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    return scan.join(starts, ["file", "_block"]).select("value", "file", (F.col("_id") + F.col("_shift")).alias("line"))


def read_lines_stream(spark: SparkSession, path: str, max_files: int | None = None, numbered: bool = False) -> DataFrame:
    """Directory of text files as a stream of lines (``value``).

    ``numbered`` adds ``seq``, which grows with the line's place in its file, so
    that rows of one instant keep their order: the number of the line's block
    in the high bits, its place in the scan below.  Blank lines are left out."""
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if not numbered:
        return r.load(path)
    lines = r.load(path).select("value", F.col("_metadata.file_block_start").alias("block"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0  # a task reads a block's lines in order
        for b in batches:
            # blocks are 64 KB apart at least (spark.sql.files.maxPartitionBytes), files up to 64 TB
            high = pc.shift_left(pc.shift_right(b.column("block"), 16), 33)
            yield pa.RecordBatch.from_arrays([b.column("value"), pc.add(high, pa.array(range(at, at + b.num_rows), pa.int64()))], ["value", "seq"])
            at += b.num_rows
    return lines.mapInArrow(place, "value string, seq long").filter("value <> ''")


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """S3: socket line source.  Needs an external server; not exercised in tests."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
