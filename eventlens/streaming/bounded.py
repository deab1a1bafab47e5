"""A bounded table as a stream that ends.

A stream cannot know that its input is over, so the last windows and
timers of a bounded run would stay open.  ``stage`` writes a table as
files in event-time order (rows out of order by less than a bound, and
optionally some that come too late) and then one file of end markers: one
row per value of the columns that filters use, far in the future and
under keys of their own.  The markers move the watermark of every query
past all real rows; their own windows and timers stay open, so they never
reach a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions.time import duration_us

#: How far behind the newest row the end markers lie.
END_AFTER = "1000 days"


#: Rows of a micro-batch that one file holds at least, where there are several.
FILE_ROWS = 50_000


def _in_order(spark: SparkSession, path: str, folders: int) -> None:
    """Give the files of each folder a time of its own: the file source takes older files first."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    root = fs_path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    now = int(fs.getFileStatus(root).getModificationTime())
    for i in range(folders):
        for f in fs.globStatus(fs_path(f"{path}/{i:03d}/part-*")) or []:
            fs.setTimes(f.getPath(), now - 10_000 * (folders - i), -1)


def stage(df: DataFrame, ts: str, path: str, markers: list[dict], files: int = 3, disorder="0 seconds",
          tie: str = "event_id", late: Column | None = None, only: range | None = None) -> int:
    """Write ``df`` under ``path``, a folder per micro-batch, markers last; returns the files of a folder.

    A row goes to the folder of its time plus up to ``disorder`` (by a hash
    of ``tie``); rows that meet ``late`` all go to the last one, rows without
    a time to the first.  All folders are written at once, each as several
    files, by as many tasks.  ``markers`` gives each marker row's columns other
    than ``ts``; ``only`` writes some of the folders (``files`` is the markers')."""
    spark = df.sparkSession
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    lo, hi, rows = df.agg(F.min(us), F.max(us), F.count(F.lit(1))).first()
    if lo is None:
        lo = hi = 0
    width = (hi - lo) // files + 1
    wait = duration_us(disorder)
    shift = F.pmod(F.xxhash64(tie), F.lit(wait)) if wait else F.lit(0)
    at = F.greatest(F.least(F.floor((us - F.lit(lo) + shift) / width), F.lit(files - 1)), F.lit(0))
    at = F.when(late, F.lit(files - 1)).otherwise(at) if late is not None else at
    at = F.when(us.isNull(), F.lit(0)).otherwise(at).cast("int")
    parts = max(1, min(rows // (files * FILE_ROWS), 4 * spark.sparkContext.defaultParallelism))
    # each (folder, part) is one task and one file, so a micro-batch is known by its number of files
    slot = (F.col("_file") * parts + F.pmod(F.xxhash64(tie, F.lit(7)), F.lit(parts))).cast("int")
    placed = df.withColumn("_file", at).withColumn("_slot", slot)
    do = range(files + 1) if only is None else only
    some = [i for i in do if i < files]
    if some:
        own = placed.where(F.col("_file").isin(some)).withColumn("_slot", F.col("_slot") - F.lit(min(some) * parts))
        tmp = f"{path}/.all-{min(some)}"
        own.repartitionById(len(some) * parts, F.col("_slot")).drop("_slot").write.partitionBy("_file").parquet(tmp)
        fs_path = spark._jvm.org.apache.hadoop.fs.Path
        fs = fs_path(tmp).getFileSystem(spark._jsc.hadoopConfiguration())
        for i in some:
            done = fs_path(f"{tmp}/_file={i}")
            if fs.exists(done):
                fs.rename(done, fs_path(f"{path}/{i:03d}"))
    if files in do:
        end = F.timestamp_micros(F.lit(hi + duration_us(END_AFTER))).cast(df.schema[ts].dataType)
        ids = spark.range(len(markers)).coalesce(1)
        pick = [F.element_at(F.array(*[F.lit(m.get(f.name)).cast(f.dataType) for m in markers]), (F.col("id") + 1).cast("int")).alias(f.name)
                if f.name != ts else end.alias(ts) for f in df.schema.fields]
        ids.select(*pick).write.parquet(f"{path}/{files:03d}")
    _in_order(spark, path, files + 1)
    return parts


def staged_stream(spark: SparkSession, schema, path: str, parts: int = 1) -> DataFrame:
    """The staged files, a folder of ``parts`` files per micro-batch."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", parts)
            .option("recursiveFileLookup", "true").parquet(path))
