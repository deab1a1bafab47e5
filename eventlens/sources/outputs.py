"""Several differently typed outputs of one streaming query.

Every micro-batch is written once, whatever the number of outputs: a row
goes to each output whose condition it meets, as that output's own
struct, and the folders are partitioned by output.  A batch counts when
its commit record exists, which is created last and in one step, and
readers take committed batches alone; so nobody reads half a batch, and
a batch that is retried overwrites its own folder and duplicates nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.session import state_stores


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def committed(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed batches."""
    p, fs = _path(spark, f"{root}/commits")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p)) if fs.exists(p) else []


def write_outputs(batch: DataFrame, batch_id: int, outputs: dict[str, tuple[Column, list[Column]]], root: str) -> None:
    """One pass over ``batch``, then its commit record."""
    spark = batch.sparkSession
    if batch_id in committed(spark, root):
        return  # a retry of what is done
    which = F.filter(F.array(*(F.when(cond, F.lit(name)) for name, (cond, _) in outputs.items())), lambda x: x.isNotNull())
    structs = [F.struct(*cols).alias(name) for name, (_, cols) in outputs.items()]
    rows = batch.select(which.alias("_to"), *structs).select(F.explode("_to").alias("output"), *outputs)
    # a row keeps only the struct of its own output
    rows = rows.select("output", *(F.when(F.col("output") == name, F.col(name)).alias(name) for name in outputs))
    rows.write.mode("overwrite").partitionBy("output").parquet(f"{root}/data/batch={batch_id}")
    p, fs = _path(spark, f"{root}/commits/{batch_id}")
    fs.mkdirs(p.getParent())
    fs.createNewFile(p)


def start_outputs(stream: DataFrame, outputs: dict[str, tuple[Column, list[Column]]], root: str, checkpoint: str | None = None,
                  trigger: dict | None = None, output_mode: str = "append"):
    """Start the query: ``outputs`` maps a name to its condition and its columns."""
    w = (stream.writeStream.foreachBatch(lambda batch, i: write_outputs(batch, i, outputs, root)).outputMode(output_mode)
         .option("checkpointLocation", checkpoint or f"{root.rstrip('/')}-checkpoint"))
    with state_stores(stream.sparkSession):
        return w.trigger(**(trigger or {"availableNow": True})).start()


def read_output(spark: SparkSession, root: str, name: str, schema) -> DataFrame:
    """One output's rows of all committed batches, in its own schema (a StructType or DDL)."""
    done = committed(spark, root)
    empty = spark.createDataFrame([], schema)
    paths = [f"{root}/data/batch={i}/output={name}" for i in done]
    paths = [p for p in paths if (lambda x: x[1].exists(x[0]))(_path(spark, p))]
    if not paths:
        return empty
    return spark.read.schema(f"{name} {empty.schema.simpleString()}").parquet(*paths).select(f"{name}.*")
