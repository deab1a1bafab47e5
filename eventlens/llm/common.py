"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold ``8m`` of rows, unless the session names a size:
    texts are long, and a task holds several batches at once."""
    if spark.conf.get(_BATCH, "8m") == "67108864b":
        spark.conf.set(_BATCH, "8m")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; others are pruned."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master gets a folder of its own; elsewhere an unset
    folder is an error, as a machine-local one would lose files with
    their executor."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="eventlens-llm-")
        sc.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/eventlens-llm/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor costs its running tasks, never the
    steps before."""
    return _write(df, new_path(df.sparkSession, name))


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that a newer one replaces."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def map_rows(docs: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """Batches of all columns through ``fn``, which keeps their number and types.

    The columns are numbered meanwhile: Arrow functions do not take every name."""
    names = docs.columns
    numbered = docs.toDF(*(f"c{i}" for i in range(len(names))))
    return numbered.mapInArrow(per_batch(fn), numbered.schema).toDF(*names)


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None]):
    """A mapInArrow function from one on a single batch; empty batches are skipped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = fn(b)
                if out is not None:
                    yield from out.to_batches() if isinstance(out, pa.Table) else [out]
    return run


def text_spans(texts: pa.Array, limit: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch holding about ``limit`` bytes each (one row at least)."""
    sizes = texts.nbytes // max(1, len(texts))
    lo, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t.as_py() or "") if sizes > limit else sizes
        if i > lo and held + n > limit:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(texts):
        yield lo, len(texts)
