"""Driver parquet tables (TESTDATA.md): ``{dir}/{name}.parquet``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES, register: bool = False) -> dict:
    out = {n: load_table(spark, sf_dir, n) for n in names}
    if register:
        for n, df in out.items():
            df.createOrReplaceTempView(n)
    return out

