"""Corpus pipeline: the stages a training corpus goes through, in order.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; ``run`` writes every
stage's result as Parquet to the shared folder and rereads it as the next
one's documents.  All stages but the last keep the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm import common, decontaminate, packing, pii, quality, simhash


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that meet the base limits and no learned rule for low quality."""
    rules = quality.learn(docs, common.table(spark, sf_dir, "labels"))
    return quality.keep(docs, rules)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component: the one with the smallest doc_id, a null id last."""
    return simhash.keep_first(docs, shingle=4, radius=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a 10-word window of a benchmark item."""
    return decontaminate.decontaminate(docs, common.table(spark, sf_dir, "benchmark"), window=10)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data; ``n_chars`` follows the text."""
    out = pii.mask(docs, pii.train(docs))
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the texts into sequences of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end=0, size=2048)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: A learned list and a trained model take part: no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
