"""Training-corpus pipeline over ``documents``: quality rules, near-duplicate
removal, benchmark decontamination, secret redaction, packing.

Every stage works on all that its predecessor kept, and its decisions take
effect.  All but the last return the columns of their input; the last returns
one row per packed piece.  Tables between stages are written as Parquet in the
shared folder and read back, so a lost executor costs the stage it ran.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, near_dup, packing, quality, secrets
from tidemark.llm.common import prepare, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their histograms reject go."""
    prepare(spark)
    return quality.quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the smallest document id stays."""
    prepare(spark)
    return near_dup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare(spark)
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; ``n_chars`` follows a changed text."""
    prepare(spark)
    if "n_chars" not in docs.columns:
        return secrets.redact_secrets(docs)
    before = "n_chars_before"
    while before in docs.columns:
        before += "_"
    marked = secrets.redact_secrets(docs.withColumn(before, F.length("text")))
    changed = ~F.length("text").eqNullSafe(F.col(before))
    size = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return marked.withColumn("n_chars", size).drop(before)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows: one row per piece."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: Shingle samples and tokens are beyond SQL; tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
