"""The corpus pipeline: quality rules, near-duplicates, benchmark decontamination, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's
docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions.runtime import scratch_path, temporary_scratch
from tabkit.llm import decontaminate, packing, quality, resemblance, secrets
from tabkit.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None  # near-duplicate groups, the entropy scan and packing have no SQL form


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules, with the failing lines taken out of their text."""
    judged = quality.clean_lines(docs, prefix="quality_").where("quality_kept")
    changed = F.col("quality_clean_text")
    return judged.withColumns({"text": changed, "n_chars": F.length(changed).cast(docs.schema["n_chars"].dataType)}).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return resemblance.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    scanned = secrets.scan_secrets(docs)
    return scanned.withColumns({"text": F.col("redacted"), "n_chars": F.length("redacted").cast(docs.schema["n_chars"].dataType)}).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer_path(), remember=False)


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_duplicates), ("benchmark decontamination", benchmark_decontamination),
          ("secret scan", secret_scan), ("best-fit packing", best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        with temporary_scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
