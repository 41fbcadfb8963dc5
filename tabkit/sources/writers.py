"""Sinks. Every writer is a distributed Spark write; none collects rows."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).option("escape", "\"").csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    df.write.mode(mode).partitionBy(*(partition_by or [])).parquet(path)


def write_report_json(df: DataFrame, path: str) -> None:
    """One JSON document per report row."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def write_report_text(df: DataFrame, path: str, template: str, cols: list[str]) -> None:
    """One formatted line per row, for example ``"%s: %d rows"``."""
    df.select(F.format_string(template, *cols).alias("value")).write.mode("overwrite").text(path)


def write_splits(splits: dict[str, DataFrame], path: str) -> None:
    """All splits in one table, one folder per split."""
    parts = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    out.write.mode("overwrite").partitionBy("split").parquet(path)


def write_metadata(spark: SparkSession, meta: dict, path: str) -> None:
    """Run settings (column roles, split sizes, bounds): one small JSON document."""
    spark.createDataFrame([(json.dumps(meta, sort_keys=True, default=str),)], "value string") \
        .write.mode("overwrite").text(path)


def save_params(params: DataFrame, path: str) -> None:
    params.write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
