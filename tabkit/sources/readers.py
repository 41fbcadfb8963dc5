"""Table readers: CSV with separator and encoding detection, JSON dictionary, literals."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.runtime import col

# Saved selections are looked up in this order, first hit wins.
MODEL_COLUMNS = {
    "kmeans": "cluster_kmeans",
    "dbscan": "cluster_dbscan",
    "fuzzy": "cluster_fuzzy",
    "subtractive": "cluster_subtractive",
}


# Texts that mean a missing value in ordinary CSV files.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def separator_of(header: str, seps: tuple[str, ...]) -> str:
    """The separator under which the header has most fields, quotes respected; among equals one that leaves no quote inside a field."""
    def fields(sep: str) -> tuple[int, bool]:
        parts = next(csv.reader([header], delimiter=sep))
        return len(parts), not any('"' in p for p in parts)
    return max(seps, key=fields)


def _missing_to_null(df: DataFrame, missing: tuple[str, ...]) -> DataFrame:
    out = []
    for f in df.schema:
        c = col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.when(~F.trim(c).isin(*missing), c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def _typed(df: DataFrame) -> DataFrame:
    """Text columns in the narrowest type that holds all their values; one aggregate over the table."""
    kinds = ["int", "bigint", "double", "date", "timestamp", "boolean"]
    day = r"^\d{4}-\d{2}-\d{2}$"

    def fits(c: Column, kind: str) -> Column:
        text = F.trim(c)
        if kind in ("date", "timestamp"):  # a bare number is no date
            text = F.when(F.rlike(text, F.lit(day if kind == "date" else r"^\d{4}-\d{2}-\d{2}[ T]")), text)
        return F.count_if(c.isNotNull() & text.try_cast(kind).isNull()) == 0
    row = df.agg(*[x for i, n in enumerate(df.columns) for x in (F.count(col(n)).alias(f"n{i}"), *[fits(col(n), k).alias(f"{k}{i}") for k in kinds])]).first()
    out = []
    for i, n in enumerate(df.columns):
        kind = next((k for k in kinds if row[f"{k}{i}"]), "string") if row[f"n{i}"] else "string"
        out.append((col(n) if kind == "string" else F.trim(col(n)).cast(kind)).alias(n))
    return df.select(*out)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, seps: tuple[str, ...] = (",", ";"),
             encodings: tuple[str, ...] = ("UTF-8", "ISO-8859-1"), encoding: str | None = None, missing: tuple[str, ...] = MISSING,
             multiline: bool = False) -> DataFrame:
    """CSV with a header line. The separator is the one that cuts the header into most fields. Missing-value texts, NaN and infinities are null.
    ``multiline`` reads quoted line breaks as part of a field (such a file is not split among tasks).

    Without ``encoding`` the first of ``encodings`` is used under which no line is undecodable, which costs a pass over the file;
    without a schema the types cost another one. Give both for large inputs.
    """
    header = spark.read.text(path).where(F.length("value") > 0).first()
    if header is None:
        raise ValueError(f"no rows in {path}")
    if encoding is None:
        broken = len(encodings) > 1 and not spark.read.text(path).where(~F.is_valid_utf8("value")).isEmpty()
        encoding = encodings[1] if broken else encodings[0]
    reader = (spark.read.option("header", True).option("sep", separator_of(header[0], seps)).option("encoding", encoding)
              .option("escape", '"').option("multiLine", multiline))
    df = reader.schema(schema).csv(path) if schema is not None else reader.csv(path)
    df = _missing_to_null(df.toDF(*[c.lstrip("\ufeff") for c in df.columns]), missing)
    return df if schema is not None else _missing_to_null(_typed(df), missing)


def first_csv(spark: SparkSession, folder: str, **options) -> DataFrame:
    """First ``*.csv`` file of a folder in name order; error when there is none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path")
    row = files.agg(F.min("path")).first()
    if row[0] is None:
        raise FileNotFoundError(f"no CSV file in {folder}")
    return read_csv(spark, row[0], **options)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Data dictionary: a JSON object with ``description``, ``period`` and a ``columns`` map.

    Gives one row per described column.
    """
    schema = "description string, period string, columns map<string,string>"
    return (spark.read.schema(schema).option("multiLine", True).json(path)
            .select("description", "period", F.explode_outer("columns").alias("column", "meaning")))


def read_rows(spark: SparkSession, rows: list, schema) -> DataFrame:
    """Small literal table written in code."""
    return spark.createDataFrame(rows, schema)


def selected_model(spark: SparkSession, path: str) -> tuple[str, str]:
    """Which algorithm a saved text selection names, with its label column."""
    text = F.lower(F.col("value"))
    flags = spark.read.text(path).agg(*[F.bool_or(text.contains(name)).alias(name) for name in MODEL_COLUMNS]).first()
    for name, column in MODEL_COLUMNS.items():
        if flags[name]:
            return name, column
    raise ValueError(f"{path} names none of {', '.join(MODEL_COLUMNS)}")
