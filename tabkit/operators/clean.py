"""Type coercion, text cleaning, value replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..functions.runtime import col


def _change(df: DataFrame, cols: list[str], fn) -> DataFrame:
    return df.withColumns({c: fn(col(c)) for c in cols}) if cols else df


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Number or null."""
    return _change(df, cols, S.to_number)


def parse_numbers(df: DataFrame, cols: list[str], thousands: str = ",") -> DataFrame:
    return _change(df, cols, lambda c: S.parse_number(c, thousands))


def parse_ratio(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: rows, non-null rows and rows that parse as a number. One aggregate."""
    from ..functions.runtime import rows_from
    agg = df.agg(F.count(F.lit(1)).alias("n"), *[
        e for i, c in enumerate(cols) for e in (
            F.count(col(c)).alias(f"f{i}"), F.count(S.to_number(col(c))).alias(f"p{i}"))])
    return agg.select(rows_from([
        F.struct(F.lit(c).alias("column"), F.col("n").alias("n_rows"), F.col(f"f{i}").alias("n_filled"),
                 F.col(f"p{i}").alias("n_numeric")) for i, c in enumerate(cols)]))


def coerce_if(df: DataFrame, cols: list[str] | None = None, min_ratio: float | None = None,
              min_count: int = 1, of_filled: bool = False) -> DataFrame:
    """Convert a text column only when enough of it parses.

    ``min_ratio`` counts parsed values against all rows, or against the non-null ones with
    ``of_filled``; without it ``min_count`` parsed values are enough.
    """
    cols = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)] if cols is None else cols
    if not cols:
        return df
    convert = []
    for r in parse_ratio(df, cols).collect():  # one row per column
        base = r["n_filled"] if of_filled else r["n_rows"]
        enough = r["n_numeric"] >= min_ratio * base and base > 0 if min_ratio is not None else r["n_numeric"] >= min_count
        if enough:
            convert.append(r["column"])
    return coerce_numeric(df, convert)


def parse_dates(df: DataFrame, cols: list[str], formats=("yyyy-MM-dd", "yyyy-MM", "dd/MM/yyyy")) -> DataFrame:
    return _change(df, cols, lambda c: S.parse_date(c, tuple(formats)))


def clean_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)] if cols is None else cols
    return _change(df, cols, S.clean_text)


def tokens_to_null(df: DataFrame, cols: list[str] | None = None, tokens: list[str] | None = None) -> DataFrame:
    cols = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)] if cols is None else cols
    return _change(df, cols, lambda c: S.token_to_null(c, tokens))


def replace_values(df: DataFrame, name: str, mapping: dict) -> DataFrame:
    """Exact value replacement; other values stay."""
    out = None
    for old, new in mapping.items():
        cond = col(name) == F.lit(old)
        out = F.when(cond, F.lit(new)) if out is None else out.when(cond, F.lit(new))
    return df if out is None else df.withColumn(name, out.otherwise(col(name)))


def clip(df: DataFrame, name: str, low: float | None = None, high: float | None = None) -> DataFrame:
    return df.withColumn(name, S.clip(col(name), low, high))


def log_transform(df: DataFrame, name: str, kind: str = "log10", out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"{name}_{kind}", S.log_of(col(name), kind))


def inf_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return _change(df, cols, S.finite)


def round_cols(df: DataFrame, cols: list[str], n: int) -> DataFrame:
    return _change(df, cols, lambda c: F.bround(c, n))


def to_int(df: DataFrame, cols: list[str], mode: str = "truncate") -> DataFrame:
    return _change(df, cols, lambda c: S.to_int(c, mode))
