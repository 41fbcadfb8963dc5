"""Projections, filters, renames, sorts and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ordered import in_order, row_number
from ..functions.runtime import col


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Absent columns are ignored."""
    return df.drop(*cols)


def select_features(df: DataFrame, drop: list[str] = (), cols: list[str] | None = None) -> DataFrame:
    """Feature columns in name order; error when none remain."""
    names = sorted(c for c in (cols or df.columns) if c not in set(drop))
    if not names:
        raise ValueError("no feature columns remain")
    return df.select(*[col(c) for c in names])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def rename_all(df: DataFrame, names: list[str]) -> DataFrame:
    return df.toDF(*names)


def normalize_names(df: DataFrame, lower: bool = False) -> DataFrame:
    names = [c.strip().lower() if lower else c.strip() for c in df.columns]
    return df.toDF(*names)


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Column names by kind: ``numeric``, ``text``, ``bool``, ``categorical`` (text or bool), ``time``."""
    tests = {
        "numeric": lambda t: isinstance(t, T.NumericType),
        "text": lambda t: isinstance(t, T.StringType),
        "bool": lambda t: isinstance(t, T.BooleanType),
        "categorical": lambda t: isinstance(t, (T.StringType, T.BooleanType)),
        "time": lambda t: isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)),
    }
    return [f.name for f in df.schema if tests[kind](f.dataType)]


def with_expr(df: DataFrame, name: str, expr: Column) -> DataFrame:
    return df.withColumn(name, expr)


def where(df: DataFrame, *conditions: Column) -> DataFrame:
    for c in conditions:
        df = df.where(c)
    return df


def filter_range(df: DataFrame, name: str, low: float, high: float, keep_null: bool = True) -> DataFrame:
    inside = col(name).between(low, high)
    return df.where(inside | col(name).isNull()) if keep_null else df.where(inside)


def where_in(df: DataFrame, name: str, values: list) -> DataFrame:
    return df.where(col(name).isin(list(values)))


def exclude_contains(df: DataFrame, name: str, text: str) -> DataFrame:
    """Drop rows whose text holds ``text``, whatever the case; null rows stay."""
    return df.where(~F.coalesce(F.lower(col(name)).contains(text.lower()), F.lit(False)))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Delete the rows the condition holds for; unknown (null) keeps the row."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def drop_positions(df: DataFrame, order: list[str], positions: list[int], rows_per_task: int | None = None) -> DataFrame:
    """Delete rows by their 0-based position in ``order``."""
    numbered = in_order(df, [], order, {"__pos": row_number()}, rows_per_task)
    return numbered.where(~(F.col("__pos") - 1).isin(list(positions))).drop("__pos")


def drop_constant(df: DataFrame) -> DataFrame:
    """Remove columns with at most one distinct non-null value (min = max)."""
    comparable = [f.name for f in df.schema if not isinstance(f.dataType, (T.ArrayType, T.MapType))]
    row = df.agg(*[(F.min(col(c)) < F.max(col(c))).alias(f"v{i}") for i, c in enumerate(comparable)]).first()
    varying = {c for c, v in zip(comparable, row) if v}
    return df.select(*[col(c) for c in df.columns if c in varying or c not in comparable])


def head(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("long"))


def split_xy(df: DataFrame, label: str, also_drop: list[str] = (), key: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Features and label; ``key`` columns stay on both sides so that they can be joined again."""
    drop = [c for c in {label, *also_drop} if c not in key]
    return df.drop(*drop), df.select(*[col(k) for k in key], col(label))


def sort(df: DataFrame, keys: list[tuple[str, bool]]) -> DataFrame:
    """Sort by (column, ascending) pairs, nulls last either way."""
    return df.orderBy(*[col(c).asc_nulls_last() if up else col(c).desc_nulls_last() for c, up in keys])


def top_k(df: DataFrame, by: list[tuple[str, bool]], k: int) -> DataFrame:
    """First k rows in (column, ascending) order; each task keeps only k candidates."""
    return sort(df, by).limit(k)


def argmax(df: DataFrame, group: list[str], value: str, tie: str, take: list[str]) -> DataFrame:
    """Row of the largest value per group; the smallest tie column wins equal values."""
    best = F.min_by(F.struct(*[col(t).alias(f"t{i}") for i, t in enumerate(take)]),
                    F.struct((-col(value)).alias("v"), col(tie).alias("t")))
    out = df.groupBy(*[col(g) for g in group]).agg(best.alias("__best"))
    return out.select(*[col(g) for g in group], *[F.col("__best")[f"t{i}"].alias(t) for i, t in enumerate(take)])
