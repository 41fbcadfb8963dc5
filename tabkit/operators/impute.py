"""Missing values: dropping, constant and fitted fills, ordered fills, interpolation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import in_order, last_seen, next_seen, row_number
from ..functions.quantiles import quantile_columns
from ..functions.runtime import col
from ..functions.scalars import to_number
from .params import Params
from .profile import modes

# Fixed value: fill for a text column without any value.
UNKNOWN = "desconocido"


def drop_null_rows(df: DataFrame, how: str = "any", thresh: int | None = None, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(how=how, thresh=thresh, subset=subset)


def drop_null_columns(df: DataFrame) -> DataFrame:
    row = df.agg(*[F.count_if(col(c).isNull()) for c in df.columns]).first()
    return df.select(*[col(c) for c, n in zip(df.columns, row) if n == 0])


def fill_const(df: DataFrame, values) -> DataFrame:
    """One value for all columns of its type, or a value per column."""
    if isinstance(values, dict):
        return df.withColumns({c: F.coalesce(col(c), F.lit(v)) for c, v in values.items()})
    return df.na.fill(values)


def fit_impute(df: DataFrame, cols: list[str], how: str = "mean", limit: int | None = None) -> Params:
    """Fill value per column: ``mean``, ``median`` (exact) or ``mode`` (smallest tie)."""
    if not cols:
        return Params({})
    if how == "mean":
        row = df.agg(*[F.avg(col(c)) for c in cols]).first()
    elif how == "median":
        found = quantile_columns(df, cols, [0.5], limit)
        row = [v[0] if v is not None else None for v in df.agg(*[found[c] for c in cols]).first()]
    elif how == "mode":
        kinds = dict(df.dtypes)
        row = {}
        for kind in dict.fromkeys(kinds[c] for c in cols):  # each in its own type: no number, flag or date becomes another one
            group = [c for c in cols if kinds[c] == kind]
            row.update({r["column"]: r["top"] for r in modes(df.select(*[col(c) for c in group]), group).collect()})  # one row per column
        row = [row.get(c, UNKNOWN if kinds[c] == "string" else None) for c in cols]
    else:
        raise ValueError(f"unknown method {how}")
    return Params({c: {"fill": v} for c, v in zip(cols, row)})


def apply_impute(df: DataFrame, params: Params) -> DataFrame:
    fills = {c: s["fill"] for c, s in params.values.items() if c in df.columns and s["fill"] is not None}
    return df.withColumns({c: F.coalesce(col(c), F.lit(v)) for c, v in fills.items()}) if fills else df


def ffill(df: DataFrame, name: str, order: list[str], part: list[str] = (), rows_per_task: int | None = None) -> DataFrame:
    out = in_order(df, list(part), order, {"__fill": last_seen(col(name))}, rows_per_task)
    return out.withColumn(name, F.col("__fill")).drop("__fill")


def bfill(df: DataFrame, name: str, order: list[str], part: list[str] = (), rows_per_task: int | None = None) -> DataFrame:
    out = in_order(df, list(part), order, {"__fill": next_seen(col(name))}, rows_per_task)
    return out.withColumn(name, F.col("__fill")).drop("__fill")


def interpolate(df: DataFrame, name: str, order: list[str], part: list[str] = (), rows_per_task: int | None = None) -> DataFrame:
    """Linear by row position; leading nulls stay, trailing nulls take the last value."""
    part = list(part)
    numbered = in_order(df, part, order, {"__pos": row_number()}, rows_per_task)
    known = F.when(col(name).isNotNull(), F.struct(col(name).cast("double").alias("v"), F.col("__pos").alias("p")))
    around = in_order(numbered, part, order, {"__a": last_seen(known), "__b": next_seen(known)}, rows_per_task)
    a, b = F.col("__a"), F.col("__b")
    step = (b["v"] - a["v"]) / (b["p"] - a["p"])
    value = (F.when(col(name).isNotNull(), col(name).cast("double"))
             .when(a.isNotNull() & b.isNotNull(), a["v"] + step * (F.col("__pos") - a["p"]))
             .otherwise(a["v"]))
    return around.withColumn(name, value).drop("__pos", "__a", "__b")


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.drop(subset=cols)


def require_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a label, and a one-row report of how many were kept and dropped."""
    report = df.agg(F.count(col(label)).alias("n_kept"), F.count_if(col(label).isNull()).alias("n_dropped"))
    return df.where(col(label).isNotNull()), report


def ensure_numeric(df: DataFrame, cols: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Everything numeric: coerce, then fill with the median."""
    cols = cols or df.columns
    numeric = df.select(*[to_number(col(c)).alias(c) if c in cols else col(c) for c in df.columns])
    return apply_impute(numeric, fit_impute(numeric, cols, "median", limit))
