"""Outlier bounds, reports, filters and capping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import quantile_columns, quantiles
from ..functions.runtime import any_of, col, rows_from
from ..functions.scalars import clip
from .params import Params

# Fence width, z-score limit and winsor quantiles.
IQR_FACTOR = 1.5
Z_LIMIT = 3.0
WINSOR = (0.01, 0.99)


def iqr_bounds(df: DataFrame, cols: list[str], k: float = IQR_FACTOR, limit: int | None = None) -> Params:
    """q1, q3, iqr, lower and upper per column; columns without values are left out."""
    found = quantiles(df, cols, [0.25, 0.75], limit)
    out = {}
    for c, v in found.items():
        if v is None or v[0] is None:
            continue
        q1, q3 = v
        out[c] = {"q1": q1, "q3": q3, "iqr": q3 - q1, "lower": q1 - k * (q3 - q1), "upper": q3 + k * (q3 - q1)}
    return Params(out)


def iqr_report(df: DataFrame, cols: list[str], k: float = IQR_FACTOR, bounds: Params | None = None,
               limit: int | None = None) -> DataFrame:
    """Quartiles, fences and how many non-null values lie outside, per column."""
    bounds = bounds or iqr_bounds(df, cols, k, limit)
    kept = [c for c in cols if c in bounds.values]
    if not kept:
        return df.sparkSession.createDataFrame([], "column string, q1 double, q3 double, iqr double, lower double, upper double, n_outliers long, pct_outliers double")
    aggs = []
    for i, c in enumerate(kept):
        b = bounds.values[c]
        aggs += [F.count(col(c)).alias(f"n{i}"), F.count_if((col(c) < b["lower"]) | (col(c) > b["upper"])).alias(f"o{i}")]
    return df.agg(*aggs).select(rows_from([
        F.struct(F.lit(c).alias("column"), *[F.lit(float(bounds.values[c][s])).alias(s) for s in ("q1", "q3", "iqr", "lower", "upper")],
                 F.col(f"o{i}").alias("n_outliers"),
                 F.try_divide(100.0 * F.col(f"o{i}"), F.col(f"n{i}")).alias("pct_outliers"))
        for i, c in enumerate(kept)]))


def iqr_filter(df: DataFrame, cols: list[str], k: float = IQR_FACTOR, limit: int | None = None) -> DataFrame:
    """Keep rows inside the fences (null stays), one column after the other: later bounds are
    computed on what the earlier columns left."""
    for c in cols:
        b = iqr_bounds(df, [c], k, limit).values.get(c)
        if b:
            df = df.where(col(c).isNull() | col(c).between(b["lower"], b["upper"]))
    return df


def outlier_impact(df: DataFrame, cols: list[str], k: float = IQR_FACTOR, limit: int | None = None) -> DataFrame:
    """Statistics with and without the values outside the fences, absolute and % change."""
    bounds = iqr_bounds(df, cols, k, limit).values
    kept = [c for c in cols if c in bounds]
    inliers = df.select(*[col(c).cast("double").alias(f"b{i}") for i, c in enumerate(kept)], *[
        F.when(col(c).between(bounds[c]["lower"], bounds[c]["upper"]), col(c).cast("double")).alias(f"a{i}")
        for i, c in enumerate(kept)])
    names = [f"{s}{i}" for i in range(len(kept)) for s in "ba"]
    med = quantile_columns(inliers, names, [0.5], limit)
    aggs = []
    for n in names:
        aggs += [F.avg(n).alias(f"{n}_mean"), med[n].alias(f"{n}_q"),
                 F.stddev_samp(n).alias(f"{n}_std"), F.var_samp(n).alias(f"{n}_variance"),
                 F.min(n).alias(f"{n}_min"), F.max(n).alias(f"{n}_max")]
    agg = inliers.agg(*aggs).withColumns({f"{n}_median": F.col(f"{n}_q")[0] for n in names})
    rows = []
    for i, c in enumerate(kept):
        for stat in ("mean", "median", "std", "variance", "min", "max"):
            before, after = F.col(f"b{i}_{stat}"), F.col(f"a{i}_{stat}")
            rows.append(F.struct(F.lit(c).alias("column"), F.lit(stat).alias("stat"), before.alias("before"),
                                 after.alias("after"), (after - before).alias("change"),
                                 F.try_divide(100.0 * (after - before), F.abs(before)).alias("pct_change")))
    return agg.select(rows_from(rows))


def zscore_outliers(df: DataFrame, cols: list[str], t: float = Z_LIMIT) -> DataFrame:
    """Rows with any abs(z) > t; std with n."""
    row = df.agg(*[e for c in cols for e in (F.avg(col(c)), F.stddev_pop(col(c)))]).first()
    tests = [F.abs((col(c) - F.lit(row[2 * i])) / F.lit(row[2 * i + 1])) > t
             for i, c in enumerate(cols) if row[2 * i + 1]]
    return df.where(any_of([F.coalesce(x, F.lit(False)) for x in tests]))


def winsorize(df: DataFrame, cols: list[str], low: float = WINSOR[0], high: float = WINSOR[1],
              limit: int | None = None) -> DataFrame:
    found = quantiles(df, cols, [low, high], limit)
    return df.withColumns({c: clip(col(c), F.lit(v[0]), F.lit(v[1])) for c, v in found.items() if v and v[0] is not None})


def fit_iqr_cap(df: DataFrame, cols: list[str], k: float = IQR_FACTOR, skip_flat: bool = False,
                limit: int | None = None) -> Params:
    """Fences learned from the training rows; ``skip_flat`` leaves columns with iqr 0 alone."""
    found = iqr_bounds(df, cols, k, limit).values
    return Params({c: b for c, b in found.items() if not (skip_flat and b["iqr"] == 0)})


def apply_iqr_cap(df: DataFrame, params: Params) -> DataFrame:
    caps = {c: clip(col(c).cast("double"), F.lit(b["lower"]), F.lit(b["upper"]))
            for c, b in params.values.items() if c in df.columns}
    return df.withColumns(caps) if caps else df
