"""Descriptive tables: describe, frequencies, histograms, pivots, balance, prevalence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quantiles import grouped_quantiles, quantile_columns
from ..functions.runtime import bounded, col, cut_lineage, rows_from

PIVOT_CAP = 1_000


def missing_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null count and share per column, most first, then by name."""
    cols = cols or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    rows = agg.select(rows_from([
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing"),
                 F.try_divide(100.0 * F.col(f"m{i}"), F.col("n")).alias("pct_missing")) for i, c in enumerate(cols)]))
    return rows.orderBy(F.desc("n_missing"), F.asc("column"))


def describe(df: DataFrame, cols: list[str], limit: int | None = None) -> DataFrame:
    """count, mean, std (n - 1), min, exact quartiles, max; one row per column."""
    quart = quantile_columns(df, cols, [0.25, 0.5, 0.75], limit)
    agg = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.count(col(c)).alias(f"n{i}"), F.avg(col(c)).alias(f"a{i}"), F.stddev_samp(col(c)).alias(f"s{i}"),
        F.min(col(c)).cast("double").alias(f"l{i}"), F.max(col(c)).cast("double").alias(f"h{i}"),
        quart[c].alias(f"q{i}"))])
    return agg.select(rows_from([
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"a{i}").alias("mean"),
                 F.col(f"s{i}").alias("std"), F.col(f"l{i}").alias("min"), F.col(f"q{i}")[0].alias("q25"),
                 F.col(f"q{i}")[1].alias("q50"), F.col(f"q{i}")[2].alias("q75"), F.col(f"h{i}").alias("max"))
        for i, c in enumerate(cols)]))


def value_table(df: DataFrame, cols: list[str], by: list[str] = ()) -> DataFrame:
    """Counts of every distinct non-null value of several columns of one type, in one pass."""
    keys = [col(b) for b in by]
    long = df.select(*keys, *[col(c) for c in cols]).unpivot(list(keys), [col(c) for c in cols], "column", "value")
    return (long.where(F.col("value").isNotNull()).groupBy(*keys, "column", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def modes(df: DataFrame, cols: list[str], by: list[str] = ()) -> DataFrame:
    """Most frequent value per column (smallest wins ties), its count, and the distinct count."""
    return value_table(df, cols, by).groupBy(*[col(b) for b in by], "column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"), F.count(F.lit(1)).alias("n_unique"))


def describe_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, unique, top, freq of text columns."""
    counts = df.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(cols)]).select(rows_from([
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count")) for i, c in enumerate(cols)]))
    return counts.join(modes(df, cols), "column", "left")


def describe_all(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Numeric columns and all others (text, flags, dates, times; as text) in one table; statistics that do not apply are null."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    plain = (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    text = [f.name for f in df.schema if isinstance(f.dataType, plain)]
    parts = []
    if numeric:
        parts.append(describe(df, numeric, limit))
    if text:
        parts.append(describe_text(df.select(*[col(c).cast("string").alias(c) for c in text]), text))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def measures(df: DataFrame, cols: list[str], limit: int | None = None) -> DataFrame:
    """mean, median, mode (smallest tie), std and variance (n - 1), min, max."""
    med = quantile_columns(df, cols, [0.5], limit)
    agg = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.avg(col(c)).alias(f"a{i}"), med[c].alias(f"m{i}"), F.stddev_samp(col(c)).alias(f"s{i}"),
        F.var_samp(col(c)).alias(f"v{i}"), F.min(col(c)).cast("double").alias(f"l{i}"),
        F.max(col(c)).cast("double").alias(f"h{i}"))])
    rows = agg.select(rows_from([
        F.struct(F.lit(c).alias("column"), F.col(f"a{i}").alias("mean"), F.col(f"m{i}")[0].alias("median"),
                 F.col(f"s{i}").alias("std"), F.col(f"v{i}").alias("variance"), F.col(f"l{i}").alias("min"),
                 F.col(f"h{i}").alias("max")) for i, c in enumerate(cols)]))
    as_double = df.select(*[col(c).cast("double").alias(c) for c in cols])
    top = modes(as_double, cols).select("column", F.col("top").alias("mode"))
    return rows.join(top, "column", "left")


def quantile_table(df: DataFrame, cols: list[str], probs: list[float], limit: int | None = None) -> DataFrame:
    """One row per (column, probability)."""
    found = quantile_columns(df, cols, probs, limit)
    agg = df.agg(*[found[c].alias(f"q{i}") for i, c in enumerate(cols)])
    return agg.select(rows_from([
        F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("prob"), F.col(f"q{i}")[j].alias("value"))
        for i, c in enumerate(cols) for j, p in enumerate(probs)]))


def skew(c: Column) -> Column:
    """Bias-corrected G1; null under three values."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def skewness(df: DataFrame, cols: list[str], symmetric: float = 0.5) -> DataFrame:
    agg = df.agg(*[skew(col(c)).alias(f"g{i}") for i, c in enumerate(cols)])
    return agg.select(rows_from([
        F.struct(F.lit(c).alias("column"), F.col(f"g{i}").alias("skewness"),
                 (F.abs(F.col(f"g{i}")) < symmetric).alias("is_symmetric")) for i, c in enumerate(cols)]))


def nunique(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column.

    One shuffle over (column, value): rows expand per column but are reduced before they move.
    """
    cols = cols or df.columns
    if approx:
        agg = df.agg(*[F.approx_count_distinct(col(c)).alias(f"d{i}") for i, c in enumerate(cols)])
    else:
        agg = df.agg(*[F.count_distinct(col(c)).alias(f"d{i}") for i, c in enumerate(cols)])
    return agg.select(rows_from([
        F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("n_unique")) for i, c in enumerate(cols)]))


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """Frequency and % of each value; null is a value of its own."""
    counts = df.groupBy(col(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return _of_all(counts, F.sum("n").alias("total")).select("value", "n", (100.0 * F.col("n") / F.col("all.total")).alias("pct"))


def _of_all(counts: DataFrame, *totals: Column) -> DataFrame:
    """The counts, computed once, each with the totals over all of them in column ``all``."""
    kept = cut_lineage(counts)
    return kept.withColumn("all", kept.agg(F.struct(*totals)).scalar())


def group_mean(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Mean per group; rows with a null key are left out."""
    return (df.dropna(subset=keys).groupBy(*[col(k) for k in keys])
            .agg(*[F.avg(col(c)).alias(f"mean_{c}") for c in cols]))


def error_by_group(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Rows, flagged rows and flagged % per group, worst first."""
    out = df.groupBy(col(key)).agg(F.count(F.lit(1)).alias("n"), F.sum(col(flag).cast("long")).alias("errors"))
    return out.withColumn("error_pct", 100.0 * F.col("errors") / F.col("n")).orderBy(F.desc("error_pct"), F.asc(key))


def levels(df: DataFrame, name: str, cap: int = PIVOT_CAP) -> list:
    """Sorted distinct non-null values, at most ``cap`` of them: they become columns."""
    rows = df.select(col(name)).where(col(name).isNotNull()).distinct().limit(cap + 1).collect()
    if len(rows) > cap:
        raise ValueError(f"{name} has more than {cap} distinct values")
    return sorted(r[0] for r in rows)


def pivot(df: DataFrame, index: list[str], columns: str, value: str, agg: str = "avg") -> DataFrame:
    """Group means or sums with one column per level; null keys are left out."""
    values = levels(df, columns)
    return (df.dropna(subset=[*index, columns]).groupBy(*[col(i) for i in index])
            .pivot(columns, values).agg(getattr(F, agg)(col(value))))


def crosstab(df: DataFrame, a: str, b: str, normalize: bool = False) -> DataFrame:
    """Counts of b per a, zero-filled; with ``normalize`` each row sums to one."""
    values = levels(df, b)
    out = (df.dropna(subset=[a, b]).groupBy(col(a)).pivot(b, values).agg(F.count(F.lit(1)))
           .na.fill(0, [str(v) for v in values]))
    if normalize:
        total = sum((col(str(v)) for v in values), F.lit(0))
        out = out.select(col(a), *[(col(str(v)) / total).alias(str(v)) for v in values])
    return out


def melt(df: DataFrame, ids: list[str], values: list[str], variable: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot([col(i) for i in ids], [col(v) for v in values], variable, value)


def histogram(df: DataFrame, name: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """Equal-width bin counts between minimum and maximum, last bin closed; empty bins are
    listed. With ``by`` the counts are split by class on common edges."""
    low, high = df.agg(F.min(col(name)).cast("double"), F.max(col(name)).cast("double")).first()
    if low is None:
        raise ValueError(f"{name} has no values")
    if low == high:  # one value: unit-wide range around it
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    at = F.least(F.floor((col(name) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    rows = df.where(col(name).isNotNull())
    keys = [col(by)] if by else []
    counts = rows.groupBy(*keys, at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if by:
        classes = rows.select(col(by)).distinct()
        grid = classes.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        on = grid[by].eqNullSafe(counts[by]) & (grid["bin"] == counts["bin"])
    else:
        on = grid["bin"] == counts["bin"]
    edge = lambda k: F.lit(low) + k * F.lit(width)
    return grid.join(counts, on, "left").select(
        *([grid[by]] if by else []), grid["bin"], edge(grid["bin"]).alias("left_edge"),
        edge(grid["bin"] + 1).alias("right_edge"), F.coalesce(counts["n"], F.lit(0)).alias("n"))


def boxplot_stats(df: DataFrame, cols: list[str], by: str | None = None, k: float = 1.5, limit: int | None = None) -> DataFrame:
    """Quartiles, fences and outlier share per column, optionally per class."""
    rows = df.select(*([col(by)] if by else []), *[col(c) for c in cols])
    if by:
        quart = grouped_quantiles(rows, [by], cols, [0.25, 0.5, 0.75], limit)
        fences = quart.select(col(by).alias("__by"), *[
            F.struct(col(c)[0].alias("q1"), col(c)[1].alias("q2"), col(c)[2].alias("q3")).alias(f"f{i}")
            for i, c in enumerate(cols)])
        joined = rows.join(bounded(fences), rows[by].eqNullSafe(F.col("__by")))  # one row per class
        keys = [F.col("__by")]
    else:
        found = quantile_columns(rows, cols, [0.25, 0.5, 0.75], limit)
        one = rows.agg(*[found[c].alias(f"a{i}") for i, c in enumerate(cols)]).first()
        joined = rows.withColumns({f"f{i}": F.struct(*[F.lit(v).alias(n) for n, v in zip(("q1", "q2", "q3"), one[i] or [None] * 3)])
                                   for i, _ in enumerate(cols)})
        keys = []
    aggs = []
    for i, c in enumerate(cols):
        f = F.col(f"f{i}")
        iqr = f["q3"] - f["q1"]
        outside = (col(c) < f["q1"] - k * iqr) | (col(c) > f["q3"] + k * iqr)
        # plain doubles, not the struct: they keep the aggregate hash based
        aggs += [F.count(col(c)).alias(f"n{i}"), *[F.first(f[s]).alias(f"{s}_{i}") for s in ("q1", "q2", "q3")],
                 F.count_if(outside).alias(f"o{i}")]
    agg = joined.groupBy(*keys).agg(*aggs)
    return agg.select(*([F.col("__by").alias(by)] if by else []), rows_from([
        F.struct(F.lit(c).alias("column"), F.col(f"q1_{i}").alias("q1"), F.col(f"q2_{i}").alias("median"),
                 F.col(f"q3_{i}").alias("q3"),
                 (F.col(f"q1_{i}") - k * (F.col(f"q3_{i}") - F.col(f"q1_{i}"))).alias("lower"),
                 (F.col(f"q3_{i}") + k * (F.col(f"q3_{i}") - F.col(f"q1_{i}"))).alias("upper"),
                 F.col(f"o{i}").alias("n_outliers"),
                 F.try_divide(100.0 * F.col(f"o{i}"), F.col(f"n{i}")).alias("pct_outliers"))
        for i, c in enumerate(cols)]))


def class_balance(df: DataFrame, label: str, threshold: float = 1.5) -> DataFrame:
    """Count and % per class, the largest-to-smallest ratio and whether it exceeds ``threshold``."""
    counts = df.where(col(label).isNotNull()).groupBy(col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    counts = _of_all(counts, F.sum("n").alias("total"), (F.max("n") / F.min("n")).alias("ratio"))
    ratio = F.col("all.ratio")
    return counts.select("label", "n", (100.0 * F.col("n") / F.col("all.total")).alias("pct"),
                         ratio.alias("max_min_ratio"), (ratio > threshold).alias("imbalanced"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (classes * n_class)."""
    counts = df.where(col(label).isNotNull()).groupBy(col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    counts = _of_all(counts, (F.sum("n") / F.count(F.lit(1))).alias("mean"))
    return counts.select("label", "n", (F.col("all.mean") / F.col("n")).alias("weight"))


def prevalence(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    return (df.dropna(subset=keys).groupBy(*[col(k) for k in keys])
            .agg(F.avg(col(label)).alias("prevalence"), F.count(col(label)).alias("n")))


def cluster_profile(df: DataFrame, cluster: str, cols: list[str]) -> DataFrame:
    """Feature means per cluster, noise (-1) left out."""
    return (df.where(col(cluster) != -1).groupBy(col(cluster))
            .agg(F.count(F.lit(1)).alias("n"), *[F.avg(col(c)).alias(f"mean_{c}") for c in cols]))


def run_summary(df: DataFrame, label: str) -> DataFrame:
    """Rows, columns, label prevalence, missing cells and exact duplicate rows: one row."""
    from .dedup import count_duplicates
    missing = sum((col(c).isNull().cast("long") for c in df.columns), F.lit(0))
    stats = df.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(col(label)).alias("prevalence"),
                   F.sum(missing).alias("n_missing"))
    return (stats.withColumn("n_cols", F.lit(len(df.columns)).cast("long"))
            .withColumn("n_duplicates", count_duplicates(df).scalar()))
