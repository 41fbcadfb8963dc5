"""Correlation tables in long form (a, b, r), upper triangle with the diagonal left out unless asked."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ordered import in_order, running_sum
from ..functions.runtime import BROADCAST_ROWS, col, cut_lineage, rows_from

# Levels of a strong and a moderate correlation.
STRONG = 0.7
MODERATE = 0.5

PAIRS_AT_ONCE = 4


def average_ranks(df: DataFrame, name: str, rows_per_task: int | None = None) -> DataFrame:
    """One row per distinct value: ``value``, ``n`` and its average rank (ties share it). A table
    known to be small carries a broadcast hint for the joins it is used in."""
    counts = cut_lineage(df.where(col(name).isNotNull()).groupBy(col(name).cast("double").alias("value"))
                         .agg(F.count(F.lit(1)).alias("n")))
    summed = in_order(counts, [], ["value"], {"upto": running_sum(F.col("n"))}, rows_per_task)
    ranks = summed.select("value", "n", (F.col("upto") - (F.col("n") - 1) / 2.0).alias("rank"))
    return F.broadcast(ranks) if counts.count() <= BROADCAST_ROWS else ranks


def with_ranks(df: DataFrame, cols: list[str], rows_per_task: int | None = None) -> DataFrame:
    """Replace each column by its average rank. The rank table has one row per distinct value, so
    the join costs no shuffle while that is small; repeated values are counted before ranking."""
    out = df
    for i, c in enumerate(cols):
        ranks = average_ranks(df, c, rows_per_task).select(F.col("value").alias(f"__v{i}"), F.col("rank").alias(f"__r{i}"))
        out = out.join(ranks, out[c].cast("double") == ranks[f"__v{i}"], "left").drop(f"__v{i}")
    return out.select(*[F.col(f"__r{cols.index(c)}").alias(c) if c in cols else col(c) for c in df.columns])


def _corr(x, y):
    """Pearson r over the rows where both are present; null for a constant column (``corr`` would
    divide by zero)."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def _pearson(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    agg = df.agg(*[_corr(col(a), col(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return agg.select(rows_from([F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
                                 for i, (a, b) in enumerate(pairs)]))


def corr_matrix(df: DataFrame, cols: list[str], method: str = "pearson", nulls: str = "pairwise",
                full: bool = False, pairs: list[tuple[str, str]] | None = None,
                rows_per_task: int | None = None) -> DataFrame:
    """(a, b, r) for every pair; a constant column gives null.

    ``nulls="pairwise"`` uses the rows where both are present, ``"complete"`` the rows without
    any null. ``full`` adds the mirrored pairs and the diagonal.
    """
    pairs = pairs or list(combinations(cols, 2))
    rows = df.select(*[col(c).cast("double").alias(c) for c in cols])
    if nulls == "complete":
        rows = rows.na.drop(subset=cols)
    if method == "pearson":
        out = _pearson(rows, pairs)
    else:
        out = _spearman(rows, cols, pairs, nulls, rows_per_task)
    if not full:
        return out
    mirrored = out.select(F.col("b").alias("a"), F.col("a").alias("b"), "r")
    spread = rows.agg(*[F.stddev_pop(col(c)).alias(f"s{i}") for i, c in enumerate(cols)]).select(rows_from([
        F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.when(F.col(f"s{i}") > 0, F.lit(1.0)).alias("r"))
        for i, c in enumerate(cols)]))
    return out.unionByName(mirrored).unionByName(spread)


def _spearman(rows, cols, pairs, nulls, rows_per_task) -> DataFrame:
    holes = rows.agg(*[F.count_if(col(c).isNull()) for c in cols]).first() if nulls == "pairwise" else [0] * len(cols)
    has_null = {c for c, n in zip(cols, holes) if n}
    plain = [p for p in pairs if not has_null & set(p)]
    parts = []
    if plain:
        used = [c for c in cols if any(c in p for p in plain)]
        parts.append(_pearson(with_ranks(rows.select(*[col(c) for c in used]), used, rows_per_task), plain))

    def ranked_pair(pair):  # ranks depend on which rows the other column keeps
        both = rows.select(*[col(c) for c in pair]).na.drop()
        return _pearson(with_ranks(both, list(pair), rows_per_task), [pair])
    with ThreadPoolExecutor(PAIRS_AT_ONCE) as pool:
        parts += list(pool.map(ranked_pair, [p for p in pairs if has_null & set(p)]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def corr_pairs(df: DataFrame, cols: list[str], t: float = STRONG, method: str = "pearson") -> DataFrame:
    """Pairs with abs(r) >= t, tagged by level, strongest first."""
    out = corr_matrix(df, cols, method).where(F.abs("r") >= t)
    level = F.when(F.abs("r") >= STRONG, "strong").when(F.abs("r") >= MODERATE, "moderate").otherwise("weak")
    return out.withColumn("level", level).orderBy(F.desc(F.abs("r")), "a", "b")


def corr_named(df: DataFrame, pairs: list[tuple[str, str]], rows_per_task: int | None = None) -> DataFrame:
    """Both coefficients for given pairs; pairs with an absent or non-numeric column are skipped."""
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    kept = [p for p in pairs if set(p) <= numeric]
    if not kept:
        return df.sparkSession.createDataFrame([], "a string, b string, pearson double, spearman double")
    cols = sorted({c for p in kept for c in p})
    first = corr_matrix(df, cols, "pearson", pairs=kept).withColumnRenamed("r", "pearson")
    second = corr_matrix(df, cols, "spearman", pairs=kept, rows_per_task=rows_per_task).withColumnRenamed("r", "spearman")
    return first.join(second, ["a", "b"])


def corr_with(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """Correlation of each column with the target, largest absolute value first."""
    out = corr_matrix(df, [target, *cols], pairs=[(c, target) for c in cols])
    return out.select(F.col("a").alias("column"), "r").orderBy(F.desc_nulls_last(F.abs("r")), "column")


def corr_top(df: DataFrame, cols: list[str], k: int = 5) -> DataFrame:
    """The k largest entries of the matrix other than exact 1 and 0."""
    out = corr_matrix(df, cols).where((F.abs("r") != 1.0) & (F.col("r") != 0.0))
    return out.orderBy(F.desc(F.abs("r")), "a", "b").limit(k)


def trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x and the correlation."""
    cx, cy = col(x).cast("double"), col(y).cast("double")
    return df.agg(F.regr_slope(cy, cx).alias("slope"), F.regr_intercept(cy, cx).alias("intercept"),
                  _corr(cx, cy).alias("r"), F.regr_count(cy, cx).alias("n"))
