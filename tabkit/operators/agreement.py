"""Agreement between two labelings, from their contingency counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import bounded, col, cut_lineage
from .profile import error_by_group

# Purity bands of the verdict and the guard inside the balance logarithm.
PURITY_GOOD, PURITY_PARTIAL = 0.8, 0.6
LOG_GUARD = 1e-12


def contingency(df: DataFrame, a: str, b: str, noise: int | None = -1) -> DataFrame:
    """(a, b, n) without null labels; rows whose b is the noise label are left out."""
    rows = df.where(col(a).isNotNull() & col(b).isNotNull())
    if noise is not None:
        rows = rows.where(col(b).cast("string") != str(noise))
    return rows.groupBy(col(a).alias("a"), col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))


def _margins(df: DataFrame, a: str, b: str, noise: int | None) -> DataFrame:
    """Contingency counts and both margins, a row each: one pass over the rows, then grouping sets over the counts, which combine
    before they are shuffled, so that one class may hold any share of the cells.

    Noise cells stay, with an empty count ``n``, for the noise total.
    """
    cells = contingency(df, a, b, noise=None)
    is_noise = F.lit(False) if noise is None else F.col("b").cast("string") == str(noise)
    cells = cells.select("a", "b", F.when(~is_noise, F.col("n").cast("double")).alias("n"), F.when(is_noise, F.col("n")).alias("noise"))
    sets = cells.groupingSets([[F.col("a"), F.col("b")], [F.col("a")], [F.col("b")]], "a", "b").agg(
        F.grouping_id().alias("left_out"), F.sum("n").alias("total"), F.max("n").alias("most"), F.sum("noise").alias("noise"))
    of_cell, of_a, of_b = (F.col("left_out") == k for k in (0, 1, 2))
    return sets.select(F.when(of_cell, F.col("total")).alias("n"), F.when(of_cell, F.col("noise")).alias("noise"),
                       F.when(of_a, F.col("total")).alias("na"), F.when(of_b, F.col("total")).alias("nb"), F.when(of_b, F.col("most")).alias("top"))


def _pairs(n: str) -> Column:
    return F.sum(F.col(n) * (F.col(n) - 1) / 2)


def _ari() -> Column:
    n = F.sum("n")
    expected = F.try_divide(_pairs("na") * _pairs("nb"), n * (n - 1) / 2)
    top = (_pairs("na") + _pairs("nb")) / 2
    return F.coalesce(F.try_divide(_pairs("n") - expected, top - expected), F.lit(1.0))


def _information() -> dict[str, Column]:
    n = F.sum("n")
    nlogn = lambda c: F.sum(F.col(c) * F.ln(c))
    tiny = 1e-12  # entropies below it come from rounding
    flat = lambda e: F.when(F.abs(e) < tiny, F.lit(0.0)).otherwise(e)
    ha, hb = flat(F.ln(n) - nlogn("na") / n), flat(F.ln(n) - nlogn("nb") / n)
    mi = flat(F.ln(n) + (nlogn("n") - nlogn("na") - nlogn("nb")) / n)
    h, c = F.coalesce(F.try_divide(mi, ha), F.lit(1.0)), F.coalesce(F.try_divide(mi, hb), F.lit(1.0))
    return {"nmi": F.coalesce(F.try_divide(mi, (ha + hb) / 2), F.lit(1.0)), "homogeneity": h, "completeness": c,
            "v_measure": F.coalesce(F.try_divide(2 * h * c, h + c), F.lit(0.0))}


def _purity() -> dict[str, Column]:
    return {"purity": F.coalesce(F.avg(F.col("top") / F.col("nb")), F.lit(0.0)), "n_clusters": F.count("nb")}


def ari(df: DataFrame, a: str, b: str, noise: int | None = -1) -> DataFrame:
    """Adjusted Rand index; 1 when both labelings are trivial in the same way."""
    return _margins(df, a, b, noise).agg(_ari().alias("ari"))


def mutual_info(df: DataFrame, truth: str, cluster: str, noise: int | None = -1) -> DataFrame:
    """NMI (arithmetic mean), homogeneity, completeness, V-measure."""
    return _margins(df, truth, cluster, noise).agg(*[e.alias(n) for n, e in _information().items()])


def purity(df: DataFrame, truth: str, cluster: str, noise: int | None = -1) -> DataFrame:
    """Unweighted mean over clusters of the majority share."""
    return _margins(df, truth, cluster, noise).agg(*[e.alias(n) for n, e in _purity().items()])


def agreement(df: DataFrame, truth: str, cluster: str, noise: int | None = -1) -> DataFrame:
    """ARI, NMI, homogeneity, completeness, V-measure, purity, cluster and noise counts: one row, one pass."""
    exprs = {"ari": _ari(), **_information(), **_purity()}
    noisy = F.coalesce(F.sum("noise"), F.lit(0))
    return _margins(df, truth, cluster, noise).agg(
        (F.coalesce(F.sum("n"), F.lit(0.0)).cast("long") + noisy).alias("n"), noisy.alias("n_noise"),
        *[e.alias(n) for n, e in exprs.items()])


def majority_map(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """Majority class per cluster, smallest class on ties; noise is a cluster like any other here."""
    cells = contingency(df, truth, cluster, noise=None)
    return cells.groupBy(F.col("b").alias("cluster")).agg(F.min_by("a", F.struct(-F.col("n"), F.col("a"))).alias("majority"))


def majority_errors(df: DataFrame, truth: str, cluster: str, unit: str) -> DataFrame:
    """Error share per unit when each cluster predicts its majority class."""
    mapped = majority_map(df, truth, cluster).select(F.col("cluster").alias("__cluster"), "majority")
    flagged = df.join(bounded(mapped), df[cluster] == F.col("__cluster")).select(
        df[unit], (df[truth] != F.col("majority")).cast("int").alias("error"))
    return error_by_group(flagged, unit, "error")


def purity_verdict(metrics: DataFrame, value: str = "purity") -> DataFrame:
    """Band of the best purity in a metrics table."""
    best = metrics.agg(F.max(value).alias("best_purity"))
    return best.withColumn("verdict", F.when(F.col("best_purity") > PURITY_GOOD, "well labelled")
                           .when(F.col("best_purity") > PURITY_PARTIAL, "partial structure").otherwise("not well labelled"))


def cluster_balance(df: DataFrame, cluster: str) -> DataFrame:
    """Normalised entropy of the cluster sizes, noise left out; 0 without clusters."""
    sizes = df.where(col(cluster) != -1).groupBy(col(cluster)).agg(F.count(F.lit(1)).alias("n"))
    sizes = cut_lineage(sizes)
    sizes = sizes.withColumn("p", F.col("n") / sizes.agg(F.sum("n")).scalar())
    p = F.col("p")
    agg = sizes.agg((-F.sum(p * F.ln(p + LOG_GUARD))).alias("h"), F.count(F.lit(1)).alias("k"))
    return agg.select(F.coalesce(F.when(F.col("k") > 1, F.col("h") / F.ln(F.col("k").cast("double"))).otherwise(F.col("h")),
                                 F.lit(0.0)).alias("balance"))
