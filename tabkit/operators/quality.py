"""Internal clustering quality: silhouette, Davies-Bouldin, Calinski-Harabasz."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import bounded, col, cut_lineage, unit_position
from .agreement import cluster_balance
from .cluster import cluster_counts
from .neighbors import Piece, compare_blocks, square_distances, summed


def _labelled(df: DataFrame, cluster: str, cols: list[str] | None, vec: str | None, key: str | None = None) -> DataFrame:
    v = col(vec).cast("array<double>") if vec else F.array(*[col(c).cast("double") for c in cols])
    return df.where(col(cluster) != -1).select(*([col(key).alias("id")] if key else []), v.alias("vec"), col(cluster).alias("cluster"))


def silhouette(df: DataFrame, key: str, cluster: str, cols: list[str] | None = None, vec: str | None = None,
               metric: str = "euclidean", sample: int | None = None, seed: int = 0) -> DataFrame:
    """Mean silhouette without noise; null unless there are 2 to n - 1 clusters.

    ``euclidean`` is a mean over all pairs of rows, which are compared block by block: quadratic work by definition. ``sample`` measures that
    many rows against every row (the result says so); ``squared`` has a closed form and costs one pass.
    """
    rows = _labelled(df, cluster, cols, vec, key)
    n, k = rows.agg(F.count(F.lit(1)), F.count_distinct("cluster")).first()
    if not 1 < k < n:
        return df.sparkSession.createDataFrame([(None, n, False)], "silhouette double, n long, is_estimate boolean")
    if metric == "squared":
        vectors = rows.select(array_to_vector("vec").alias("features"), F.col("cluster").cast("double").alias("prediction"))
        s = ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(vectors)
        return df.sparkSession.createDataFrame([(float(s), n, False)], "silhouette double, n long, is_estimate boolean")
    picked = rows.orderBy(unit_position(["id"], seed), "id").limit(sample) if sample else rows
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def sums(x: Piece, y: Piece) -> pd.DataFrame:
        other, at = np.unique(y["cluster"].to_numpy(), return_inverse=True)
        total = np.sqrt(square_distances(x.vec, y.vec)) @ np.eye(len(other))[at]
        return pd.DataFrame({"id": np.repeat(x["id"].to_numpy(), len(other)), "other": np.tile(other, len(x.vec)), "total": total.ravel()})
    parts = compare_blocks(picked.select("id", "vec"), rows, np.zeros((0, 0)), 0.0, sums, f"id {kinds['id']}, other {kinds['cluster']}, total double",
                           merge=summed(["id", "other"]))
    totals = parts.groupBy("id", "other").agg(F.sum("total").alias("total"))
    counts = rows.groupBy(F.col("cluster").alias("__c")).agg(F.count(F.lit(1)).alias("n"))
    own = picked.select(F.col("id").alias("__id"), "cluster")
    each = totals.join(counts, F.col("other") == F.col("__c")).join(own, F.col("id") == F.col("__id"))
    same = F.col("other") == F.col("cluster")
    inner, outer = F.max(F.when(same & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))), F.min(F.when(~same, F.col("total") / F.col("n")))
    each = each.groupBy("id").agg(inner.alias("a"), outer.alias("b"))
    top = F.greatest("a", "b")
    value = F.coalesce(F.when(F.col("a").isNotNull() & (top > 0), (F.col("b") - F.col("a")) / top), F.lit(0.0))
    return each.agg(F.avg(value).alias("silhouette")).withColumns({"n": F.lit(n).cast("long"), "is_estimate": F.lit(bool(sample and sample < n))})


def _centroids(rows: DataFrame) -> DataFrame:
    """(cluster, n, centroid): one row per cluster."""
    return rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"),
                                       vector_to_array(Summarizer.mean(array_to_vector("vec"))).alias("centroid"))


def _square(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def davies_bouldin(df: DataFrame, cluster: str, cols: list[str] | None = None, vec: str | None = None) -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / centroid distance; null with one cluster."""
    rows = _labelled(df, cluster, cols, vec)
    cent = _centroids(rows)
    spread = (rows.join(bounded(cent.select(F.col("cluster").alias("c"), "centroid")), F.col("cluster") == F.col("c"))
              .groupBy("c").agg(F.avg(F.sqrt(_square("vec", "centroid"))).alias("s"), F.first("centroid").alias("v")))
    spread = cut_lineage(spread.select(F.col("c").alias("id"), "s", F.col("v").alias("vec")))
    if spread.count() < 2:
        return df.sparkSession.createDataFrame([(None,)], "davies_bouldin double")

    def worst(x: Piece, y: Piece) -> pd.DataFrame:
        d = np.sqrt(square_distances(x.vec, y.vec))
        apart = (d > 0) & (x["id"].to_numpy()[:, None] != y["id"].to_numpy()[None, :])
        r = np.where(apart, (x["s"].to_numpy()[:, None] + y["s"].to_numpy()[None, :]) / np.where(apart, d, 1.0), 0.0)
        return pd.DataFrame({"id": x["id"], "r": r.max(axis=1)})
    kind = spread.schema["id"].dataType.simpleString()
    pairs = compare_blocks(spread, spread, np.zeros((0, 0)), 0.0, worst, f"id {kind}, r double",
                           merge=lambda parts: parts.groupby("id", as_index=False, sort=False).max())
    return pairs.groupBy("id").agg(F.max("r").alias("r")).agg(F.avg("r").alias("davies_bouldin"))


def calinski_harabasz(df: DataFrame, cluster: str, cols: list[str] | None = None, vec: str | None = None) -> DataFrame:
    """(between / (k - 1)) / (within / (n - k))."""
    rows = _labelled(df, cluster, cols, vec).withColumn("v", array_to_vector("vec"))
    # a row per cluster and no bound on their number: they stay in a table, the driver sees the overall mean alone
    parts = cut_lineage(rows.groupBy("cluster").agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s"))
                        .select(vector_to_array("s.mean").alias("mean"), vector_to_array("s.variance").alias("var"), F.col("s.count").alias("size")))
    whole = parts.agg(F.count(F.lit(1)).alias("k"), F.sum("size").alias("n"),
                      Summarizer.mean(array_to_vector("mean"), F.col("size").cast("double")).alias("mean")).first()
    k, n = whole["k"], whole["n"] or 0
    if not 1 < k < n:
        return df.sparkSession.createDataFrame([(None,)], "calinski_harabasz double")
    overall = F.lit([float(x) for x in whole["mean"]])
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)
    apart = total(F.zip_with("mean", overall, lambda x, y: (x - y) * (x - y)))
    sums = parts.agg(F.sum(F.col("size") * apart).alias("between"), F.sum((F.col("size") - 1) * total(F.col("var"))).alias("within"))
    return sums.select(F.when(F.col("within") > 0, (F.col("between") / (k - 1)) / (F.col("within") / (n - k))).otherwise(1.0).alias("calinski_harabasz"))


def cluster_metrics(df: DataFrame, algorithm: str, key: str, cluster: str, cols: list[str] | None = None,
                    vec: str | None = None, metric: str = "euclidean", sample: int | None = None) -> DataFrame:
    """One row: silhouette, Davies-Bouldin, Calinski-Harabasz, balance, clusters and noise."""
    s = silhouette(df, key, cluster, cols, vec, metric, sample).first()["silhouette"]
    counts = cluster_counts(df, cluster)
    return counts.select(F.lit(algorithm).alias("algorithm"), "n", "n_clusters", "n_noise").withColumns({
        "silhouette": F.lit(s).cast("double"),
        "davies_bouldin": F.when(F.col("n_clusters") > 1, davies_bouldin(df, cluster, cols, vec).scalar()),
        "calinski_harabasz": F.when(F.col("n_clusters") > 1, calinski_harabasz(df, cluster, cols, vec).scalar()),
        "balance": cluster_balance(df, cluster).scalar()})
