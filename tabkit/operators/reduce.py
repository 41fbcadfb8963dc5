"""Principal components of centred columns, applied as a plain projection."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce as fold

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import col
from .profile import describe


WIDE = 24  # beyond this many columns Spark ML builds the covariance matrix


@dataclass(frozen=True)
class Components:
    cols: list[str]
    means: list[float]
    loadings: list[list[float]]  # one list per component
    ratios: list[float]

    def variance(self, spark) -> DataFrame:
        rows = [(i + 1, float(r)) for i, r in enumerate(self.ratios)]
        return spark.createDataFrame(rows, "component int, explained_ratio double")

    def transform(self, df: DataFrame) -> DataFrame:
        """Scores PC1..PCk next to the other columns."""
        scores = []
        for i, w in enumerate(self.loadings):
            terms = [(col(c) - F.lit(m)) * F.lit(x) for c, m, x in zip(self.cols, self.means, w)]
            scores.append(fold(lambda a, b: a + b, terms).alias(f"PC{i + 1}"))
        return df.select("*", *scores)


def fit_pca(df: DataFrame, cols: list[str], k: int) -> Components:
    """Sign rule: the loading of largest absolute value is positive."""
    rows = df.select(*[col(c).cast("double").alias(c) for c in cols]).na.drop()
    d = len(cols)
    if d <= WIDE:
        means, axes, ratios = _from_covariances(rows, cols)
    else:
        means = list(rows.agg(*[F.avg(col(c)) for c in cols]).first())
        centred = rows.select(*[(col(c) - F.lit(m)).alias(f"x{i}") for i, (c, m) in enumerate(zip(cols, means))])
        model = PCA(k=k, inputCol="v", outputCol="s").fit(VectorAssembler(inputCols=centred.columns, outputCol="v").transform(centred).select("v"))
        axes = [[float(model.pc[i, j]) for i in range(d)] for j in range(k)]
        ratios = [float(x) for x in model.explainedVariance.toArray()]
    loadings = [[(-1.0 if max(w, key=abs) < 0 else 1.0) * x for x in w] for w in axes[:k]]
    return Components(list(cols), means, loadings, ratios[:k])


def _from_covariances(rows: DataFrame, cols: list[str]) -> tuple[list[float], list[list[float]], list[float]]:
    """Means, axes and variance shares from one aggregate; the d x d matrix is solved on the driver."""
    d = len(cols)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    row = rows.agg(*[F.avg(col(c)) for c in cols], *[F.covar_samp(col(cols[i]), col(cols[j])) for i, j in pairs]).first()
    cov = np.zeros((d, d))
    for (i, j), v in zip(pairs, row[d:]):
        cov[i, j] = cov[j, i] = v
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1]
    return list(row[:d]), [vectors[:, j].tolist() for j in order], [float(values[j] / values.sum()) for j in order]


def pca(df: DataFrame, cols: list[str], k: int = 2) -> DataFrame:
    return fit_pca(df, cols, k).transform(df)


def pca_variance(df: DataFrame, cols: list[str], k: int) -> DataFrame:
    return fit_pca(df, cols, k).variance(df.sparkSession)


def project(df: DataFrame, key: list[str], cols: list[str], keep: list[str], k: int = 2) -> DataFrame:
    """Projection table: key, kept labels and scores."""
    return pca(df, cols, k).select(*[col(c) for c in [*key, *keep]], *[f"PC{i + 1}" for i in range(k)])


def projection_summary(projection: DataFrame, k: int = 2) -> DataFrame:
    return describe(projection, [f"PC{i + 1}" for i in range(k)])


def extremes(projection: DataFrame, key: list[str], n: int = 10, k: int = 2) -> DataFrame:
    """Rows farthest from the centre of the projection."""
    norm = F.sqrt(fold(lambda a, b: a + b, [F.col(f"PC{i + 1}") * F.col(f"PC{i + 1}") for i in range(k)]))
    return projection.withColumn("distance", norm).orderBy(F.desc("distance"), *key).limit(n)
