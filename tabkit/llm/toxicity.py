"""Toxicity: a linear classifier over character n-grams, features scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.runtime import UNIT_RANGE, col, q, unit_position
from .common import staged, with_arrow

SIZES = (3, 4, 5)  # characters of an n-gram
BUCKET_BITS = 20
BLOCK_BITS = 14  # buckets of one block when counts are summed
FEATURES = 1 << 14  # n-grams the linear model sees: those that tell the classes apart best
SAMPLE_PER_CLASS = 8_192  # labelled rows to fit on, in expectation
SAMPLE_PARTS = 16
SMOOTHING = 1.0
PENALTY = 1e-4
SLICE = 1 << 20  # characters hashed at a time
ADDED = T.StructType([T.StructField("score", T.DoubleType())])


@dataclass(frozen=True)
class Model:
    """Bucket and weight (coefficient times log-count ratio) of each n-gram feature, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float


def buckets_of(text: str | None) -> Iterator[np.ndarray]:
    """Hash buckets of all n-grams of a text: lower case, white space as one blank, a blank at both ends."""
    flat = " " + " ".join((text or "").lower().split()) + " "
    for at in range(0, len(flat), SLICE):
        points = np.frombuffer(flat[at:at + SLICE + max(SIZES) - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        for size in SIZES:
            n = min(len(points) - size + 1, SLICE)
            if n > 0:
                key = np.full(n, size, np.uint64)
                for i in range(size):
                    key = key * np.uint64(0x100000001B3) + points[i:i + n]
                yield ((key ^ key >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def present(text: str | None, slots: np.ndarray) -> np.ndarray:
    """Which features a text holds, each once."""
    hits = [slots[b] for b in buckets_of(text)]
    hits = np.concatenate([h[h >= 0] for h in hits]) if hits else np.empty(0, np.int64)
    return np.unique(hits)


def slots_of(buckets: np.ndarray) -> np.ndarray:
    out = np.full(1 << BUCKET_BITS, -1, np.int32)
    out[buckets] = np.arange(len(buckets), dtype=np.int32)
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(text, label, weight) of at most about ``per_class`` documents of each label, by the hash of their key; the weight makes up for
    what the sample leaves out. Also the labelled keys per class."""
    known = labels.where(col(label).isNotNull() & col(key).isNotNull()).groupBy(col(key).alias("key")).agg(F.max(col(label).cast("int")).alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two classes
    share = {c: min(1.0, per_class / n) for c, n in counts.items()}
    of_class = F.lit(0.0)
    for c, s in share.items():
        of_class = F.when(F.col("label") == c, F.lit(s)).otherwise(of_class)
    chosen = known.withColumn("share", of_class).where(unit_position(["key"]) < F.col("share") * UNIT_RANGE)
    rows = docs.select(col(key).alias("key"), col(text).alias("text")).join(F.broadcast(chosen), "key")  # bounded by per_class
    return rows.select("text", "label", F.try_divide(F.lit(1.0), F.col("share")).alias("weight")).repartition(SAMPLE_PARTS, F.xxhash64("key")), counts


def ratios(sample: DataFrame, features: int) -> list:
    """The features that tell the classes apart best, with their log-count ratio, from how many texts of each class hold each n-gram.

    The order is by G2, the likelihood ratio of presence against label. Partial counts are arrays by block of buckets.
    """
    n_blocks, size = 1 << (BUCKET_BITS - BLOCK_BITS), 1 << BLOCK_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 1 << BUCKET_BITS), np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                grams = list(buckets_of(text.as_py()))
                if grams:
                    held[1 if label.as_py() == 1 else 0, np.unique(np.concatenate(grams))] += 1
        cut = held.reshape(2, n_blocks, size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_blocks)), *[pa.array([b.tobytes() for b in cut[c]], pa.binary()) for c in (1, 0)]],
                                         names=["block", "toxic", "clean"])

    def total(group: pa.Table) -> pa.Table:
        sums = [np.sum([np.frombuffer(b, np.int64) for b in group.column(c).to_pylist()], axis=0) for c in ("toxic", "clean")]
        seen = np.flatnonzero(sums[0] + sums[1])
        bucket = group.column("block")[0].as_py() * size + seen
        return pa.table({"bucket": pa.array(bucket), "toxic": pa.array(sums[0][seen]), "clean": pa.array(sums[1][seen])})

    counts = staged(sample.select("text", "label").mapInArrow(count, "block long, toxic binary, clean binary")
                    .groupBy("block").applyInArrow(total, "bucket long, toxic long, clean long"), "toxicity-counts")
    rows = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    a, b = rows.get(1, 0), rows.get(0, 0)
    sums = counts.agg(F.sum("toxic") + SMOOTHING * F.count(F.lit(1)), F.sum("clean") + SMOOTHING * F.count(F.lit(1))).first()
    if not a or not b or sums[0] is None:
        return []
    cells = [(F.col("toxic"), a, "toxic"), (F.lit(a) - F.col("toxic"), a, "absent"), (F.col("clean"), b, "toxic"), (F.lit(b) - F.col("clean"), b, "absent")]
    both = F.col("toxic") + F.col("clean")
    g2 = F.lit(0.0)
    for seen, of_class, kind in cells:
        expected = F.lit(of_class / (a + b)) * (both if kind == "toxic" else F.lit(a + b) - both)
        g2 = g2 + F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    ratio = F.log((F.col("toxic") + SMOOTHING) / F.lit(float(sums[0]))) - F.log((F.col("clean") + SMOOTHING) / F.lit(float(sums[1])))
    return counts.select("bucket", ratio.alias("ratio"), F.round(g2, 6).alias("g2")).orderBy(F.desc("g2"), "bucket").limit(features).collect()


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = SAMPLE_PER_CLASS,
        features: int = FEATURES, penalty: float = PENALTY) -> Model:
    """Learn from the texts of ``docs`` whose key ``labels`` marks 0 or 1.

    A text's features are the n-grams it holds, each worth its log-count ratio log((p / |p|) / (q / |q|)), p and q being the smoothed
    numbers of texts of label 1 and 0 that hold it; a logistic regression weighs them. The model is fitted on a sample of at most about
    ``per_class`` documents a class, weighted back to the class sizes. Null labels and keys are left out, of several labels of one key
    the greatest counts, null texts are empty, repeated documents count repeatedly. Without rows of both classes the model gives every
    text the smoothed share of label 1.
    """
    sample, counts = labelled_sample(docs, labels, key, text, label, per_class)
    sample = staged(sample, "toxicity-sample")
    chosen = ratios(sample, features)
    if not chosen:
        known = sum(counts.values())
        return Model(np.empty(0, np.int64), np.empty(0), float(np.log((counts.get(1, 0) + 1) / (known - counts.get(1, 0) + 1))))
    buckets, ratio = np.array([r["bucket"] for r in chosen]), np.array([r["ratio"] for r in chosen])
    state = {}

    @F.udf(VectorUDT())
    def vector(value):
        if not state:
            state["slots"] = slots_of(buckets)
        held = present(value, state["slots"])
        return SparseVector(len(buckets), held, ratio[held])

    rows = staged(sample.select(vector("text").alias("features"), F.col("label").cast("double").alias("label"), "weight"), "toxicity-features")
    linear = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", regParam=penalty, standardization=False, maxIter=100).fit(rows)
    return Model(buckets, linear.coefficients.toArray() * ratio, float(linear.intercept))


def apply(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus score, the chance of label 1 between 0 and 1. Whole texts are read; a null text scores like an empty one. A column
    ``score`` of ``docs`` is replaced."""
    state = {}

    def run(texts: list) -> dict[str, list]:
        if not state:
            state["slots"] = slots_of(model.buckets)
        values = np.array([model.weights[present(t, state["slots"])].sum() + model.intercept for t in texts], np.float64)
        return {"score": (1 / (1 + np.exp(-np.clip(values, -500, 500)))).tolist()}

    return with_arrow(docs, docs[q(text)].cast("string"), ADDED, run)
