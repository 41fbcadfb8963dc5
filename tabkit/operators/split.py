"""Reproducible splits and samples.

Every row has a fixed pseudo-random position derived from its key, so a split does not depend
on partitioning or row order. Exact shares come from order statistics of those positions: the
rows themselves are only filtered, never ranked or shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import order_statistics
from ..functions.ordered import in_order, row_number
from ..functions.runtime import UNIT_RANGE, bounded, col, unit_position

CLASSES_PER_PASS = 100


def random_split(df: DataFrame, key: list[str], frac: float, seed: int = 0) -> DataFrame:
    """Column ``split``: test with probability ``frac``, else train."""
    test = unit_position(key, seed) < F.lit(frac * UNIT_RANGE)
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def _class_counts(df: DataFrame, label: str) -> list[tuple[object, int]] | None:
    """Few classes are solved by their cut positions, without ranking any row; None for more of them."""
    rows = df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("n")).limit(CLASSES_PER_PASS + 1).collect()
    if len(rows) > CLASSES_PER_PASS:
        return None
    return sorted(((r[0], r["n"]) for r in rows), key=lambda x: (x[0] is None, x[0]))


def _ranked(df: DataFrame, key: list[str], label: str, seed: int) -> DataFrame:
    """Rows with their rank by position inside their class (``__rank``) and its size (``__n``): any number of classes, hot ones in ranges."""
    ranked = in_order(df.withColumn("__u", unit_position(key, seed)), [label], ["__u", *key], {"__rank": row_number()})
    sizes = bounded(df.groupBy(col(label).alias("__y")).agg(F.count(F.lit(1)).alias("__n")))
    return ranked.join(sizes, col(label).eqNullSafe(F.col("__y"))).drop("__u", "__y")


def _cut_points(df: DataFrame, key: list[str], label: str, wanted: dict, seed: int, limit: int | None) -> dict:
    """Position of the given 0-based ranks inside each class: ``{class: {rank: position}}``."""
    classes = [c for c, (n, ranks) in wanted.items() if ranks]
    out: dict = {c: {} for c in wanted}
    for at in range(0, len(classes), CLASSES_PER_PASS):
        some = classes[at:at + CLASSES_PER_PASS]
        wide = df.select(col(label).alias("__y"), unit_position(key, seed).alias("__u")).select(*[
            F.when(F.col("__y").eqNullSafe(F.lit(c)), F.col("__u")).alias(f"u{i}") for i, c in enumerate(some)])
        stats = order_statistics(wide, {f"u{i}": wanted[c][1] for i, c in enumerate(some)},
                                 {f"u{i}": wanted[c][0] for i, c in enumerate(some)}, limit)
        for i, c in enumerate(some):
            out[c] = stats[f"u{i}"]
    return out


def _by_class(label: str, cases: dict, otherwise: Column) -> Column:
    out = None
    for c, e in cases.items():
        cond = col(label).eqNullSafe(F.lit(c))
        out = F.when(cond, e) if out is None else out.when(cond, e)
    return otherwise if out is None else out.otherwise(otherwise)


def _half_up(x: float) -> int:
    return math.floor(x + 0.5)


def stratified_split(df: DataFrame, key: list[str], label: str, frac: float, seed: int = 0,
                     limit: int | None = None) -> DataFrame:
    """Column ``split``; every class gives round(frac * n) rows to test."""
    return _cut_split(df, key, label, [("test", frac)], "train", seed, limit)


def three_way_split(df: DataFrame, key: list[str], label: str, valid: float = 0.2, test: float = 0.2,
                    seed: int = 0, limit: int | None = None) -> DataFrame:
    """Column ``split`` with train, valid and test, stratified."""
    return _cut_split(df, key, label, [("test", test), ("valid", valid)], "train", seed, limit)


def _cut_split(df, key, label, parts, rest, seed, limit) -> DataFrame:
    counts = _class_counts(df, label)
    if counts is None:
        expr, upto = F.lit(rest), sum(f for _, f in parts)
        for name, f in reversed(parts):
            expr = F.when(F.col("__rank") <= F.floor(upto * F.col("__n") + 0.5), name).otherwise(expr)
            upto -= f
        return _ranked(df, key, label, seed).withColumn("split", expr).drop("__rank", "__n")
    wanted, sizes = {}, {}
    for c, n in counts:
        ends, upto = [], 0.0
        for _, f in parts:
            upto += f
            ends.append(_half_up(upto * n))
        sizes[c] = ends
        wanted[c] = (n, sorted({e - 1 for e in ends if e > 0}))
    cuts = _cut_points(df, key, label, wanted, seed, limit)
    u = F.col("__u")
    cases = {}
    for c, _ in counts:
        expr, start = F.lit(rest), 0
        for (name, _), end in reversed(list(zip(parts, sizes[c]))):
            if end > 0:
                expr = F.when(u <= F.lit(cuts[c][end - 1]), name).otherwise(expr)
        cases[c] = expr
    return (df.withColumn("__u", unit_position(key, seed))
            .withColumn("split", _by_class(label, cases, F.lit(rest))).drop("__u"))


def kfold(df: DataFrame, key: list[str], label: str, k: int = 5, seed: int = 0, limit: int | None = None) -> DataFrame:
    """Column ``fold`` 0..k-1; fold sizes differ by at most one row inside every class."""
    counts = _class_counts(df, label)
    if counts is None:
        fold = sum((F.when(F.col("__rank") > F.floor(F.lit(i) * F.col("__n") / k), 1).otherwise(0) for i in range(1, k)), F.lit(0))
        return _ranked(df, key, label, seed).withColumn("fold", fold.cast("int")).drop("__rank", "__n")
    ends = {c: [i * n // k for i in range(1, k)] for c, n in counts}
    wanted = {c: (n, sorted({e - 1 for e in ends[c] if e > 0})) for c, n in counts}
    cuts = _cut_points(df, key, label, wanted, seed, limit)
    cases = {}
    for c, _ in counts:
        fold = F.lit(0)
        for e in ends[c]:
            fold = fold + (F.lit(1) if e == 0 else F.when(F.col("__u") > F.lit(cuts[c][e - 1]), 1).otherwise(0))
        cases[c] = fold
    return (df.withColumn("__u", unit_position(key, seed))
            .withColumn("fold", _by_class(label, cases, F.lit(0)).cast("int")).drop("__u"))


def undersample(df: DataFrame, key: list[str], label: str, seed: int = 0, limit: int | None = None) -> DataFrame:
    """The same number of rows from every class: as many as the smallest class has."""
    counts = _class_counts(df, label)
    if counts is None:
        known = df.where(col(label).isNotNull())
        least = known.groupBy(col(label)).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).first()[0]
        return _ranked(known, key, label, seed).where(F.col("__rank") <= least).drop("__rank", "__n")
    counts = [(c, n) for c, n in counts if c is not None]
    least = min(n for _, n in counts)
    cuts = _cut_points(df, key, label, {c: (n, [least - 1]) for c, n in counts}, seed, limit)
    cases = {c: F.lit(cuts[c][least - 1]) for c, _ in counts}
    return (df.withColumn("__u", unit_position(key, seed))
            .where(F.col("__u") <= _by_class(label, cases, F.lit(-1.0))).drop("__u"))


def time_split(df: DataFrame, name: str, cutoff) -> DataFrame:
    """Column ``split``: before the cutoff train, from it on test; null dates are in neither."""
    return df.where(col(name).isNotNull()).withColumn(
        "split", F.when(col(name) < F.lit(cutoff), "train").otherwise("test"))


def period_split(df: DataFrame, name: str) -> DataFrame:
    """Column ``split``: last period holdout, the one before test, the one before that valid, the
    rest train. At least four periods are needed; null periods are in none."""
    last = [r[0] for r in df.select(col(name)).where(col(name).isNotNull()).distinct()
            .orderBy(col(name).desc()).limit(4).collect()]
    if len(last) < 4:
        raise ValueError(f"{name} has {len(last)} periods, 4 needed")
    c = col(name)
    split = F.when(c == F.lit(last[0]), "holdout").when(c == F.lit(last[1]), "test").when(
        c == F.lit(last[2]), "valid").otherwise("train")
    return df.where(c.isNotNull()).withColumn("split", split)


def shared_split(df: DataFrame, split: DataFrame, key: list[str]) -> DataFrame:
    """Give a second label table the split another table already has."""
    return df.join(split.select(*key, "split"), key)


def bootstrap(df: DataFrame, key: list[str], b: int, seed: int = 0) -> DataFrame:
    """``b`` resamples with replacement in one table (column ``sample``).

    Each row is repeated Poisson(1) times per sample, which needs no row numbers and no
    shuffle; a sample has n rows in expectation.
    """
    sample = df.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(b - 1))))
    u = unit_position([*key, "sample"], seed) / F.lit(UNIT_RANGE)
    limits, p, total = [], math.exp(-1.0), 0.0
    for i in range(1, 20):
        total += p
        limits.append(total)
        p /= i
    times = sum((F.when(u >= F.lit(t), 1).otherwise(0) for t in limits), F.lit(0))
    return sample.withColumn("__t", times).where("__t > 0") \
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__t")))).drop("__t")
