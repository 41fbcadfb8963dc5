"""Joins, unions, set differences, value maps and per-entity windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import in_order, previous, row_number
from ..functions.runtime import bounded, col

LITERAL_PAIRS = 32


def join_by_key(a: DataFrame, b: DataFrame, key: list[str], how: str = "left") -> DataFrame:
    """Row-aligned join on a carried id. Spark rows have no position, so the key says which rows match."""
    return a.join(b, key, how)


def bind_columns(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Columns of both tables side by side; columns of b that a has already are left out."""
    extra = [c for c in b.columns if c not in a.columns]
    return a.join(b.select(*key, *[col(c) for c in extra]), key, "inner")


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y), dfs)


def map_values(df: DataFrame, name: str, mapping: dict, out: str | None = None, default: str | None = None) -> DataFrame:
    """Value map; unmapped values become null, or the value of column ``default``."""
    target = out or name
    if len(mapping) <= LITERAL_PAIRS:
        pairs = [F.lit(x) for kv in mapping.items() for x in kv]
        mapped = F.try_element_at(F.create_map(*pairs), col(name))
        if default is not None:
            mapped = F.coalesce(mapped, col(default))
        return df.withColumn(target, mapped)
    table = bounded(df.sparkSession.createDataFrame(list(mapping.items()), ["__from", "__to"]))
    mapped = F.col("__to") if default is None else F.coalesce(F.col("__to"), col(default))
    joined = df.join(table, col(name) == F.col("__from"), "left")
    return joined.withColumn(target, mapped).drop(*[c for c in ("__from", "__to") if c != target])


def consensus(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Two per-group error tables side by side with the mean of their error shares."""
    left = a.select(key, "n", F.col("errors").alias("errors_a"), F.col("error_pct").alias("error_pct_a"))
    right = b.select(key, F.col("errors").alias("errors_b"), F.col("error_pct").alias("error_pct_b"))
    both = left.join(right, key)
    return both.withColumn("error_pct_mean", (F.col("error_pct_a") + F.col("error_pct_b")) / 2) \
        .orderBy(F.desc("error_pct_mean"), key)


def set_diff(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Distinct values of a that b does not hold."""
    left = a.select(col(name)).distinct()
    right = b.select(col(name).alias("__other")).distinct()
    return left.join(right, left[name].eqNullSafe(right["__other"]), "left_anti")


def same_set(a: DataFrame, b: DataFrame, name: str) -> bool:
    return set_diff(a, b, name).isEmpty() and set_diff(b, a, name).isEmpty()


def returns(df: DataFrame, part: list[str], order: list[str], name: str, out: str = "ret",
            log: bool = False, first: float | None = 0.0, rows_per_task: int | None = None) -> DataFrame:
    """Change relative to the previous row of the entity. Its first row gets ``first``; after a missing or zero value the change is null."""
    rows = in_order(df, part, order, {"__prev": previous(col(name)), "__at": row_number()}, rows_per_task)
    change = F.try_divide(col(name), F.col("__prev")) - 1
    if log:
        change = F.log1p(change)
    if first is not None:
        change = F.when(F.col("__at") == 1, F.lit(first)).otherwise(change)
    return rows.withColumn(out, change).drop("__prev", "__at")


def delta(df: DataFrame, part: list[str], order: list[str], name: str, out: str | None = None,
          rows_per_task: int | None = None) -> DataFrame:
    """Difference to the previous row of the entity; null on its first row."""
    rows = in_order(df, part, order, {"__prev": previous(col(name))}, rows_per_task)
    return rows.withColumn(out or f"delta_{name}", col(name) - F.col("__prev")).drop("__prev")


def share(df: DataFrame, keys: list[str], within: list[str]) -> DataFrame:
    """Row counts per key and their share of the enclosing group (or of all rows)."""
    counts = df.groupBy(*[col(k) for k in [*within, *keys]]).agg(F.count(F.lit(1)).alias("n"))
    if not within:
        return counts.withColumn("share", F.col("n") / df.agg(F.count(F.lit(1))).scalar())
    totals = counts.groupBy(*[col(w).alias(f"__w{i}") for i, w in enumerate(within)]).agg(F.sum("n").alias("__t"))
    cond = F.lit(True)
    for i, w in enumerate(within):
        cond = cond & counts[w].eqNullSafe(totals[f"__w{i}"])
    return counts.join(totals, cond).select(*within, *keys, "n", (F.col("n") / F.col("__t")).alias("share"))


def ranks(df: DataFrame, name: str, order: list[str], rows_per_task: int | None = None) -> DataFrame:
    """Average rank of ``name`` and the row's position in ``order``."""
    from .correlate import average_ranks
    table = average_ranks(df, name, rows_per_task).select(F.col("value").alias("__v"), F.col("rank").alias("avg_rank"))
    ranked = df.join(table, df[name].cast("double") == F.col("__v"), "left").drop("__v")
    return in_order(ranked, [], order, {"position": row_number()}, rows_per_task)
