"""Duplicate detection and removal. Only aggregates that combine before the shuffle are used,
so a value repeated in a third of the rows costs no more than any other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import order_key
from ..functions.runtime import col, same_keys


def count_duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each group of equals (null equals null)."""
    sizes = df.groupBy(*[col(c) for c in (subset or df.columns)]).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def flag_duplicates(df: DataFrame, subset: list[str], order: list[str], name: str = "is_duplicate") -> DataFrame:
    """True on every row after the first of its group in ``order`` (which must be unique)."""
    whole = order_key(df, order)
    key = whole if len(order) > 1 else whole["o0"]  # one plain column keeps the aggregate hash based
    first = df.groupBy(*[col(c).alias(f"__k{i}") for i, c in enumerate(subset)]).agg(F.min(key).alias("__first"))
    on = same_keys(df, first, [(c, f"__k{i}") for i, c in enumerate(subset)])
    return df.join(first, on, "left").select(*[df[c] for c in df.columns], (key > F.col("__first")).alias(name))


def drop_duplicates(df: DataFrame, subset: list[str] | None = None, keep: str = "first",
                    order: list[str] | None = None) -> DataFrame:
    """Exact duplicates without ``subset``; else the first or last row of each group in ``order``."""
    if subset is None:
        return df.distinct()
    if not order:
        raise ValueError("a subset needs an order to say which row is kept")
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    rest = [c for c in df.columns if c not in subset]
    best = df.groupBy(*[col(c) for c in subset]).agg(
        pick(F.struct(*[col(c).alias(f"r{i}") for i, c in enumerate(rest)]), order_key(df, order)).alias("__row"))
    at = {c: i for i, c in enumerate(rest)}
    return best.select(*[F.col("__row")[f"r{at[c]}"].alias(c) if c in at else col(c) for c in df.columns])
