"""Running values over an ordered group, split across tasks when the group is large.

A plain window puts a whole group (or, without a key, the whole table) into one task. Here a
group larger than ``rows_per_task`` is cut into contiguous ranges of the order key. Each range
is a window of its own, and what it needs from the ranges before or after it (a count, a
sum, the last value) comes from a small per-range aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import col, same_keys

ROWS_PER_TASK = 2_000_000
MAX_RANGES = 20_000
SAMPLE_PER_RANGE = 32
RANGE = "__range"


def _sortable(df: DataFrame, name: str) -> Column:
    """Order column as a type that survives JSON exactly."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col(name))
    if isinstance(kind, T.TimestampNTZType):
        return col(name).cast("string")  # ISO text sorts like the time and knows no time zone
    if isinstance(kind, T.DateType):
        return F.unix_date(col(name))
    if isinstance(kind, T.BooleanType):
        return col(name).cast("int")
    if isinstance(kind, (T.IntegralType, T.DoubleType, T.StringType)):
        return col(name)
    if isinstance(kind, T.FloatType):
        return col(name).cast("double")
    raise TypeError(f"cannot order by {name}: {kind.simpleString()}")


def order_key(df: DataFrame, order: list[str]) -> Column:
    return F.struct(*[_sortable(df, c).alias(f"o{i}") for i, c in enumerate(order)])


def _rows_in_large_groups(df: DataFrame, part: list[str], limit: int) -> tuple[int, DataFrame]:
    if not part:
        n = df.count()
        return (n if n > limit else 0), df
    sizes = df.groupBy(*[col(p) for p in part]).agg(F.count(F.lit(1)).alias("__n"))
    large = sizes.where(F.col("__n") > limit)
    n = large.agg(F.sum("__n")).first()[0] or 0
    if not n:
        return 0, df
    keys = large.select(*[col(c).alias(f"__k{i}") for i, c in enumerate(part)])
    on = same_keys(df, keys, [(c, f"__k{i}") for i, c in enumerate(part)])
    return n, df.join(keys, on, "left_semi")


def with_ranges(df: DataFrame, part: list[str], order: list[str],
                rows_per_task: int | None = None) -> tuple[DataFrame, bool]:
    """Add the range number; all zero (and False) when every group fits into one task."""
    limit = rows_per_task or ROWS_PER_TASK
    n, large = _rows_in_large_groups(df, part, limit)
    if not n:
        return df.withColumn(RANGE, F.lit(0)), False
    n_ranges = min(MAX_RANGES, max(2, math.ceil(4 * n / limit)))
    one_in = max(1, n // (SAMPLE_PER_RANGE * n_ranges))
    key = order_key(df, order)
    sample = (large.where(F.pmod(F.xxhash64(*[col(c) for c in [*part, *order]]), F.lit(one_in)) == 0)
              .select(key.alias("k")).orderBy("k").select(F.to_json("k")).collect())
    step = max(1, len(sample) // n_ranges)
    cuts = [r[0] for r in sample[step::step]]
    if not cuts:
        return df.withColumn(RANGE, F.lit(0)), False
    key_type = df.select(key.alias("k")).schema["k"].dataType
    points = F.from_json(F.lit("[" + ",".join(cuts) + "]"), T.ArrayType(key_type))
    return df.withColumn(RANGE, _cuts_not_above(points, key, len(cuts))), True


def _cuts_not_above(points: Column, key: Column, n: int) -> Column:
    """Binary search: how many cut points are <= key."""
    jumps = [1 << i for i in reversed(range(n.bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(j) for j in jumps]), F.lit(0),
        lambda at, jump: F.when(F.get(points, at + jump - F.lit(1)) <= key, at + jump).otherwise(at))


def row_number() -> tuple:
    return ("row_number", None)


def running_sum(value: Column) -> tuple:
    return ("sum", value)


def previous(value: Column) -> tuple:
    return ("previous", value)


def last_seen(value: Column) -> tuple:
    """Latest non-null value up to and including this row."""
    return ("last", value)


def next_seen(value: Column) -> tuple:
    """First non-null value from this row on."""
    return ("next", value)


def in_order(df: DataFrame, part: list[str], order: list[str], outputs: dict[str, tuple],
             rows_per_task: int | None = None) -> DataFrame:
    """Add one column per output. ``order`` must order the rows of a group without ties."""
    ranged, split = with_ranges(df, part, order, rows_per_task)
    if not split:
        local = Window.partitionBy(*map(col, part)).orderBy(*map(col, order))
        back = _backwards(part, order)
        return df.select("*", *[_local(kind, value, local, back).alias(name)
                                for name, (kind, value) in outputs.items()])

    keys = [*part, RANGE]
    local = Window.partitionBy(*map(col, keys)).orderBy(*map(col, order))
    back = _backwards(keys, order)
    rows = ranged.select("*", *[_local(kind, value, local, back).alias(f"__{name}")
                                for name, (kind, value) in outputs.items()],
                         F.row_number().over(local).alias("__at"))

    at = order_key(df, order)
    summary = ranged.groupBy(*map(col, keys)).agg(
        *[_summary(kind, value, at).alias(name) for name, (kind, value) in outputs.items()])
    before = Window.partitionBy(*map(col, part)).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*map(col, part)).orderBy(F.desc(RANGE)).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *[col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[_carry(kind, F.col(name), before, after).alias(f"__c_{name}")
          for name, (kind, _) in outputs.items()])

    joined = rows.join(carry, same_keys(rows, carry, [(k, f"__k{i}") for i, k in enumerate(keys)]), "left")
    return joined.select(*map(col, df.columns), *[_combine(kind, name).alias(name) for name, (kind, _) in outputs.items()])


def _backwards(keys: list[str], order: list[str]):
    # a frame that looks ahead is quadratic in Spark; looking back in reverse order is linear
    return Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])


def _local(kind: str, value: Column | None, w, back) -> Column:
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if kind == "row_number":
        return F.row_number().over(w).cast("long")
    if kind == "sum":
        return F.sum(value).over(so_far)
    if kind == "previous":
        return F.lag(value).over(w)
    if kind == "last":
        return F.last(value, ignorenulls=True).over(so_far)
    return F.last(value, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _summary(kind: str, value: Column | None, at: Column) -> Column:
    if kind == "row_number":
        return F.count(F.lit(1))
    if kind == "sum":
        return F.sum(value)
    if kind == "previous":
        return F.max_by(F.struct(value.alias("v")), at)
    if kind == "last":
        return F.max_by(value, F.when(value.isNotNull(), at))
    return F.min_by(value, F.when(value.isNotNull(), at))


def _carry(kind: str, total: Column, before, after) -> Column:
    if kind in ("row_number", "sum"):
        return F.sum(total).over(before)
    if kind in ("previous", "last"):
        return F.last(total, ignorenulls=True).over(before)
    return F.last(total, ignorenulls=True).over(after)


def _combine(kind: str, name: str) -> Column:
    here, carried = F.col(f"__{name}"), F.col(f"__c_{name}")
    if kind in ("row_number", "sum"):
        return F.when(here.isNull(), carried).otherwise(here + F.coalesce(carried, F.lit(0)))
    if kind == "previous":
        return F.when(F.col("__at") == 1, carried["v"]).otherwise(here)
    return F.coalesce(here, carried)
