"""Data checks: ranges, row sums, domains, contracts, overview. Each is one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.runtime import col, rows_from
from .profile import value_table

# Hour columns lie in a day, a grade average on a four-point scale.
HOURS = (0.0, 24.0)
GRADE = (0.0, 4.0)


def range_report(df: DataFrame, rules: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows outside [low, high] per column; null counts as inside, an absent column gives null."""
    present = [c for c in rules if c in df.columns]
    agg = df.agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if((col(c) < rules[c][0]) | (col(c) > rules[c][1])).alias(f"o{i}") for i, c in enumerate(present)])
    at = {c: F.col(f"o{i}") for i, c in enumerate(present)}
    return agg.select(rows_from([
        F.struct(F.lit(c).alias("column"), F.lit(float(lo)).alias("low"), F.lit(float(hi)).alias("high"),
                 at.get(c, F.lit(None).cast("long")).alias("n_outside"),
                 F.try_divide(100.0 * at.get(c, F.lit(None).cast("long")), F.col("n")).alias("pct_outside"))
        for c, (lo, hi) in rules.items()]))


def rowsum_report(df: DataFrame, cols: list[str], high: float = 24.0) -> DataFrame:
    """Rows whose sum over ``cols`` (null as 0) exceeds ``high``."""
    total = sum((F.coalesce(col(c), F.lit(0)) for c in cols), F.lit(0.0))
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(total > high).alias("n_over"))
    return agg.select("n_rows", "n_over", F.try_divide(100.0 * F.col("n_over"), F.col("n_rows")).alias("pct_over"))


def domain_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n): every distinct non-null value of every column, as text. One aggregate, any number of values."""
    return value_table(df.select(*[col(c).cast("string").alias(c) for c in cols]), cols)


def domain_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values per column and whether each occurs once; ``domain_values`` lists them. Columns without values count zero."""
    found = domain_values(df, cols).groupBy(F.col("column").alias("__c")).agg(F.count(F.lit(1)).alias("n_unique"), F.max("n").alias("__most"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    out = names.join(F.broadcast(found), F.col("column") == F.col("__c"), "left")  # one row per column
    return out.select("column", F.coalesce("n_unique", F.lit(0)).alias("n_unique"), (F.coalesce("__most", F.lit(1)) == 1).alias("is_unique"))


def unmapped(df: DataFrame, name: str, mapping: dict | list, fail: bool = False) -> DataFrame:
    """Distinct non-null values that the mapping does not know, with their counts."""
    known = list(mapping)
    out = (df.where(col(name).isNotNull() & ~col(name).isin(known)).groupBy(col(name).alias("value"))
           .agg(F.count(F.lit(1)).alias("n")))
    if fail:
        values, rows, example = out.agg(F.count(F.lit(1)), F.sum("n"), F.min("value")).first()
        if values:
            raise ValueError(f"{values} unmapped values in {rows} rows of {name}, the smallest is {example!r}; without fail= they come as a table")
    return out


def scaling_report(df: DataFrame, cols: list[str], rule: str = "loose") -> DataFrame:
    """Mean and std per column and whether they look standardised.

    ``loose``: abs(mean) < 0.25 and 0.5 < std < 1.5 with n; ``strict``: within 0.1 of 0 and 1 with n - 1.
    """
    std = F.stddev_pop if rule == "loose" else F.stddev_samp
    agg = df.agg(*[e for i, c in enumerate(cols) for e in (F.avg(col(c)).alias(f"a{i}"), std(col(c)).alias(f"s{i}"))])

    def ok(a, s):
        if rule == "loose":
            return (F.abs(a) < 0.25) & (s > 0.5) & (s < 1.5)
        return (F.abs(a) < 0.1) & (F.abs(s - 1) < 0.1)
    return agg.select(rows_from([
        F.struct(F.lit(c).alias("column"), F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                 ok(F.col(f"a{i}"), F.col(f"s{i}")).alias("is_standardised")) for i, c in enumerate(cols)]))


def check_contract(df: DataFrame, required: list[str] = (), numeric_only: bool = False, no_nulls: bool = False,
                   non_empty: bool = True, same_rows_as: DataFrame | None = None,
                   same_columns_as: DataFrame | None = None) -> DataFrame:
    """One row per check with its result; nothing is raised."""
    checks: list[tuple[str, bool]] = []
    if required:
        checks.append(("required_columns", set(required) <= set(df.columns)))
    if numeric_only:
        checks.append(("numeric_only", all(isinstance(f.dataType, T.NumericType) for f in df.schema)))
    if same_columns_as is not None:
        checks.append(("same_columns", set(df.columns) == set(same_columns_as.columns)))
    has_null = F.lit(False)
    for c in df.columns:
        has_null = has_null | col(c).isNull()
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(has_null).alias("m"))
    rows = [F.struct(F.lit(n).alias("check"), F.lit(v).alias("ok")) for n, v in checks]
    if non_empty:
        rows.append(F.struct(F.lit("non_empty").alias("check"), (F.col("n") > 0).alias("ok")))
    if no_nulls:
        rows.append(F.struct(F.lit("no_nulls").alias("check"), (F.col("m") == 0).alias("ok")))
    if same_rows_as is not None:
        agg = agg.withColumn("o", same_rows_as.agg(F.count(F.lit(1))).scalar())
        rows.append(F.struct(F.lit("same_rows").alias("check"), (F.col("n") == F.col("o")).alias("ok")))
    return agg.select(rows_from(rows))


def require_contract(df: DataFrame, **checks) -> DataFrame:
    """Raise with the names of the failed checks; else hand the table on."""
    failed = [r["check"] for r in check_contract(df, **checks).collect() if not r["ok"]]
    if failed:
        raise ValueError(f"input contract broken: {', '.join(failed)}")
    return df


def overview(df: DataFrame, rules: dict[str, tuple[float, float]] | None = None, limit: int | None = None) -> DataFrame:
    """Long table (column, metric, value): shape, duplicates, nulls, describe, range violations."""
    from .dedup import count_duplicates
    from .profile import describe, missing_report
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    whole = F.lit("*").alias("column")

    def long(t: DataFrame, metrics: list[str]) -> DataFrame:
        return t.select("column", *[F.col(m).cast("double").alias(m) for m in metrics]) \
            .unpivot(["column"], metrics, "metric", "value")
    parts = [
        long(df.agg(F.count(F.lit(1)).alias("n_rows")).select(whole, "n_rows", F.lit(len(df.columns)).alias("n_cols")),
             ["n_rows", "n_cols"]),
        long(count_duplicates(df).select(whole, "n_duplicates"), ["n_duplicates"]),
        long(missing_report(df), ["n_missing", "pct_missing"]),
    ]
    if numeric:
        parts.append(long(describe(df, numeric, limit), ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]))
    if rules:
        parts.append(long(range_report(df, rules), ["n_outside", "pct_outside"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def require_periods(df: DataFrame, name: str, at_least: int = 4) -> DataFrame:
    """Error unless the column has enough distinct periods."""
    n = df.agg(F.count_distinct(col(name))).first()[0]
    if n < at_least:
        raise ValueError(f"{name} has {n} periods, {at_least} needed")
    return df
