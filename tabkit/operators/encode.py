"""Categorical encoders. Codes are learned once and applied as a projection or a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import in_order, row_number
from ..functions.runtime import bounded, col, cut_lineage
from .params import Params
from .profile import levels

ONEHOT_CAP = 1_000

# Ordinal codes of the stress classes.
STRESS_CODES = {"Low": 0, "Moderate": 1, "High": 2}


def fit_onehot(df: DataFrame, cols: list[str], cap: int = ONEHOT_CAP) -> Params:
    """Categories per column, sorted in the column's own type (2 before 10). More than ``cap`` would be as many columns: an error."""
    return Params({c: {"levels": _names(df, c, cap)} for c in cols})


def _names(df: DataFrame, name: str, cap: int) -> list[str]:
    found = df.select(col(name).alias("v"), col(name).cast("string").alias("s")).where("v is not null").distinct().orderBy("v").limit(cap + 1).collect()
    if len(found) > cap:
        raise ValueError(f"{name} has more than {cap} distinct values")
    return [r["s"] for r in found]


def apply_onehot(df: DataFrame, params: Params, drop_first: bool = False) -> DataFrame:
    """0/1 columns named ``column_value``; null and unseen values give zeros everywhere."""
    new = []
    for c, p in params.values.items():
        for v in p["levels"][1 if drop_first else 0:]:
            new.append(F.when(col(c).cast("string") == v, 1).otherwise(0).alias(f"{c}_{v}"))
    return df.select(*[col(c) for c in df.columns if c not in params.values], *new)


def fit_label(df: DataFrame, name: str, null_label: str | None = None, start: int = 0,
              rows_per_task: int | None = None) -> DataFrame:
    """Code table (value, code): alphabetical order, codes from ``start``.

    With ``null_label`` a null counts as that text. The number of categories is not limited.
    """
    text = F.trim(col(name).cast("string"))
    value = F.coalesce(text, F.lit(null_label)) if null_label is not None else text
    values = df.select(value.alias("value")).where(F.col("value").isNotNull()).distinct()
    numbered = in_order(cut_lineage(values), [], ["value"], {"code": row_number()}, rows_per_task)
    return numbered.withColumn("code", F.col("code") - 1 + start)


def apply_label(df: DataFrame, name: str, codes: DataFrame, out: str | None = None, unknown: int | None = None,
                null_label: str | None = None) -> DataFrame:
    """Look the codes up; unseen and null values give ``unknown``."""
    text = F.trim(col(name).cast("string"))
    value = F.coalesce(text, F.lit(null_label)) if null_label is not None else text
    table = codes.select(F.col("value").alias("__value"), F.col("code").alias("__code"))
    joined = df.withColumn("__text", value).join(bounded(table), F.col("__text") == F.col("__value"), "left")
    code = F.coalesce(F.col("__code"), F.lit(unknown).cast("long")) if unknown is not None else F.col("__code")
    target = out or name
    keep = [col(c) for c in df.columns if c != target]
    return joined.select(*keep, code.alias(target))


def encode_ordinal(df: DataFrame, name: str, preferred: dict[str, int] | None = None, out: str | None = None) -> DataFrame:
    """Given order when every value is known to it, otherwise alphabetical codes."""
    preferred = preferred or STRESS_CODES
    stray = df.where(col(name).isNotNull() & ~col(name).isin(list(preferred))).limit(1).count()
    if stray:
        return apply_label(df, name, fit_label(df, name), out or f"{name}_code")
    code = None
    for value, number in preferred.items():
        code = F.when(col(name) == value, number) if code is None else code.when(col(name) == value, number)
    return df.withColumn(out or f"{name}_code", code.cast("long"))


def fit_binary(df: DataFrame, name: str, rows_per_task: int | None = None) -> DataFrame:
    """Code table with 1-based codes by sorted value."""
    return fit_label(df, name, start=1, rows_per_task=rows_per_task)


def apply_binary(df: DataFrame, name: str, codes: DataFrame) -> DataFrame:
    """Bit columns ``name_0`` (highest bit) to ``name_k``; null and unseen values are all zero."""
    top = codes.agg(F.max("code")).first()[0] or 0
    width = max(1, int(top).bit_length())
    coded = apply_label(df, name, codes, "__code_out", unknown=0)
    bits = [F.shiftright("__code_out", width - 1 - i).bitwiseAND(F.lit(1)).cast("int").alias(f"{name}_{i}") for i in range(width)]
    return coded.select(*[col(c) for c in df.columns if c != name], *bits)


def factorize(df: DataFrame, name: str, order: list[str], out: str | None = None, rows_per_task: int | None = None) -> DataFrame:
    """Codes by first appearance in ``order``; null gives -1."""
    from ..functions.ordered import order_key
    first = (df.where(col(name).isNotNull()).groupBy(col(name).alias("value"))
             .agg(F.min(order_key(df, order)).alias("__f")))
    flat = first.select("value", *[F.col("__f")[f"o{i}"].alias(f"__o{i}") for i in range(len(order))])
    numbered = in_order(cut_lineage(flat), [], [f"__o{i}" for i in range(len(order))], {"code": row_number()}, rows_per_task)
    codes = numbered.select(F.col("value").alias("__value"), (F.col("code") - 1).alias("__code"))
    joined = df.join(bounded(codes), df[name] == F.col("__value"), "left").drop("__value")
    return joined.withColumn(out or f"{name}_code", F.coalesce("__code", F.lit(-1))).drop("__code")
