"""Column-to-column expressions: parsing, text cleaning, logs, clipping, rounding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value, after trim and lower.
MISSING_TOKENS = ["", "na", "n/a", "null", "none", "nan", "?", "-999"]
EPSILON = 1e-8
SERIAL_ORIGIN = "1899-12-31"
PROB_FLOOR = 1e-8


def to_number(c: Column) -> Column:
    """Number, or null for text that is none; NaN and infinities become null as well."""
    return finite(c.try_cast("double"))


def finite(c: Column) -> Column:
    """NULL is the only missing marker: NaN and +-inf become null."""
    inf = F.lit(float("inf"))
    return F.when(F.isnan(c) | (F.abs(c) == inf), F.lit(None)).otherwise(c)


def parse_number(c: Column, thousands: str = ",") -> Column:
    return to_number(F.replace(c.cast("string"), F.lit(thousands), F.lit("")))


def parse_date(c: Column, formats: tuple[str, ...] = ("yyyy-MM-dd", "yyyy-MM", "dd/MM/yyyy")) -> Column:
    text = F.trim(c.cast("string"))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])


def from_serial_day(c: Column, origin: str = SERIAL_ORIGIN) -> Column:
    """Day number of a spreadsheet as a date."""
    return F.date_add(F.lit(origin).cast("date"), c.cast("int"))


def to_int(c: Column, mode: str = "truncate") -> Column:
    """``truncate`` drops the fraction, ``round`` rounds halves to even."""
    if mode == "truncate":
        return c.try_cast("long")
    if mode == "round":
        return F.rint(c).try_cast("long")
    raise ValueError(f"unknown mode {mode}")


def clean_text(c: Column) -> Column:
    return F.trim(F.lower(c))


def token_to_null(c: Column, tokens: list[str] | None = None, lower: bool = True) -> Column:
    """Trimmed text; null where it is one of the missing-value tokens."""
    text = F.trim(c)
    probe = F.lower(text) if lower else text
    return F.when(probe.isin(list(tokens or MISSING_TOKENS)), F.lit(None)).otherwise(text)


def clip(c: Column, low: float | Column | None = None, high: float | Column | None = None) -> Column:
    out = c
    if low is not None:
        out = F.when(out < low, low).otherwise(out)
    if high is not None:
        out = F.when(out > high, high).otherwise(out)
    return out


def log_of(c: Column, kind: str = "log10") -> Column:
    """``log10``, ``log10p1`` (of x + 1), ``log10floor`` (0 read as 0.01) or ``log1p``."""
    if kind == "log10":
        return F.log10(c)
    if kind == "log10p1":
        return F.log10(c + 1)
    if kind == "log10floor":
        return F.log10(F.when(c == 0, F.lit(0.01)).otherwise(c))
    if kind == "log1p":
        return F.log1p(c)
    raise ValueError(f"unknown kind {kind}")


def safe_divide(a: Column, b: Column, eps: float = EPSILON) -> Column:
    return F.try_divide(a, b + F.lit(eps))


def norm(cols: list[Column]) -> Column:
    return F.sqrt(reduce(lambda x, y: x + y, [c * c for c in cols]))


def to_class(c: Column, low: int, high: int) -> Column:
    """Nearest integer class (halves to even) inside [low, high]."""
    return clip(F.rint(c), F.lit(float(low)), F.lit(float(high))).cast("int")


def bucket_case(c: Column, rules: list[tuple[float, object]], otherwise: object) -> Column:
    """First rule whose upper limit the value does not exceed; null takes the last branch."""
    out = None
    for limit, value in rules:
        cond = c <= F.lit(limit)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(F.lit(otherwise))
