"""Derived features: log of skewed columns, family, financial panel, polynomial, variants."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import in_order, previous
from ..functions.runtime import col, rows_from
from ..functions.scalars import safe_divide
from .encode import apply_binary, apply_label, apply_onehot, fit_binary, fit_label, fit_onehot
from .profile import skew

SKEW_LIMIT = 1.0

# Ratio features of the finance panel, (name, numerator, denominator).
PANEL_RATIOS = [
    ("ratio_gastos_personal_ingresos", "gastos_personal", "ingresos_totales"),
    ("ratio_cfo_ingresos", "cfo", "ingresos_totales"),
    ("ratio_liquidez_endeudamiento", "liquidez", "endeudamiento"),
]
PANEL_DELTAS = [("delta_gp_ratio_anual", "gp_ratio"), ("delta_liquidez_anual", "liquidez")]
DAYS_PER_YEAR = 365.0


def skewed_columns(df: DataFrame, cols: list[str], t: float = SKEW_LIMIT) -> DataFrame:
    """Skewness before and after ``log10(x + 1)`` and whether the column qualifies."""
    agg = df.agg(*[e for i, c in enumerate(cols) for e in (
        skew(col(c)).alias(f"g{i}"), F.min(col(c)).alias(f"m{i}"),
        skew(F.when(col(c) >= 0, F.log10(col(c) + 1))).alias(f"l{i}"))])
    return agg.select(rows_from([
        F.struct(F.lit(c).alias("column"), F.col(f"g{i}").alias("skew_before"),
                 F.when(F.col(f"m{i}") >= 0, F.col(f"l{i}")).alias("skew_after"),
                 F.coalesce((F.abs(F.col(f"g{i}")) >= t) & (F.col(f"m{i}") >= 0), F.lit(False)).alias("transformed"))
        for i, c in enumerate(cols)]))


def log_skewed(df: DataFrame, cols: list[str], t: float = SKEW_LIMIT) -> tuple[DataFrame, DataFrame]:
    """Add ``c_log10 = log10(c + 1)`` for skewed columns without negatives; returns data and report."""
    report = skewed_columns(df, cols, t)
    chosen = [r["column"] for r in report.where("transformed").collect()]  # one row per column
    return df.withColumns({f"{c}_log10": F.log10(col(c) + 1) for c in chosen}) if chosen else df, report


def family_features(df: DataFrame, a: str, b: str) -> DataFrame:
    """FamilySize = a + b + 1 and IsAlone."""
    size = col(a) + col(b) + 1
    return df.withColumn("FamilySize", size).withColumn("IsAlone", F.coalesce((size == 1).cast("int"), F.lit(0)))


def panel_features(df: DataFrame, unit: str = "unidad", time: str = "anio", concentration: str = "hhi_fuentes",
                   cash_days: str = "dias_efectivo", rows_per_task: int | None = None) -> DataFrame:
    """Ratios, diversification, years of cash cover and yearly changes per unit; features whose
    inputs are absent are left out."""
    have = set(df.columns)
    out = df.withColumns({n: safe_divide(col(a), col(b)) for n, a, b in PANEL_RATIOS if {a, b} <= have})
    if concentration in have:
        out = out.withColumn("diversificacion_fuentes", 1.0 - col(concentration))
    if cash_days in have:
        out = out.withColumn("anios_cobertura_efectivo", col(cash_days) / DAYS_PER_YEAR)
    deltas = [(n, c) for n, c in PANEL_DELTAS if {unit, time, c} <= have]
    if deltas:
        out = in_order(out, [unit], [time], {f"__{n}": previous(col(c)) for n, c in deltas}, rows_per_task)
        out = out.withColumns({n: col(c) - F.col(f"__{n}") for n, c in deltas}).drop(*[f"__{n}" for n, _ in deltas])
    return out


def polynomial(df: DataFrame, cols: list[str], degree: int) -> tuple[DataFrame, list[str]]:
    """All monomials up to ``degree`` without the constant, named like ``a*a*b``."""
    names, exprs = [], []
    for d in range(1, degree + 1):
        for combo in combinations_with_replacement(cols, d):
            e = col(combo[0]).cast("double")
            for c in combo[1:]:
                e = e * col(c)
            name = "*".join(combo)
            names.append(name)
            exprs.append(e.alias(name))
    others = [c for c in df.columns if c not in cols]
    return df.select(*[col(c) for c in others], *exprs), names


def transform_all(df: DataFrame, numeric: list[str], categorical: list[str], family: tuple[str, str] | None = None) -> dict[str, DataFrame]:
    """Four variants of one input: base (with family and log features), one-hot, label, binary."""
    base = family_features(df, *family) if family else df
    base, report = log_skewed(base, numeric)
    label, binary = base, base
    for c in categorical:
        label = apply_label(label, c, fit_label(base, c))
        binary = apply_binary(binary, c, fit_binary(base, c))
    return {"base": base, "onehot": apply_onehot(base, fit_onehot(base, categorical)), "label": label,
            "binary": binary, "report": report}
