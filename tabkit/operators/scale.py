"""Scalers and the column-wise preprocessor: fitted once, applied as plain projections."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import quantiles
from ..functions.runtime import col
from .encode import apply_onehot, fit_onehot
from .impute import apply_impute, fit_impute
from .params import Params


def fit_scaler(df: DataFrame, cols: list[str], kind: str = "standard", limit: int | None = None) -> Params:
    """Centre and scale per column. ``standard`` (std with n), ``minmax`` or ``robust`` (median, IQR).
    A zero scale is read as 1."""
    if not cols:
        return Params({})
    if kind == "robust":
        found = quantiles(df, cols, [0.25, 0.5, 0.75], limit)
        pairs = [(v[1], v[2] - v[0]) if v and v[0] is not None else (None, None) for v in (found[c] for c in cols)]
    elif kind == "standard":
        row = df.agg(*[e for c in cols for e in (F.avg(col(c)), F.stddev_pop(col(c)))]).first()
        pairs = [(row[2 * i], row[2 * i + 1]) for i in range(len(cols))]
    elif kind == "minmax":
        row = df.agg(*[e for c in cols for e in (F.min(col(c)).cast("double"), F.max(col(c)).cast("double"))]).first()
        pairs = [(lo, hi - lo if lo is not None else None)
                 for lo, hi in ((row[2 * i], row[2 * i + 1]) for i in range(len(cols)))]
    else:
        raise ValueError(f"unknown scaler {kind}")
    return Params({c: {"center": a, "scale": (b if b else 1.0) if a is not None else None} for c, (a, b) in zip(cols, pairs)})


def apply_scaler(df: DataFrame, params: Params) -> DataFrame:
    out = {c: (col(c) - F.lit(p["center"])) / F.lit(p["scale"])
           for c, p in params.values.items() if c in df.columns and p["center"] is not None}
    return df.withColumns(out) if out else df


@dataclass(frozen=True)
class Preprocessor:
    """Numeric: impute then scale. Categorical: impute then one-hot. Others pass through."""

    numeric_fill: Params
    scaler: Params
    category_fill: Params
    onehot: Params
    drop_first: bool = False
    passthrough: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        numeric, text = list(self.numeric_fill.values), list(self.category_fill.values)
        kept = df.select(*[col(c) for c in [*self.passthrough, *numeric, *text]])
        filled = apply_impute(apply_impute(kept, self.numeric_fill), self.category_fill)
        return apply_onehot(apply_scaler(filled, self.scaler), self.onehot, self.drop_first)


def fit_preprocessor(train: DataFrame, numeric: list[str], categorical: list[str], passthrough: list[str] = (),
                     fill: str = "median", scaler: str | None = "robust", drop_first: bool = False,
                     limit: int | None = None) -> Preprocessor:
    """Everything is learned from ``train`` only."""
    fills = fit_impute(train, numeric, fill, limit)
    cats = fit_impute(train, categorical, "mode")
    ready = apply_impute(apply_impute(train, fills), cats)
    scale = fit_scaler(ready, numeric, scaler, limit) if scaler else Params({})
    return Preprocessor(fills, scale, cats, fit_onehot(ready, categorical), drop_first, list(passthrough))
