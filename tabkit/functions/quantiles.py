"""Exact order statistics and interpolated quantiles at any row count.

``percentile`` keeps every distinct value in one task, which is right while that number is
known to be small. Beyond that the wanted ranks are bracketed with mergeable quantile
sketches, the bracket is checked with exact counts and narrowed until the few values left
inside it fit. Every pass is one aggregate without a row shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import col, q

VALUES_PER_TASK = 200_000
VALUES_PER_PASS = 1_000_000  # over all columns of one aggregate
SKETCH_ACCURACY = 10_000
CUTS_PER_PASS = 45  # two counts each: Spark compiles aggregates of up to 100 fields


@dataclass
class _Bracket:
    """Open interval (low, high) that holds the wanted ranks; ``base`` rows lie at or below low."""

    name: str
    ranks: list[int]
    inside: int
    low: float | None = None
    high: float | None = None
    base: int = 0
    slack: float = 4.0 / SKETCH_ACCURACY
    found: dict[int, float] = field(default_factory=dict)

    def value(self) -> Column:
        c = col(self.name).cast("double")
        if self.low is None:
            return c
        return F.when((c > F.lit(self.low)) & (c < F.lit(self.high)), c)

    def open_ranks(self) -> list[int]:
        return [r for r in self.ranks if r not in self.found]


def order_statistics(df: DataFrame, wanted: dict[str, list[int]], counts: dict[str, int],
                     limit: int | None = None) -> dict[str, dict[int, float]]:
    """Value at each 0-based rank of each numeric column (nulls left out)."""
    limit = limit or VALUES_PER_TASK
    brackets = [_Bracket(c, near, counts[c]) for c, ranks in wanted.items() for near in _neighbours(ranks)]
    while True:
        large = [b for b in brackets if b.open_ranks() and b.inside > limit]
        if not large:
            break
        _narrow(df, large)
    _read_off(df, [b for b in brackets if b.open_ranks()])
    out: dict[str, dict[int, float]] = {c: {} for c in wanted}
    for b in brackets:
        out[b.name].update(b.found)
    return out


def _neighbours(ranks: list[int]) -> list[list[int]]:
    """Sorted ranks with direct neighbours kept together."""
    groups: list[list[int]] = []
    for r in sorted(set(ranks)):
        if groups and r - groups[-1][-1] == 1 and len(groups[-1]) < 2:
            groups[-1].append(r)
        else:
            groups.append([r])
    return groups


def _read_off(df: DataFrame, brackets: list[_Bracket]) -> None:
    """The few values left in each bracket, sorted; only the wanted ones leave Spark."""
    same: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        same.setdefault((b.name, b.low, b.high), []).append(b)
    groups = list(same.values())
    while groups:
        part, total = [], 0
        while groups and len(part) < 100 and (not part or total + groups[0][0].inside <= VALUES_PER_PASS):
            total += groups[0][0].inside
            part.append(groups.pop(0))
        sorted_values = df.agg(*[F.sort_array(F.collect_list(g[0].value())).alias(f"v{i}") for i, g in enumerate(part)])
        picks = [(b, r, i) for i, g in enumerate(part) for b in g for r in b.open_ranks()]
        row = sorted_values.select(*[F.get(f"v{i}", F.lit(r - b.base)) for b, r, i in picks]).first()
        for (b, r, _), v in zip(picks, row):
            b.found[r] = v


def _narrow(df: DataFrame, brackets: list[_Bracket]) -> None:
    same: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        same.setdefault((b.name, b.low, b.high), []).append(b)
    groups = list(same.values())
    sketches = df.agg(*[F.percentile_approx(g[0].value(), [p for b in g for p in _fractions(b)], SKETCH_ACCURACY) for g in groups]).first()
    tried = [(b, values[2 * i], values[2 * i + 1]) for g, values in zip(groups, sketches) for i, b in enumerate(g)]
    cuts = sorted({(b.name, v) for b, low, high in tried for v in (low, high)})
    below_of, at_of = {}, {}
    for at in range(0, len(cuts), CUTS_PER_PASS):
        part = cuts[at:at + CUTS_PER_PASS]
        row = df.agg(*[e for n, v in part for e in (F.count_if(col(n) < v), F.count_if(col(n) == v))]).first()
        for i, cut in enumerate(part):
            below_of[cut], at_of[cut] = row[2 * i], row[2 * i + 1]
    for b, low, high in tried:
        below, at_low = below_of[b.name, low], at_of[b.name, low]
        inside, at_high = below_of[b.name, high] - below - at_low, at_of[b.name, high]
        for r in b.open_ranks():
            if below <= r < below + at_low:
                b.found[r] = low
            elif low != high and below + at_low + inside <= r < below + at_low + inside + at_high:
                b.found[r] = high
        rest = b.open_ranks()
        if not rest:
            continue
        if below + at_low <= rest[0] and rest[-1] < below + at_low + inside:
            b.low, b.high, b.base, b.inside = low, high, below + at_low, inside
        else:
            b.slack *= 4  # the sketch missed the rank: look wider in the next pass


def _fractions(b: _Bracket) -> tuple[float, float]:
    first, last = b.open_ranks()[0], b.open_ranks()[-1]
    return (max(0.0, (first - b.base) / b.inside - b.slack), min(1.0, (last - b.base + 1) / b.inside + b.slack))


def quantile_columns(df: DataFrame, cols: list[str], probs: list[float],
                     limit: int | None = None) -> dict[str, Column]:
    """Per column an ``array<double>`` of linear-interpolated quantiles, for use in ``df.agg``.

    An aggregate where the size check allows it, otherwise the values found by narrowing.
    """
    cap = limit or max(20_000, min(VALUES_PER_TASK, VALUES_PER_PASS // max(1, len(cols))))
    counts = dict(zip(cols, df.agg(*[F.count(col(c)) for c in cols]).first()))
    out = {c: F.expr(f"percentile({q(c)}, array({', '.join(f'{p!r}D' for p in probs)}))")
           for c in cols if counts[c] <= cap}
    large = [c for c in cols if counts[c] > cap]
    if large:
        for c, values in _narrowed_quantiles(df, large, probs, counts, limit).items():
            out[c] = F.array(*[F.lit(v) for v in values])
    return out


def _narrowed_quantiles(df, cols, probs, counts, limit) -> dict[str, list[float]]:
    at = {c: [p * (counts[c] - 1) for p in probs] for c in cols}
    ranks = {c: [r for x in at[c] for r in (math.floor(x), math.ceil(x))] for c in cols}
    stats = order_statistics(df, ranks, counts, limit)
    out = {}
    for c in cols:
        out[c] = []
        for x in at[c]:
            lo, hi = math.floor(x), math.ceil(x)
            low, high = stats[c][lo], stats[c][hi]
            out[c].append(low if lo == hi or low == high else (hi - x) * low + (x - lo) * high)
    return out


def quantiles(df: DataFrame, cols: list[str], probs: list[float],
              limit: int | None = None) -> dict[str, list[float] | None]:
    """Quantile values on the driver: ``len(cols) * len(probs)`` numbers."""
    if not cols:
        return {}
    exprs = quantile_columns(df, cols, probs, limit)
    row = df.agg(*[exprs[c] for c in cols]).first()
    return {c: (list(v) if v is not None else None) for c, v in zip(cols, row)}


def grouped_quantiles(df: DataFrame, by: list[str], cols: list[str], probs: list[float],
                      limit: int | None = None) -> DataFrame:
    """One row per group with an array column per input column. Groups too large for one
    task are solved one by one through narrowing; all others share one aggregate."""
    cap = limit or VALUES_PER_TASK
    keys = [col(b) for b in by]
    big = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > cap)
           .select(*keys).collect())
    probs_sql = ", ".join(f"{p!r}D" for p in probs)
    exprs = [F.expr(f"percentile({q(c)}, array({probs_sql}))").alias(c) for c in cols]
    if not big:
        return df.groupBy(*keys).agg(*exprs)

    def is_group(row):
        cond = F.lit(True)
        for b in by:
            cond = cond & col(b).eqNullSafe(F.lit(row[b]))
        return cond

    small = df
    for row in big:
        small = small.where(~is_group(row))
    out = small.groupBy(*keys).agg(*exprs)
    for row in big:
        one = df.where(is_group(row))
        found = quantile_columns(one, cols, probs, limit)
        out = out.unionByName(one.groupBy(*keys).agg(*[found[c].alias(c) for c in cols]))
    return out
