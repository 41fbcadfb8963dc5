"""k-means for many models at once: every K, restart and resample advances in the same pass over the rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import col, cut_lineage, kept

POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 20)]))  # chances of at most 0, 1, ... copies of a row in a resample


@dataclass
class Model:
    """One run: ``sample`` is the number of its resample, None for the rows as they are."""

    k: int
    seed: int
    sample: int | None = None
    centres: np.ndarray | None = None
    inertia: float | None = None
    rounds: int = 0
    settled: bool = field(default=False, repr=False)


def mixed(h: np.ndarray, *salts: int) -> np.ndarray:
    """Uniform numbers in (0, 1) from 64-bit hashes and whole numbers."""
    x = h.astype(np.uint64)
    for s in salts:
        x = x + np.uint64((s + 1) * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def weights_of(h: np.ndarray, w: np.ndarray, sample: int | None, seed: int) -> np.ndarray:
    """Weights of the rows in a resample: Poisson(1) copies each, the same ones for one key and seed."""
    return w if sample is None else w * np.searchsorted(POISSON, mixed(h, seed, sample), side="right")


def points(df: DataFrame, cols: list[str] | None, vec: str | None, key: str | None = None) -> DataFrame:
    """(h, w, x): vectors with a hash and a weight. Without a key, equal vectors become one with their count as its weight."""
    x = col(vec).cast("array<double>") if vec else F.array(*[col(c).cast("double") for c in cols])
    if key is not None:
        return df.select(F.xxhash64(col(key)).alias("h"), F.lit(1.0).alias("w"), x.alias("x"))
    return df.select(x.alias("x")).groupBy("x").agg(F.count(F.lit(1)).cast("double").alias("w")).select(F.xxhash64("x").alias("h"), "w", "x")


def _pass(rows: DataFrame, schema: str, fn: Callable[[Iterator[tuple]], dict]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            for b in batches:
                if b.num_rows:
                    x = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                    yield b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False), x
        out = fn(blocks())
        if out:
            yield pa.RecordBatch.from_pydict(out)
    return rows.mapInArrow(run, schema)


@contextmanager
def _packed(rows: DataFrame):
    """The rows persisted as (h, w, x) of 8-byte numbers, one record per Arrow batch: what a pass copies to Python and back is
    a few long strings instead of single numbers."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                parts = [b.column(0), b.column(1), b.column(2).flatten()]
                yield pa.RecordBatch.from_pydict({n: [p.to_numpy(zero_copy_only=False).tobytes()] for n, p in zip("hwx", parts)})
    with kept(rows) as held:
        packed = held.mapInArrow(pack, "h binary, w binary, x binary").persist()
        packed.count()
    try:
        yield packed
    finally:
        packed.unpersist()


def _packed_pass(packed: DataFrame, schema: str, fn: Callable[[Iterator[tuple]], dict]) -> DataFrame:
    """As ``_pass``, over the records of ``_packed``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            for b in batches:
                for h, w, x in zip(*b.columns):
                    w = np.frombuffer(w.as_buffer(), np.float64)
                    yield np.frombuffer(h.as_buffer(), np.int64), w, np.frombuffer(x.as_buffer(), np.float64).reshape(len(w), -1)
        out = fn(blocks())
        if out:
            yield pa.RecordBatch.from_pydict(out)
    return packed.mapInArrow(run, schema)


def _distances(x: np.ndarray, centres: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres, both moved by ``shift`` against cancellation."""
    a, b = x - shift, centres - shift
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0.0)


def _seed_centres(rows: DataFrame, models: list[Model], shift: np.ndarray, sample_seed: int) -> None:
    """k-means++ for all models: one pass per centre. A row wins with a chance proportional to its weight times its squared distance
    to the nearest centre so far: the smallest of -ln(u) / that, u being a hash of row, model and step."""
    for step in range(max(m.k for m in models)):
        active = [(i, m) for i, m in enumerate(models) if m.k > step]
        state = [(i, m.seed, m.sample, m.centres) for i, m in active]

        def race(blocks):
            best = {}
            for h, w, x in blocks:
                for i, seed, sample, centres in state:
                    mass = weights_of(h, w, sample, sample_seed)
                    if centres is not None:
                        mass = mass * _distances(x, centres, shift).min(1)
                    with np.errstate(divide="ignore"):
                        times = np.where(mass > 0, -np.log(mixed(h, seed, step, i)) / np.where(mass > 0, mass, 1), np.inf)
                    at = int(times.argmin())
                    if i not in best or times[at] < best[i][0]:
                        best[i] = float(times[at]), x[at].tolist()
            return best and {"model": list(best), "race": [r for r, _ in best.values()], "x": [v for _, v in best.values()]}

        won = _packed_pass(rows, "model long, race double, x array<double>", race).groupBy("model").agg(F.min(F.struct("race", "x")).alias("best"))
        for r in won.collect():  # one row per model
            m = models[r["model"]]
            new = np.array([r["best"]["x"]])
            m.centres = new if m.centres is None else np.vstack([m.centres, new])


def fit_many(rows: DataFrame, models: list[Model], max_iter: int = 300, tol: float = 1e-4, sample_seed: int = 0) -> list[Model]:
    """Run all models to their end on the rows of ``points``; models that have settled drop out.

    A round is one aggregate over the rows: sums per (model, cluster, coordinate), so only numbers of the size of the models
    reach the driver. A model has settled when its centres move by at most ``tol`` times the mean variance. A cluster without rows keeps
    its centre. The result does not depend on how the rows are split, but for the last digits of sums.
    """
    def moments(blocks):
        total = 0.0
        for _, w, x in blocks:
            total = total + np.stack([np.full(x.shape[1], w.sum()), w @ x, w @ (x * x)])
        return {"part": np.repeat(range(3), total.shape[1]), "pos": np.tile(range(total.shape[1]), 3), "value": total.ravel()} if np.ndim(total) else {}

    with _packed(rows) as held:
        stats = _packed_pass(held, "part long, pos long, value double", moments).groupBy("part", "pos").agg(F.sum("value").alias("value")).orderBy("part", "pos").collect()
        if not stats:
            return models
        n, sums, squares = np.array([r["value"] for r in stats]).reshape(3, -1)
        shift = sums / n
        limit = tol * float(np.mean(np.maximum(squares / n - shift ** 2, 0.0)))
        _seed_centres(held, models, shift, sample_seed)
        d = len(shift)
        while open_ := [(i, m) for i, m in enumerate(models) if m.inertia is None]:
            state = [(i, m.sample, m.centres, m.settled or m.rounds >= max_iter) for i, m in open_]

            def sums(blocks):
                total = {i: np.zeros((len(c), d + 2)) for i, _, c, _ in state}
                for h, w, x in blocks:
                    every = _distances(x, np.vstack([c for _, _, c, _ in state]), shift)
                    at = 0
                    for i, sample, centres, last in state:
                        near = every[:, at:at + len(centres)].argmin(1)
                        at += len(centres)
                        weight = weights_of(h, w, sample, sample_seed)
                        mine = np.zeros((len(centres), len(x)))
                        mine[near, np.arange(len(x))] = weight
                        total[i][:, 0] += mine.sum(1)
                        total[i][:, 2:] += mine @ x
                        if last:  # the inertia of a model is asked for once
                            gap = x - centres[near]
                            total[i][:, 1] += mine @ (gap * gap).sum(1)
                cells = [(i, c, j, v) for i, t in total.items() for (c, j), v in np.ndenumerate(t) if v]
                return cells and dict(zip(("model", "cluster", "part", "value"), map(list, zip(*cells))))

            summed = _packed_pass(held, "model long, cluster long, part long, value double", sums).groupBy("model", "cluster", "part").agg(F.sum("value").alias("value"))
            tables = {i: np.zeros((m.k, d + 2)) for i, m in open_}
            for r in summed.toPandas().itertuples():  # models x clusters x coordinates
                tables[r.model][r.cluster, r.part] = r.value
            for i, m in open_:
                t = tables[i]
                m.rounds += 1
                if m.settled or m.rounds > max_iter:
                    m.inertia = float(t[:, 1].sum())
                    continue
                new = np.where(t[:, :1] > 0, t[:, 2:] / np.where(t[:, :1] > 0, t[:, :1], 1), m.centres)
                m.settled = float(((new - m.centres) ** 2).sum()) <= limit
                m.centres = new
    return models


def best_of(models: list[Model]) -> dict:
    """The model of least inertia for each (k, sample); the earlier seed of equal ones."""
    out = {}
    for m in models:
        if m.inertia is not None and ((m.k, m.sample) not in out or m.inertia < out[m.k, m.sample].inertia):
            out[m.k, m.sample] = m
    return out


def resample_agreement(rows: DataFrame, reference: Model, models: list[Model], sample_seed: int = 0) -> DataFrame:
    """(sample, ari): agreement of each resample's clustering with the reference on the rows of the resample.

    Contingency counts of all resamples come from one pass; the index from one aggregate over them."""
    state = [(m.sample, m.centres) for m in models]

    def cells(blocks):
        total = {}
        for h, w, x in blocks:
            ref = _distances(x, reference.centres, x.mean(0)).argmin(1)
            for sample, centres in state:
                new = _distances(x, centres, x.mean(0)).argmin(1)
                n = np.bincount(ref * len(centres) + new, weights_of(h, w, sample, sample_seed), len(reference.centres) * len(centres))
                total[sample] = total.get(sample, 0) + n
        found = [(s, c // len(reference.centres), c, v) for s, t in total.items() for c, v in enumerate(t) if v]
        k = {s: len(c) for s, c in state}
        found = [(s, c // k[s], c % k[s], v) for s, _, c, v in found]
        return found and dict(zip(("sample", "a", "b", "n"), map(list, zip(*found))))

    n = cut_lineage(_pass(rows, "sample long, a long, b long, n double", cells).groupBy("sample", "a", "b").agg(F.sum("n").alias("n")))
    pairs = lambda side: n.groupBy("sample", *side).agg(F.sum("n").alias("n")).groupBy("sample").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("_".join(["p", *side])))
    both = pairs(["a", "b"]).join(pairs(["a"]), "sample").join(pairs(["b"]), "sample").join(pairs([]), "sample")
    expected, top = F.try_divide(F.col("p_a") * F.col("p_b"), F.col("p")), (F.col("p_a") + F.col("p_b")) / 2
    return both.select("sample", F.coalesce(F.try_divide(F.col("p_a_b") - expected, top - expected), F.lit(1.0)).alias("ari"))


def squared_silhouettes(rows: DataFrame, models: list[Model]) -> list[float | None]:
    """Mean silhouette by squared distances of every model's clustering, in two passes: sums per cluster, then every row's mean distances
    from them. Null unless rows fall into 2 to n - 1 clusters."""
    state = [m.centres for m in models]
    if not state:
        return []
    shift, d = state[0].mean(0), state[0].shape[1]

    def sums(blocks):
        total = [np.zeros((len(c), d + 2)) for c in state]
        for _, w, x in blocks:
            moved = x - shift
            for t, c in zip(total, state):
                near = _distances(x, c, shift).argmin(1)
                parts = [w, w * (moved * moved).sum(1), *(w * moved[:, j] for j in range(d))]
                t += np.column_stack([np.bincount(near, p, len(c)) for p in parts])
        cells = [(i, c, j, v) for i, t in enumerate(total) for (c, j), v in np.ndenumerate(t) if v]
        return cells and dict(zip(("model", "cluster", "part", "value"), map(list, zip(*cells))))

    tables = [np.zeros((len(c), d + 2)) for c in state]
    summed = _pass(rows, "model long, cluster long, part long, value double", sums).groupBy("model", "cluster", "part").agg(F.sum("value").alias("value"))
    for r in summed.toPandas().itertuples():  # models x clusters x coordinates
        tables[r.model][r.cluster, r.part] = r.value

    def values(blocks):
        total = np.zeros(len(state))
        for _, w, x in blocks:
            moved = x - shift
            for i, (t, c) in enumerate(zip(tables, state)):
                n = t[:, 0]
                near = _distances(x, c, shift).argmin(1)
                all_ = np.maximum(n * (moved * moved).sum(1)[:, None] - 2 * moved @ t[:, 2:].T + t[:, 1], 0)
                at = np.arange(len(x))
                inner = all_[at, near] / np.maximum(n[near] - 1, 1)
                outer = np.where(n > 0, all_ / np.where(n > 0, n, 1), np.inf)
                outer[at, near] = np.inf
                outer = outer.min(1)
                top = np.maximum(inner, outer)
                total[i] += (w * np.where((n[near] > 1) & (top > 0) & np.isfinite(top), (outer - inner) / np.where(top > 0, top, 1), 0)).sum()
        return {"model": list(range(len(state))), "value": total.tolist()}

    means = {r["model"]: r["value"] for r in _pass(rows, "model long, value double", values).groupBy("model").agg(F.sum("value").alias("value")).collect()}
    return [float(means[i] / t[:, 0].sum()) if 1 < (t[:, 0] > 0).sum() < t[:, 0].sum() else None for i, t in enumerate(tables)]
