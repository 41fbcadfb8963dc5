"""Random searches over polynomial models from sufficient statistics: every draw and fold in the same passes over the rows."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import col, kept

MODELS_AT_ONCE = 400  # logistic models of one pass, each with a matrix of its terms squared
ROWS_AT_ONCE = 1_000  # whose products of two terms are held together
LASSO_SWEEPS, LASSO_TOL = 1_000, 1e-9
NEWTON_ROUNDS, NEWTON_TOL = 60, 1e-8


def monomials(n_cols: int, degree: int) -> list[tuple[int, ...]]:
    """Factors of each term, lower degrees first: the terms of a degree are a prefix of those of a higher one."""
    return [c for d in range(1, degree + 1) for c in combinations_with_replacement(range(n_cols), d)]


def expand(x: np.ndarray, terms: list[tuple[int, ...]]) -> np.ndarray:
    """One column per term; each is the term without its last factor times that factor."""
    out, place = np.empty((len(x), len(terms))), {}
    for i, t in enumerate(terms):
        out[:, i] = x[:, t[-1]] if len(t) == 1 else out[:, place[t[:-1]]] * x[:, t[-1]]
        place[t] = i
    return out


def _per_partition(rows: DataFrame, fn: Callable[[Iterator[tuple]], list[tuple[int, np.ndarray]]]) -> dict[int, np.ndarray]:
    """Sum of the arrays that each partition gives per number. They have the size of models, not of the data."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            for b in batches:
                if b.num_rows:
                    yield (b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False),
                           b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1))
        made = fn(blocks())
        if made:
            yield pa.RecordBatch.from_pydict({"id": [i for i, _ in made], "part": [a.astype(np.float64).tobytes() for _, a in made]})

    def total(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(p, np.float64) for p in group.column("part").to_pylist()]
        return pa.table({"id": group.column("id")[:1], "part": pa.array([np.sum(parts, axis=0).tobytes()], pa.binary())})

    out = rows.mapInArrow(run, "id long, part binary").groupBy("id").applyInArrow(total, "id long, part binary").collect()
    return {r["id"]: np.frombuffer(r["part"], np.float64) for r in out}


def fold_moments(rows: DataFrame, terms: list[tuple[int, ...]], scale: np.ndarray) -> dict[int, np.ndarray]:
    """Per fold the matrix Z'Z of Z = (1, terms, label), in one pass."""
    size = len(terms) + 2

    def moments(blocks):
        out = {}
        for fold, y, x in blocks:
            z = np.column_stack([np.ones(len(y)), expand(x / scale, terms), y])
            for f in np.unique(fold):
                part = z[fold == f]
                out[int(f)] = out.get(int(f), 0) + part.T @ part
        return [(f, m.ravel()) for f, m in out.items()]
    return {f: m.reshape(size, size) for f, m in _per_partition(rows, moments).items()}


class Standard:
    """Standardised normal equations of all folds but one, for the first ``p`` terms."""

    def __init__(self, moments: np.ndarray, p: int):
        use = [*range(p + 1), moments.shape[0] - 1]
        g = moments[np.ix_(use, use)]
        self.use, self.n, self.mean = use, g[0, 0], g[0, 1:] / g[0, 0]
        centred = g[1:, 1:] - self.n * np.outer(self.mean, self.mean)
        spread = np.sqrt(np.maximum(np.diag(centred)[:-1], 0) / self.n)
        self.spread = np.where(spread > 1e-12 * np.maximum(1e-300, np.abs(self.mean[:-1])), spread, 1.0)
        self.a, self.b = centred[:-1, :-1] / np.outer(self.spread, self.spread), centred[:-1, -1] / self.spread

    def r2(self, held: np.ndarray, w: np.ndarray) -> float:
        """R2 of the coefficients ``w`` of the standardised terms on a held-out fold, from that fold's moments."""
        h = held[np.ix_(self.use, self.use)]
        n, sums = h[0, 0], h[0, 1:]
        about = h[1:, 1:] - np.outer(sums, self.mean) - np.outer(self.mean, sums) + n * np.outer(self.mean, self.mean)
        v = np.append(-w / self.spread, 1.0)
        total = h[-1, -1] - sums[-1] ** 2 / n
        return float(1 - v @ about @ v / total) if total > 0 else float("nan")


def ridge_weights(s: Standard, alphas: list[float]) -> np.ndarray:
    """(A + alpha I) w = b for every alpha, from one eigendecomposition."""
    values, vectors = np.linalg.eigh(s.a)
    turned = vectors.T @ s.b
    return np.array([vectors @ (turned / (np.maximum(values, 0) + alpha)) for alpha in alphas])


def lasso_weights(s: Standard, alphas: list[float]) -> np.ndarray:
    """Least ||y - Xw||^2 / 2n + alpha |w|, by coordinate descent over all alphas at once."""
    a, b, alpha = s.a / s.n, s.b / s.n, np.array(alphas)
    w = np.zeros((len(b), len(alphas)))
    aw = np.zeros_like(w)
    diagonal = np.diag(a)
    for _ in range(LASSO_SWEEPS):
        moved = 0.0
        for j in range(len(b)):
            if diagonal[j] <= 0:
                continue
            rest = b[j] - aw[j] + diagonal[j] * w[j]
            new = np.sign(rest) * np.maximum(np.abs(rest) - alpha, 0) / diagonal[j]
            change = new - w[j]
            if change.any():
                aw += np.outer(a[:, j], change)
                w[j] = new
                moved = max(moved, float(np.abs(change).max()))
        if moved <= LASSO_TOL * max(1.0, float(np.abs(w).max())):
            break
    return w.T


def _alike(fits: list[tuple[int, Standard, float]], numbers: list[int], theta: list[np.ndarray]) -> list[tuple]:
    """Models that leave out the same fold and have the same terms: (fold, mean, spread, numbers, weights as columns)."""
    groups: dict[tuple, list[int]] = {}
    for i in numbers:
        groups.setdefault((fits[i][0], id(fits[i][1])), []).append(i)
    return [(fits[g[0]][0], fits[g[0]][1].mean[:-1], fits[g[0]][1].spread, g, np.column_stack([theta[i] for i in g])) for g in groups.values()]


def _standardised(whole: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """A line of ones and one of each standardised term."""
    z = np.empty((len(mean) + 1, len(whole)))
    z[0] = 1.0
    z[1:] = whole[:, :len(mean)].T
    z[1:] -= mean[:, None]
    z[1:] /= spread[:, None]
    return z


def _curves(z: np.ndarray, weight: np.ndarray) -> Iterator[np.ndarray]:
    """z diag(w) z' for every line w of ``weight``. From three models on, the products of two lines of z are made once for all."""
    if len(weight) < 3:
        yield from ((z * w) @ z.T for w in weight)
        return
    p = len(z)
    starts = np.cumsum([0, *range(p, 0, -1)])
    products = np.empty((starts[-1], z.shape[1]))
    for i in range(p):
        np.multiply(z[i], z[i:], out=products[starts[i]:starts[i + 1]])
    i, j = np.triu_indices(p)
    for line in weight @ products.T:
        full = np.empty((p, p))
        full[i, j] = full[j, i] = line
        yield full


def logistic_weights(rows: DataFrame, terms: list[tuple[int, ...]], scale: np.ndarray, fits: list[tuple[int, Standard, float]]) -> list[np.ndarray]:
    """Least |w|^2 / 2 + C times the log loss, intercept free, for all (fold left out, standard, C) at once by Newton rounds.

    Each round is one pass: loss, gradient and curvature of every model that has not settled. A step that does not lower the loss is halved.
    Models of the same terms and folds share their matrix and its products of two columns, so a round costs them two matrix products.
    """
    sizes = [len(s.b) + 1 for _, s, _ in fits]
    theta = [np.zeros(p) for p in sizes]
    step, loss, open_ = [None] * len(fits), [np.inf] * len(fits), set(range(len(fits)))
    for _ in range(NEWTON_ROUNDS):
        state = _alike(fits, sorted(open_), theta)

        def curvature(blocks):
            out = {}
            for fold, y, x in blocks:
                for at in range(0, len(y), ROWS_AT_ONCE):
                    part = slice(at, at + ROWS_AT_ONCE)
                    whole = expand(x[part] / scale, terms)
                    for left_out, mean, spread, numbers, weights in state:
                        use = fold[part] != left_out
                        z, target = _standardised(whole[use], mean, spread), y[part][use]
                        eta = weights.T @ z
                        small = np.exp(-np.abs(eta))
                        chance = np.where(eta >= 0, 1.0, small)
                        small += 1.0
                        chance /= small
                        losses = np.maximum(eta, 0.0).sum(1) + np.log(small.prod(1)) - eta @ target  # at most 2 ** ROWS_AT_ONCE
                        gradients = (chance - target) @ z.T
                        for k, (number, full) in enumerate(zip(numbers, _curves(z, chance * (1.0 - chance)))):
                            found = np.concatenate([losses[k:k + 1], gradients[k], full.ravel()])
                            if number in out:
                                out[number] += found
                            else:
                                out[number] = found
            return list(out.items())

        for i, found in _per_partition(rows, curvature).items():
            p, c = sizes[i], fits[i][2]
            penalty = np.append(0.0, theta[i][1:])
            now = c * found[0] + 0.5 * float(penalty @ penalty)
            if now > loss[i] * (1 + 1e-12) + 1e-300 and step[i] is not None and np.abs(step[i]).max() > 1e-12:
                step[i] = step[i] / 2
                theta[i] = theta[i] - step[i]
                continue
            gradient = c * found[1:p + 1] + penalty
            curved = c * found[p + 1:].reshape(p, p) + np.diag(np.append(1e-12, np.ones(p - 1)))
            done = np.abs(gradient).max() <= NEWTON_TOL * (1 + c) or loss[i] - now <= 1e-12 * abs(now)
            loss[i] = now
            if done:
                open_.discard(i)
                continue
            step[i] = -np.linalg.solve(curved, gradient)
            theta[i] = theta[i] + step[i]
        if not open_:
            break
    return theta


def accuracies(rows: DataFrame, terms: list[tuple[int, ...]], scale: np.ndarray, fits: list[tuple[int, Standard, float]], theta: list[np.ndarray]) -> np.ndarray:
    """Share of right classes of each model on the fold it did not see, in one pass."""
    state = _alike(fits, list(range(len(fits))), theta)

    def hits(blocks):
        out = np.zeros((len(fits), 2))
        for fold, y, x in blocks:
            whole = expand(x / scale, terms)
            for f, mean, spread, numbers, weights in state:
                mine = fold == f
                if mine.any():
                    right = (weights.T @ _standardised(whole[mine], mean, spread) > 0) == (y[mine] > 0.5)
                    out[numbers] += np.column_stack([right.sum(1), np.full(len(numbers), right.shape[1])])
        return [(0, out.ravel())]
    counts = _per_partition(rows, hits)[0].reshape(-1, 2)
    return counts[:, 0] / counts[:, 1]


def random_polynomial_search(folded: DataFrame, cols: list[str], label: str, drawn: list[tuple[int, float]], kind: str, folds: int) -> DataFrame:
    """(degree, strength, mean_score) of every draw on rows with ``fold``: R2 for ``ridge`` and ``lasso``, accuracy for ``logistic``.

    Terms are standardised on the folds a model is fitted on. Ridge and lasso take one pass over the rows in all: each fold's moments are summed
    once, folds are left out by subtraction, and held-out scores come from moments too. Logistic models share their passes. Rows with a missing
    value are left out.
    """
    spark, top = folded.sparkSession, max(d for d, _ in drawn)
    terms = monomials(len(cols), top)
    size_of = {d: len(monomials(len(cols), d)) for d in {d for d, _ in drawn}}
    ready = folded.select("fold", col(label).cast("double").alias("y"), F.array(*[col(c).cast("double") for c in cols]).alias("x")) \
        .where(F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull()))
    with kept(ready) as rows:
        bounds = rows.agg(*[F.max(F.abs(F.col("x")[i])) for i in range(len(cols))]).first()
        scale = np.array([b if b else 1.0 for b in bounds], dtype=float)  # powers stay within 1
        moments = fold_moments(rows, terms, scale)
        whole = sum(moments.values())
        standard = {(d, f): Standard(whole - moments[f], p) for d, p in size_of.items() for f in range(folds)}
        scores = np.empty((len(drawn), folds))
        if kind == "logistic":
            jobs = [(i, f) for i in range(len(drawn)) for f in range(folds)]
            for at in range(0, len(jobs), MODELS_AT_ONCE):
                part = jobs[at:at + MODELS_AT_ONCE]
                fits = [(f, standard[drawn[i][0], f], drawn[i][1]) for i, f in part]
                for (i, f), score in zip(part, accuracies(rows, terms, scale, fits, logistic_weights(rows, terms, scale, fits))):
                    scores[i, f] = score
        else:
            solve = {"ridge": ridge_weights, "lasso": lasso_weights}[kind]
            for (d, f), s in standard.items():
                mine = [i for i, (degree, _) in enumerate(drawn) if degree == d]
                for i, w in zip(mine, solve(s, [drawn[i][1] for i in mine])):
                    scores[i, f] = s.r2(moments[f], w)
    table = [(d, float(a), float(m)) for (d, a), m in zip(drawn, scores.mean(axis=1))]
    return spark.createDataFrame(table, "degree int, strength double, mean_score double").orderBy(F.desc("mean_score"), "degree", "strength")


def log_uniform(rng: random.Random, low: float, high: float) -> float:
    return float(np.exp(rng.uniform(np.log(low), np.log(high))))
