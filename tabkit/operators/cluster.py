"""Clustering: k-means, DBSCAN, single linkage, fuzzy c-means, subtractive; choice and stability."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import in_order, row_number
from ..functions.quantiles import quantiles
from ..functions.runtime import all_of, col, cut_lineage, kept, unit_position
from .agreement import ari
from .lloyd import Model, best_of, fit_many, points, resample_agreement, squared_silhouettes
from .neighbors import (
    Piece, _matrix, as_points, choose_pivots, compare_blocks, components, distinct_points, k_distance,
    neighbour_counts, places, square_distances, summed, within,
)
from .split import bootstrap

# Default parameters of the algorithms.
EPS_QUANTILE, EPS_FALLBACK = 0.9, 0.7
FUZZY_M, FUZZY_ERROR, FUZZY_ROUNDS = 2.0, 0.005, 1_000
SUBTRACTIVE_RA, SUBTRACTIVE_RB = 2.2, 3.3
ACCEPT_RATIO, REJECT_RATIO, MAX_CENTRES = 0.5, 0.22, 50
SCORE_SILHOUETTE, SCORE_BALANCE, SCORE_NOISE = 0.6, 0.3, 0.1

GRID_DIMS, CELL_SAMPLE = 3, 64  # columns up to which a grid tells what is near; core rows of a cell that are compared first
KERNEL_ROUNDING = 1e-16  # of the whole sum of kernels, may be left out


def _runs(ks: list[int], n_init: int, seed: int) -> list[Model]:
    return [Model(k, seed + i) for k in ks for i in range(n_init)]


def kmeans(df: DataFrame, k: int, cols: list[str] | None = None, vec: str | None = None, n_init: int = 10,
           seed: int = 0, max_iter: int = 300, tol: float = 1e-4, out: str = "cluster"):
    """Best of ``n_init`` seeded runs by inertia. Returns (rows with label, centres, inertia)."""
    best = best_of(fit_many(points(df, cols, vec), _runs([k], n_init, seed), max_iter, tol))[k, None]
    centres = [list(map(float, c)) for c in best.centres]
    return assign_nearest(df, centres, cols, vec, out), centres, best.inertia


def assign_nearest(df: DataFrame, centres: list[list[float]], cols: list[str] | None = None, vec: str | None = None,
                   out: str = "cluster") -> DataFrame:
    """Nearest centre (first on ties) by squared distance, as one projection."""
    x = [col(c).cast("double") for c in cols] if cols else None
    if x is not None:
        d2 = [sum(((a - F.lit(float(v))) * (a - F.lit(float(v))) for a, v in zip(x, c)), F.lit(0.0)) for c in centres]
    else:
        d2 = [F.aggregate(F.zip_with(col(vec).cast("array<double>"), F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)),
                          F.lit(0.0), lambda s, v: s + v) for c in centres]
    return df.withColumn(out, (F.array_position(F.array(*d2), F.array_min(F.array(*d2))) - 1).cast("int"))


def lloyd_step(df: DataFrame, centres: list[list[float]], cols: list[str]) -> DataFrame:
    """One k-means update: size, inertia and new centre per cluster."""
    rows = assign_nearest(df, centres, cols)
    d2 = F.lit(None).cast("double")
    for i, c in enumerate(centres):
        own = sum(((col(n) - F.lit(float(v))) * (col(n) - F.lit(float(v))) for n, v in zip(cols, c)), F.lit(0.0))
        d2 = F.when(F.col("cluster") == i, own).otherwise(d2)
    return rows.withColumn("__d2", d2).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum("__d2").alias("inertia"), *[F.avg(col(c)).alias(f"center_{c}") for c in cols])


def elbow(df: DataFrame, ks: list[int], cols: list[str] | None = None, vec: str | None = None, n_init: int = 20,
          seed: int = 0) -> DataFrame:
    """Inertia per K, all K and restarts in the same passes."""
    best = best_of(fit_many(points(df, cols, vec), _runs(ks, n_init, seed)))
    return df.sparkSession.createDataFrame([(k, best[k, None].inertia) for k in ks if (k, None) in best], "k int, inertia double")


def best_k(df: DataFrame, key: str, ks: list[int], cols: list[str] | None = None, vec: str | None = None,
           n_init: int = 20, seed: int = 0, metric: str = "euclidean") -> DataFrame:
    """(k, inertia, silhouette) with the first best K marked."""
    from .quality import silhouette
    vectors = cut_lineage(points(df, cols, vec))
    best = best_of(fit_many(vectors, _runs(ks, n_init, seed)))
    found = [best[k, None] for k in ks if (k, None) in best]
    if metric == "squared":
        scores = squared_silhouettes(vectors, found)
    else:
        scores = [silhouette(assign_nearest(df, m.centres.tolist(), cols, vec), key, "cluster", cols, vec, metric=metric).first()["silhouette"] for m in found]
    rows = [(m.k, m.inertia, s) for m, s in zip(found, scores, strict=True)]
    top = max((r for r in rows if r[2] is not None), key=lambda r: (r[2], -r[0]), default=(None,))[0]
    return df.sparkSession.createDataFrame([(*r, r[0] == top) for r in rows], "k int, inertia double, silhouette double, best boolean")


def kmeans_stability(df: DataFrame, key: str, k: int, cols: list[str] | None = None, vec: str | None = None, b: int = 20, n_init: int = 10,
                     seed: int = 0) -> DataFrame:
    """Mean and std (n) of the ARI between k-means on all rows and on ``b`` resamples, all fitted together.

    A resample holds each row Poisson(1) times, as in ``bootstrap``; keys should be unique.
    """
    rows = cut_lineage(points(df, cols, vec, key))
    runs = _runs([k], n_init, seed) + [Model(k, seed + i, s) for s in range(b) for i in range(n_init)]
    best = best_of(fit_many(rows, runs, sample_seed=seed))
    scores = resample_agreement(rows, best[k, None], [best[k, s] for s in range(b)], seed)
    return scores.agg(F.avg("ari").alias("mean_ari"), F.stddev_pop("ari").alias("std_ari"), F.count(F.lit(1)).alias("n_samples"))


# density -------------------------------------------------------------------------------

def dbscan(df: DataFrame, key: str, eps: float, min_samples: int, cols: list[str] | None = None, vec: str | None = None,
           out: str = "cluster", rows_per_pivot: int | None = None, block: int | None = None) -> DataFrame:
    """(key, cluster): a core row has ``min_samples`` rows within eps, itself included; clusters are
    the connected core rows, numbered by their smallest core key; a border row takes the smallest
    cluster it touches; all others are -1."""
    labels = density_labels(df, key, [eps], min_samples, cols, vec, rows_per_pivot, block)
    return labels.select(key, F.col("cluster").alias(out))


def density_labels(df: DataFrame, key: str, radii: list[float], min_samples: int, cols: list[str] | None = None,
                   vec: str | None = None, rows_per_pivot: int | None = None, block: int | None = None) -> DataFrame:
    """(key, radius, cluster) for several radii. Blocks that cover the largest radius cover all,
    so the rows are compared once for the counts and once for the links."""
    points = as_points(df, key, cols, vec)
    single = cut_lineage(distinct_points(points))
    found = _grid_density(single, len(cols), radii[0], min_samples, rows_per_pivot, block) if cols and len(cols) <= GRID_DIMS and len(radii) == 1 else None
    cores, touched = found or _pair_density(single, radii, min_samples, rows_per_pivot, block)
    numbers = in_order(cut_lineage(cores.select("e", "root").distinct()), ["e"], ["root"], {"__n": row_number()})
    numbers = cut_lineage(numbers.select("e", "root", (F.col("__n") - 1).cast("int").alias("c")))
    labels = cores.join(numbers, ["e", "root"]).select("e", "id", "c")
    edge = touched.join(numbers, ["e", "root"]).groupBy("e", "id").agg(F.min("c").alias("c"))
    every = single.select("id", "vec", F.posexplode(F.array(*[F.lit(float(r)) for r in radii])).alias("e", "radius"))
    known = every.join(labels.unionByName(edge), ["e", "id"], "left").select("vec", "radius", F.coalesce("c", F.lit(-1)).alias("cluster"))
    return points.join(known, "vec").select(F.col("id").alias(key), "radius", "cluster")


def _pair_density(single: DataFrame, radii: list[float], min_samples: int, rows_per_pivot: int | None, block: int | None) -> tuple[DataFrame, DataFrame]:
    """(e, id, root) of the core rows, and (e, id, root) of the clusters that border rows touch: rows are compared for the counts and for the links."""
    pivots = choose_pivots(single, rows_per_pivot, max(radii))
    kind = single.schema["id"].dataType.simpleString()
    counts = neighbour_counts(single, radii, pivots, block)
    marked = cut_lineage(single.join(counts.select("id", F.transform("n", lambda n: n >= min_samples).alias("core")), "id"))
    any_core = marked.where(F.exists("core", lambda c: c))
    links = cut_lineage(compare_blocks(marked, any_core, pivots, max(radii), _links(radii),
                                       f"e int, u {kind}, v {kind}, border boolean", block, whole=True))
    node = (lambda c: F.struct("e", F.col(c).alias("id"))) if len(radii) > 1 else F.col
    root = components(links.where("not border").select(node("u").alias("u"), node("v").alias("v")))
    if len(radii) > 1:
        root = root.select("id.e", "id.id", F.col("root.id").alias("root"))
    else:
        root = root.select(F.lit(0).alias("e"), "id", "root")
    cores = marked.select("id", F.posexplode("core").alias("e", "core")).where("core").select("e", "id")
    cores = cut_lineage(cores.join(root, ["e", "id"], "left").select("e", "id", F.coalesce("root", "id").alias("root")))
    border = links.where("border").select("e", F.col("u").alias("of"), F.col("v").alias("id"))
    return cores, border.join(cores, ["e", "id"]).select("e", F.col("of").alias("id"), "root")


def _grid_density(single: DataFrame, dims: int, eps: float, min_samples: int, rows_per_pivot: int | None,
                  block: int | None) -> tuple[DataFrame, DataFrame] | None:
    """As ``_pair_density`` in few dimensions, by the cells of a grid whose rows all lie within eps of each other.

    A cell of ``min_samples`` rows has core rows only, so just the rows of lighter cells are counted, against the cells in reach. The core rows of
    a cell are connected, so cells are what is linked: first through about ``CELL_SAMPLE`` rows each; then, among cells in reach of each other that
    are not connected yet, through all their rows.
    """
    rows = _in_cells(single, dims, eps)
    if eps <= 0 or not rows.where("at is null").isEmpty():
        return None

    def compared(home: DataFrame, others: DataFrame, fn, schema: str) -> DataFrame:
        return cut_lineage(compare_blocks(home, others, choose_pivots(others, rows_per_pivot, eps), eps, fn, schema, block, whole=True))
    kind = single.schema["id"].dataType.simpleString()
    rows = cut_lineage(rows.join(rows.groupBy("at").agg(F.sum("w").alias("weight")), "at"))
    light = cut_lineage(rows.where(F.col("weight") < min_samples).select("at", "id", "vec", "w"))
    others = cut_lineage(rows.join(_in_reach(light.select("at").distinct(), dims).select("at").distinct(), "at", "left_semi").select("id", "vec", "w"))
    counts = neighbour_counts(others, [eps], choose_pivots(others, rows_per_pivot, eps), block, light.select("id", "vec", "w"))
    few = counts.where(F.col("n")[0] < min_samples).select("id")
    border = cut_lineage(light.join(few, "id", "left_semi"))
    core = cut_lineage(rows.join(border.select("id"), "id", "left_anti").select("at", "id", "vec", F.array(F.lit(True)).alias("core")))
    cells = cut_lineage(core.groupBy("at").agg(F.min("id").alias("root"), F.count(F.lit(1)).alias("size")))
    link = f"e int, u {kind}, v {kind}, border boolean"

    def joined(cells: DataFrame, links: DataFrame) -> DataFrame:
        lower = components(links.select("u", "v")).select(F.col("id").alias("root"), F.col("root").alias("lower"))
        return cut_lineage(cells.join(lower, "root", "left").select("at", F.coalesce("lower", "root").alias("root"), "size"))
    some = cut_lineage(core.join(cells, "at").where(F.pmod(F.xxhash64("id", F.lit(17)), F.col("size")) < CELL_SAMPLE).select("id", "vec", "core", "root"))
    cells = joined(cells, compared(some, some, _links([eps], "root"), link))
    reached = _in_reach(cells.where(F.col("size") > CELL_SAMPLE).select(F.col("at").alias("from"), "at", F.col("root").alias("own")), dims)
    apart = reached.join(cells, "at").where("root <> own").select(F.explode(F.array("from", "at")).alias("at")).distinct()
    rest = cut_lineage(core.join(cells, "at").join(apart, "at", "left_semi").select("id", "vec", "core", "root"))
    if not rest.isEmpty():
        cells = joined(cells, compared(rest, rest, _links([eps], "root"), link))
    cores = cut_lineage(core.join(cells, "at").select("at", "id", "vec", "root"))
    near = cores.join(_in_reach(border.select("at").distinct(), dims).select("at").distinct(), "at", "left_semi").select("id", "vec", "root")
    touched = compared(border.select("id", "vec"), cut_lineage(near), _touched(eps), f"id {kind}, root {kind}")
    zero = F.lit(0).alias("e")
    return cores.select(zero, "id", "root"), touched.select(zero, "id", "root")


def _in_cells(rows: DataFrame, dims: int, eps: float) -> DataFrame:
    """Add ``at``, the cell of a grid whose diagonal is a little less than eps; null where a coordinate is too far out for its cell to be told."""
    side = eps / math.sqrt(dims) * (1 - 1e-6) or 1.0
    steps = [F.col("vec")[k] / F.lit(side) for k in range(dims)]
    return rows.withColumn("at", F.when(all_of([F.abs(x) < 1e9 for x in steps]), F.array(*[F.floor(x) for x in steps])))


def _in_reach(cells: DataFrame, dims: int) -> DataFrame:
    """Each row once for every cell ``at`` that may hold rows within eps of those of its own: two cells off at most."""
    for k in range(dims):
        cells = cells.withColumn(f"at{k}", F.explode(F.sequence(F.col("at")[k] - 2, F.col("at")[k] + 2)))
    return cells.withColumn("at", F.array(*[F.col(f"at{k}") for k in range(dims)])).drop(*[f"at{k}" for k in range(dims)])


def _touched(eps: float):
    """(id, root) of the clusters within eps of the home rows."""
    def touched(xs: list[Piece], ys: list[Piece]) -> pd.DataFrame:
        found = []
        for x in xs:
            for y in ys:
                i, j = places(within(x.vec, y.vec, eps))
                found.append(pd.DataFrame({"id": x["id"].to_numpy()[i], "root": y["root"].to_numpy()[j]}).drop_duplicates())
        return pd.concat(found, ignore_index=True).drop_duplicates()
    return touched


def _links(radii: list[float], name: str = "id"):
    """Core rows: a link from each to the smallest id it is connected with inside the two blocks. Border rows: one core row of every connected part
    they touch. Rows that are connected already, or have the same ``name``, are not compared again."""
    def links(xs: list[Piece], ys: list[Piece]) -> pd.DataFrame:
        pieces = [*xs, *ys]
        ids, code = np.unique(np.concatenate([p[name].to_numpy() for p in pieces]), return_inverse=True)
        codes = np.split(code, np.cumsum([len(p.vec) for p in pieces])[:-1])
        cores = [np.stack(p["core"].to_numpy()).astype(bool) for p in pieces]
        out = []
        for e, eps in enumerate(radii):
            low, touched = np.arange(len(ids)), [np.zeros((0, 2), dtype=np.int64)]
            for x, xc, x_core in zip(pieces[:len(xs)], codes, cores):
                mine, edge = np.flatnonzero(x_core[:, e]), np.flatnonzero(~x_core[:, e])
                for y, yc, y_core in zip(ys, codes[len(xs):], cores[len(xs):]):
                    theirs = np.flatnonzero(y_core[:, e])
                    if len(edge) and len(theirs):
                        i, j = places(within(x.vec[edge], y.vec[theirs], eps))
                        touched.append(np.stack([xc[edge[i]], yc[theirs[j]]], axis=1))
                    if len(mine) and len(theirs):
                        _connect(low, x.vec, xc, mine, y.vec, yc, theirs, eps)
            linked = np.flatnonzero(low != np.arange(len(ids)))
            border = np.concatenate(touched)
            border = np.unique(np.stack([border[:, 0], low[border[:, 1]]], axis=1), axis=0)
            for u, v, is_border in ((linked, low[linked], False), (border[:, 0], border[:, 1], True)):
                out.append(pd.DataFrame({"e": np.int32(e), "u": ids[u], "v": ids[v], "border": is_border}, index=range(len(u))))
        return pd.concat(out, ignore_index=True)
    return links


def _connect(low: np.ndarray, x: np.ndarray, x_code: np.ndarray, mine: np.ndarray, y: np.ndarray, y_code: np.ndarray, theirs: np.ndarray, eps: float) -> None:
    """Lower the labels ``low`` of the rows ``mine`` and ``theirs`` to the least of what is connected through pairs within eps."""
    a, b = low[x_code[mine]], low[y_code[theirs]]
    parts, sizes = np.unique(a, return_counts=True)
    most = parts[sizes.argmax()]  # rows of the part that most rows belong to need no comparison with each other
    for rows, others in ((mine[a != most], theirs), (mine[a == most], theirs[b != most])):
        if not len(rows) or not len(others):
            continue
        u, v = x_code[rows], y_code[others]
        i, j = places(within(x[rows], y[others], eps))
        u, v = low[u[i]], low[v[j]]
        while not np.array_equal(u, v):
            least = np.minimum(u, v)
            np.minimum.at(low, u, least)
            np.minimum.at(low, v, least)
            while not np.array_equal(low, lower := low[low]):
                low[:] = lower
            u, v = low[u], low[v]


def single_link_cut(df: DataFrame, key: str, t: float, cols: list[str] | None = None, vec: str | None = None, **options) -> DataFrame:
    """Flat single-linkage clusters at distance t: the connected rows of the t-neighbour graph."""
    return dbscan(df, key, t, 1, cols, vec, **options)


def suggest_eps(distances: DataFrame, name: str = "k_distance") -> float:
    """90th percentile of the k-distances, with a fixed fallback when that is not positive."""
    eps = quantiles(distances, [name], [EPS_QUANTILE])[name][0]
    return eps if eps > 0 else EPS_FALLBACK


def dbscan_sweep(df: DataFrame, key: str, probs: list[float], min_samples: int, cols: list[str] | None = None,
                 vec: str | None = None, **options) -> DataFrame:
    """Clusters and noise for eps at rounded quantiles of the k-distance curve."""
    curve = cut_lineage(k_distance(df, key, min_samples, cols, vec, **options))
    found = sorted({round(e, 3) for e in quantiles(curve, ["k_distance"], probs)["k_distance"]})
    labels = density_labels(df, key, found, min_samples, cols, vec, **options)
    per = labels.groupBy(F.col("radius").alias("eps")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.when(F.col("cluster") != -1, F.col("cluster"))).alias("n_clusters"),
        F.count_if(F.col("cluster") == -1).alias("n_noise"))
    return per.select("eps", F.lit(min_samples).alias("min_samples"), "n_clusters", "n_noise",
                      (100.0 * F.col("n_noise") / F.col("n")).alias("noise_pct"))


def cluster_counts(df: DataFrame, cluster: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.when(col(cluster) != -1, col(cluster))).alias("n_clusters"),
                  F.count_if(col(cluster) == -1).alias("n_noise"))


# fuzzy ----------------------------------------------------------------------------------

def memberships(x: np.ndarray, centres: np.ndarray, m: float) -> np.ndarray:
    d2 = square_distances(x, centres)
    hit = d2 <= 0.0
    with np.errstate(divide="ignore", invalid="ignore"):
        u = d2 ** (-1.0 / (m - 1.0))
        u /= u.sum(axis=1, keepdims=True)
    on_centre = hit.any(axis=1)
    u[on_centre] = hit[on_centre] / hit[on_centre].sum(axis=1, keepdims=True)
    return u


def fuzzy_cmeans(df: DataFrame, key: str, c: int, cols: list[str] | None = None, vec: str | None = None, m: float = FUZZY_M,
                 error: float = FUZZY_ERROR, rounds: int = FUZZY_ROUNDS, seed: int = 0,
                 start: list[list[float]] | None = None) -> tuple[DataFrame, list[list[float]], int]:
    """Memberships and arg-max label per row, centres, and the rounds used.

    Each round is one pass that returns c x (d + 1) numbers and the change of the memberships
    between the last two sets of centres. The start is the c rows with the smallest hash of
    their key, so a run can be repeated.
    """
    points = as_points(df, key, cols, vec)
    if start is None:
        start = [r["vec"] for r in points.orderBy(unit_position(["id"], seed), "id").limit(c).collect()]
    centres, before = np.array(start, dtype=float), None
    with kept(points) as cached:
        for used in range(1, rounds + 1):
            new, change = _fuzzy_pass(cached, centres, before, m)
            before, centres = centres, new
            if change is not None and change < error:
                break
    final = before if before is not None else centres
    return _with_memberships(points, key, final, m), final.tolist(), used


def _fuzzy_pass(points: DataFrame, centres: np.ndarray, before: np.ndarray | None, m: float):
    k, d = centres.shape

    def partial(batches):
        sums, change = np.zeros((k, d + 1)), 0.0
        for pdf in batches:
            if not len(pdf):
                continue
            x = _matrix(pdf["vec"])
            u = memberships(x, centres, m)
            w = u ** m
            sums[:, :d] += w.T @ x
            sums[:, d] += w.sum(axis=0)
            if before is not None:
                change += float(np.square(u - memberships(x, before, m)).sum())
        yield pd.DataFrame({"pos": np.arange(k * (d + 1) + 1), "value": np.append(sums.ravel(), change)})
    rows = points.select("vec").mapInPandas(partial, "pos int, value double").groupBy("pos").agg(F.sum("value")).collect()
    flat = np.zeros(k * (d + 1) + 1)
    for r in rows:
        flat[r[0]] = r[1]
    sums = flat[:-1].reshape(k, d + 1)
    return sums[:, :d] / sums[:, d:], (float(np.sqrt(flat[-1])) if before is not None else None)


def _with_memberships(points: DataFrame, key: str, centres: np.ndarray, m: float) -> DataFrame:
    def label(batches):
        for pdf in batches:
            if len(pdf):
                u = memberships(_matrix(pdf["vec"]), centres, m)
                yield pd.DataFrame({"id": pdf["id"], "membership": list(u), "cluster": u.argmax(axis=1).astype("int32")})
    kind = points.schema["id"].dataType.simpleString()
    return points.mapInPandas(label, f"id {kind}, membership array<double>, cluster int").withColumnRenamed("id", key)


# subtractive ----------------------------------------------------------------------------

def potentials(df: DataFrame, key: str, ra: float = SUBTRACTIVE_RA, cols: list[str] | None = None, vec: str | None = None,
               candidates: int | None = None, seed: int = 0) -> DataFrame:
    """(id, vec, potential) of the rows, copies of a vector as one; each potential sums over all rows.

    Beyond the reach at which the kernels of all rows together fall below rounding nothing is compared, so the cost is that of a radius
    search; when that reach covers the data it is quadratic, in blocks. ``candidates`` asks for that many rows by key hash instead of all.
    """
    single = cut_lineage(distinct_points(as_points(df, key, cols, vec)))
    picked = single if candidates is None else single.orderBy(unit_position(["id"], seed), "id").limit(candidates)
    n = max(1, single.agg(F.sum("w")).first()[0] or 1)
    scale, reach = (ra / 2.0) ** 2, (ra / 2.0) * math.sqrt(math.log(n) - math.log(KERNEL_ROUNDING))

    def total(x: Piece, y: Piece) -> pd.DataFrame:
        return pd.DataFrame({"id": x["id"], "potential": np.exp(-square_distances(x.vec, y.vec) / scale) @ y["w"].to_numpy(dtype=float)})
    kind = single.schema["id"].dataType.simpleString()
    sums = compare_blocks(picked.select("id", "vec"), single, choose_pivots(single, None, reach), reach, total, f"id {kind}, potential double",
                          merge=summed(["id"]))
    sums = sums.groupBy(F.col("id").alias("__id")).agg(F.sum("potential").alias("potential"))
    return picked.join(sums, F.col("id") == F.col("__id")).select("id", "vec", "potential")


def subtractive(df: DataFrame, key: str, ra: float = SUBTRACTIVE_RA, rb: float = SUBTRACTIVE_RB, cols: list[str] | None = None,
                vec: str | None = None, candidates: int | None = None, seed: int = 0) -> tuple[DataFrame, list[list[float]]]:
    """Density peaks as centres, every row labelled with the nearest. All rows may become centres, unless ``candidates`` asks for a sample."""
    table = cut_lineage(potentials(df, key, ra, cols, vec, candidates, seed))
    centres = _peaks(table, ra, rb)
    return assign_nearest(df, centres, cols, vec), centres


def _peaks(table: DataFrame, ra: float, rb: float) -> list[list[float]]:
    """One pass over the potential table per peak. What earlier peaks took away is applied as a fold over the few peaks so far."""
    lowered: list[tuple[list[float], float]] = []
    dropped: list = []

    def highest() -> tuple:
        left = F.col("potential")
        if lowered:
            steps = F.array(*[F.struct(F.array(*map(F.lit, v)).alias("v"), F.lit(h).alias("h")) for v, h in lowered])

            def square(v: Column) -> Column:
                return F.aggregate(F.zip_with("vec", v, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, d: total + d)
            left = F.aggregate(steps, left, lambda at, s: F.greatest(at - s["h"] * F.exp(-square(s["v"]) / (rb / 2.0) ** 2), F.lit(0.0)))
        if dropped:
            left = F.when(F.col("id").isin(dropped), F.lit(0.0)).otherwise(left)
        rows = table.select("id", "vec", left.alias("left"))
        best = rows.agg(F.min_by(F.struct("id", "vec", "left"), F.struct(-F.col("left"), F.col("id")))).first()[0]
        return best["id"], list(best["vec"]), best["left"]

    if table.isEmpty():
        return []
    _, newest, first = highest()
    centres, height = [newest], first
    while len(centres) < MAX_CENTRES and first > 0:
        lowered.append((newest, height))  # the newest centre weakens its surroundings again after a rejected peak
        at, place, left = highest()
        if left / first < REJECT_RATIO or left <= 0:
            break
        nearest = min(math.dist(place, c) for c in centres)
        if left / first > ACCEPT_RATIO or nearest > ra:
            centres.append(place)
            newest, height = place, left
        else:
            dropped.append(at)
    return centres


# choice and stability -------------------------------------------------------------------

def with_clusters(df: DataFrame, key: str, labels: dict[str, DataFrame]) -> DataFrame:
    """Attach the labels of several algorithms as columns ``cluster_<name>``."""
    out = df
    for name, table in labels.items():
        out = out.join(table.select(col(key), F.col("cluster").alias(f"cluster_{name}")), key, "left")
    return out


def select_clustering(metrics: DataFrame) -> DataFrame:
    """Score = 0.6 silhouette + 0.3 balance - 0.1 noise share; a null silhouette counts as -1. Best first."""
    score = (SCORE_SILHOUETTE * F.coalesce("silhouette", F.lit(-1.0)) + SCORE_BALANCE * F.col("balance")
             - SCORE_NOISE * F.try_divide(F.col("n_noise"), F.col("n")))
    return metrics.withColumn("score", score).orderBy(F.desc("score"), "algorithm")


def stability(df: DataFrame, key: str, fn, b: int = 20, seed: int = 0) -> DataFrame:
    """Mean and std (n) of the ARI between the labels of ``fn`` on all rows and on ``b`` resamples.

    ``fn`` takes a table with the key and gives (key, cluster) back. Copies of a row inside a
    resample get keys of their own.
    """
    reference = cut_lineage(fn(df).select(col(key).alias("__orig"), F.col("cluster").cast("int").alias("__ref")))
    scores = []
    drawn = cut_lineage(bootstrap(df, [key], b, seed).withColumn("__orig", col(key)))
    for i in range(b):
        one = drawn.where(F.col("sample") == i).withColumn(key, F.xxhash64("__orig", "copy"))
        labels = fn(one.drop("sample", "copy", "__orig")).select(key, F.col("cluster").cast("int").alias("__new"))
        both = one.select(key, "__orig").join(labels, key).join(reference, "__orig")
        scores.append((i, ari(both, "__ref", "__new", noise=None).first()[0]))
    table = df.sparkSession.createDataFrame(scores, "sample int, ari double")
    return table.agg(F.avg("ari").alias("mean_ari"), F.stddev_pop("ari").alias("std_ari"), F.count(F.lit(1)).alias("n_samples"))
