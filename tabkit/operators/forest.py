"""Random forests grown together: every tree of every fold and option advances one level in the same pass over the rows.

A pass turns the rows into histograms of (node, feature, bin, class) and splits are chosen from their sums, so only numbers of the
size of the trees leave the tasks. A forest with fewer trees or less depth is a prefix of a larger one: both options cost nothing extra.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.quantiles import quantiles
from ..functions.runtime import col, ship_package
from .lloyd import POISSON
from .split import kfold

BINS = 32  # candidate values a feature is cut into
ROWS_AT_ONCE = 1 << 20  # rows of one set of histograms
CELLS_AT_ONCE = 1 << 20  # histogram cells one task sums at once
PAIRS_AT_ONCE = 1 << 20  # (row, tree) pairs looked at together
PARTS_AT_ONCE = 64  # partial histograms summed by one task
MIN_GAIN = 1e-9


@dataclass
class Grove:
    """Trees of one or more forests. Nodes are numbered through all trees, the root of tree t is t; the right child follows the left one.

    ``feature`` is -1 in a leaf; a row goes right when its bin is above ``cut``. ``counts`` are the weighted rows per class.
    """

    cols: list[str]
    classes: list
    edges: list[np.ndarray]
    trees: int
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    tree: np.ndarray
    depth: np.ndarray
    counts: np.ndarray

    def binned(self, x: np.ndarray) -> np.ndarray:
        return _binned(x, self.edges)

    def shares(self) -> np.ndarray:
        return self.counts / np.maximum(self.counts.sum(1, keepdims=True), 1e-300)

    def step(self, at: np.ndarray, bins: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Nodes one level below; leaves stay."""
        return _step(at, bins, row, self.feature, self.cut, self.left)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node: tree, node, feature and threshold (null in a leaf; rows up to the threshold go left), left child, counts per class."""
        rows = [(int(self.tree[i]), i, int(self.depth[i]), *((self.cols[f], float(self.edges[f][self.cut[i]]), int(self.left[i])) if f >= 0 else (None, None, None)),
                 [float(v) for v in self.counts[i]]) for i, f in enumerate(self.feature)]
        return spark.createDataFrame(rows, "tree int, node int, depth int, feature string, threshold double, left_child int, counts array<double>")

    def predict(self, df: DataFrame, out: str = "prediction", probability: str = "probability") -> DataFrame:
        """Mean class shares of all trees (in the order of ``classes``) and the class with the largest one, ties to the first."""
        ship_package(df.sparkSession)
        shares, me = self.shares(), self

        @F.pandas_udf("array<double>")
        def votes(x):
            import pandas as pd
            return pd.Series([v.tolist() for v in _votes(me, shares, np.stack(x.to_numpy()))]) if len(x) else pd.Series([], dtype=object)
        best = F.array_position(F.col(probability), F.array_max(probability)).cast("int")
        return df.withColumn(probability, votes(_vector(self.cols))).withColumn(out, F.element_at(F.array(*[F.lit(c) for c in self.classes]), best))


def _votes(grove: Grove, shares: np.ndarray, x: np.ndarray) -> np.ndarray:
    bins, sums = grove.binned(x), np.zeros((len(x), shares.shape[1]))
    row, deepest = np.arange(len(x)), int(grove.depth.max(initial=0))
    for t in range(grove.trees):
        at = np.full(len(x), t)
        for _ in range(deepest):
            at = grove.step(at, bins, row)
        sums += shares[at]
    return sums / max(1, grove.trees)


def _vector(cols: list[str]):
    """Features as doubles; a null or NaN is below every other value."""
    return F.array(*[F.coalesce(F.nanvl(col(c).cast("double"), F.lit(None).cast("double")), F.lit(float("-inf"))) for c in cols])


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.int16)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(e, x[:, j], side="left")
    return out


def _step(at, bins, row, feature, cut, left):
    f = feature[at]
    return np.where(f >= 0, left[at] + (bins[row, f] > cut[at]), at)


def bin_edges(df: DataFrame, cols: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper ends of all bins but the last: the values of a feature with few of them, exact quantiles of the others."""
    clean = df.select(*[F.nanvl(col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    out, wide = {}, []
    for c in cols:
        values = [r[0] for r in clean.select(col(c)).where(col(c).isNotNull()).distinct().limit(bins + 1).collect()]
        if len(values) <= bins:
            # nulls need an edge of their own: the lowest value is one when they exist
            out[c] = np.array(sorted(values)[:-1] if values else [], float)
            if values and clean.where(col(c).isNull()).limit(1).count():
                out[c] = np.concatenate([[np.nextafter(min(values), -np.inf)], out[c]])
        else:
            wide.append(c)
    for c, found in quantiles(clean, wide, [i / bins for i in range(1, bins)]).items():
        out[c] = np.unique(np.array(found, float))
    return [out[c] for c in cols]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _uniform(a: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1) from hashes and salts of any shapes that broadcast."""
    with np.errstate(over="ignore"):
        x = _mixed(a.astype(np.uint64) + _mixed((salt.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _chosen(member: np.ndarray, heap: np.ndarray, n_cols: int, m: int, seed: int) -> np.ndarray:
    """The features a node may split by: m of them by hash of tree and place in the tree, in ascending order."""
    if m >= n_cols:
        return np.tile(np.arange(n_cols), (len(member), 1))
    with np.errstate(over="ignore"):
        place = _mixed(heap + np.uint64(seed + 1) * np.uint64(0xD1342543DE82EF95) + member.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    draws = _uniform(place[:, None], np.arange(n_cols)[None, :])
    return np.sort(np.argpartition(draws, m - 1, axis=1)[:, :m], axis=1)


def _buffers(batches: Iterator[pa.RecordBatch], edges: list[np.ndarray]) -> Iterator[tuple]:
    """(fold, class, hash, bins) of at most about ``ROWS_AT_ONCE`` rows."""
    held, n = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        x = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
        held.append((*[b.column(i).to_numpy(zero_copy_only=False) for i in range(3)], _binned(x, edges)))
        n += b.num_rows
        if n >= ROWS_AT_ONCE:
            yield tuple(np.concatenate(p) for p in zip(*held))
            held, n = [], 0
    if held:
        yield tuple(np.concatenate(p) for p in zip(*held))


def _copies(h, fold, member, left_out, bootstrap: bool, seed: int) -> np.ndarray:
    """(tree, row) weights: none for the fold a tree leaves out, otherwise Poisson(1) copies or one."""
    used = fold[None, :] != left_out[:, None]
    if not bootstrap:
        return used.astype(np.float64)
    draws = _uniform(h.view(np.uint64)[None, :], member[:, None] + np.uint64(seed) * np.uint64(1 << 32))
    return np.searchsorted(POISSON, draws, side="right") * used


def _sum_parts(group: pa.Table, dense: int) -> np.ndarray:
    total = np.zeros(dense)
    for cells, sums in zip(group.column("cells"), group.column("sums")):
        total[np.frombuffer(cells.as_buffer(), np.int32)] += np.frombuffer(sums.as_buffer(), np.float64)
    return total


def _sparse(total: np.ndarray) -> tuple[bytes, bytes]:
    cells = np.flatnonzero(total)
    return cells.astype(np.int32).tobytes(), total[cells].tobytes()


def _best_splits(hist: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """(slot or -1, bin, left counts, all counts) per node from (node, slot, bin, class) sums: the split that lowers the Gini
    impurity most, ties to the first feature and the lowest bin; both sides need ``least`` rows."""
    left = hist.cumsum(axis=2)
    total = left[:, :1, -1:, :]
    right = total - left
    n_left, n_right = left.sum(3), right.sum(3)
    with np.errstate(divide="ignore", invalid="ignore"):
        pure = np.where(n_left > 0, (left * left).sum(3) / n_left, 0) + np.where(n_right > 0, (right * right).sum(3) / n_right, 0)
    total = total[:, 0, 0, :]
    n = np.maximum(total.sum(1), 1e-300)
    gain = pure - ((total * total).sum(1) / n)[:, None, None]
    allowed = (n_left >= least[:, None, None]) & (n_right >= least[:, None, None])
    gain = np.where(allowed, np.round(gain / n[:, None, None], 12), -1.0).reshape(len(hist), -1)
    best = gain.argmax(1)
    slot, cut = np.divmod(best, hist.shape[2])
    slot = np.where(gain[np.arange(len(hist)), best] > MIN_GAIN, slot, -1)
    return slot, cut, left[np.arange(len(hist)), np.maximum(slot, 0), cut], total


def _level_splits(rows: DataFrame, edges, nodes: tuple, rank, owner, chosen, of_tree: tuple, n_bins: int, n_classes: int, level: int, bootstrap: bool,
                  seed: int) -> tuple[np.ndarray, ...]:
    """Best split of each active node, in the order of ``rank``, from one pass over the rows.

    Active nodes are taken in chunks of bounded histograms. A task gives sparse sums per chunk; many of them are summed in rounds.
    """
    member_of, out_of, least_of = of_tree
    features = chosen.shape[1]
    per_node = features * n_bins * n_classes
    at_once, n_active = max(1, CELLS_AT_ONCE // per_node), len(owner)
    schema = "chunk int, part long, cells binary, sums binary"

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for fold, y, h, bins in _buffers(batches, edges):
            for chunk, low in enumerate(range(0, n_active, at_once)):
                high = min(n_active, low + at_once)
                block = np.unique(owner[low:high])
                total = np.zeros((high - low) * per_node)
                width = max(1, PAIRS_AT_ONCE // len(block))
                for a in range(0, len(y), width):
                    some = bins[a:a + width]
                    w = _copies(h[a:a + width], fold[a:a + width], member_of[block], out_of[block], bootstrap, seed)
                    t, r = np.nonzero(w)
                    at = block[t]
                    for _ in range(level):
                        at = _step(at, some, r, *nodes)
                    node = rank[at]
                    here = np.flatnonzero((node >= low) & (node < high))
                    t, r, node = t[here], r[here], node[here]
                    copies, cls = w[t, r], y[a:a + width][r]
                    for s in range(features):
                        cell = (((node - low) * features + s) * n_bins + some[r, chosen[node, s]]) * n_classes + cls
                        total += np.bincount(cell, copies, len(total))
                cells, sums = _sparse(total)
                if cells:
                    yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "part": pa.array([part], pa.int64()),
                                                      "cells": pa.array([cells], pa.binary()), "sums": pa.array([sums], pa.binary())})

    def summed(group: pa.Table) -> tuple[int, int, np.ndarray]:
        chunk = group.column("chunk")[0].as_py()
        n = min(at_once, n_active - chunk * at_once)
        return chunk, n, _sum_parts(group, n * per_node)

    def merged(group: pa.Table) -> pa.Table:
        cells, sums = _sparse(summed(group)[2])
        return pa.table({"chunk": group.column("chunk")[:1], "part": group.column("part")[:1], "cells": pa.array([cells], pa.binary()),
                         "sums": pa.array([sums], pa.binary())})

    def splits(group: pa.Table) -> pa.Table:
        chunk, n, total = summed(group)
        found = _best_splits(total.reshape(n, features, n_bins, n_classes), least_of[owner[chunk * at_once:chunk * at_once + n]])
        return pa.table({"chunk": pa.array([chunk], pa.int32()),
                         "found": pa.array([[f.astype(np.float64).tobytes() for f in found]], pa.list_(pa.binary()))})

    parts, sums = rows.rdd.getNumPartitions(), rows.mapInArrow(histograms, schema)
    while parts > PARTS_AT_ONCE:
        sums = sums.withColumn("part", F.floor(F.col("part") / PARTS_AT_ONCE)).groupBy("chunk", "part").applyInArrow(merged, schema)
        parts = -(-parts // PARTS_AT_ONCE)
    out = np.full(n_active, -1), np.zeros(n_active, np.int16), np.zeros((n_active, n_classes)), np.zeros((n_active, n_classes))
    for r in sums.groupBy("chunk").applyInArrow(splits, "chunk int, found array<binary>").collect():  # numbers per node, no rows
        for to, f in zip(out, r["found"]):
            values = np.frombuffer(f, np.float64).reshape(-1, *to.shape[1:])
            to[r["chunk"] * at_once:r["chunk"] * at_once + len(values)] = values
    return out


def grow(rows: DataFrame, edges: list[np.ndarray], cols: list[str], classes: list, left_out: list[int], min_leaf: list[int], trees: int,
         depth: int, features: int, bootstrap: bool = True, seed: int = 42) -> Grove:
    """Grow ``trees`` trees for each forest i, which leaves fold ``left_out[i]`` out and keeps ``min_leaf[i]`` weighted rows in a leaf.

    ``rows`` are (fold, class, hash, features). One pass per level. The trees depend on the rows' hashes, not on how the rows are split.
    """
    n_classes, n_bins, n_cols = len(classes), max([len(e) for e in edges], default=0) + 1, len(cols)
    roots = len(left_out) * trees
    member_of = np.tile(np.arange(trees, dtype=np.uint64), len(left_out))
    out_of, least_of = np.repeat(np.array(left_out), trees), np.repeat(np.array(min_leaf, float), trees)
    feature, cut, left = np.full(roots, -1, np.int32), np.zeros(roots, np.int16), np.zeros(roots, np.int64)
    tree, level, counts = np.arange(roots), np.zeros(roots, np.int16), np.zeros((roots, n_classes))
    active, heap = np.arange(roots), np.ones(roots, np.uint64)

    for now in range(depth):
        if not len(active):
            break
        chosen = _chosen(member_of[tree[active]], heap, n_cols, features, seed)
        rank = np.full(len(feature), -1, np.int64)
        rank[active] = np.arange(len(active))
        slot, at_bin, lefts, totals = _level_splits(rows, edges, (feature, cut, left), rank, tree[active], chosen, (member_of, out_of, least_of),
                                                    n_bins, n_classes, now, bootstrap, seed)
        counts[active] = totals
        split = np.flatnonzero(slot >= 0)
        parent = active[split]
        feature[parent], cut[parent] = chosen[split, slot[split]], at_bin[split]
        left[parent] = len(feature) + 2 * np.arange(len(split))
        new = np.stack([lefts[split], totals[split] - lefts[split]], 1).reshape(-1, n_classes)
        places = (heap[split][:, None] * np.uint64(2) + np.arange(2, dtype=np.uint64)[None, :]).ravel()
        first, more = len(feature), len(new)
        feature, cut, left = np.append(feature, np.full(more, -1, np.int32)), np.append(cut, np.zeros(more, np.int16)), np.append(left, np.zeros(more, np.int64))
        tree, level = np.append(tree, np.repeat(tree[parent], 2)), np.append(level, np.full(more, now + 1, np.int16))
        counts = np.vstack([counts, new])
        open_ = np.flatnonzero((new.sum(1) >= 2 * least_of[tree[first:]]) & ((new > 0).sum(1) > 1))
        active, heap = first + open_, places[open_]
    return Grove(list(cols), list(classes), edges, roots, feature, cut, left, tree, level, counts)


def _feature_count(features: str | int | None, n: int) -> int:
    if features is None:
        return n
    return max(1, min(n, math.ceil(math.sqrt(n)) if features == "sqrt" else int(features)))


def _staged(df: DataFrame, cols: list[str], label: str, key: list[str], classes: list, fold: str | None) -> DataFrame:
    cls = F.array_position(F.array(*[F.lit(c) for c in classes]), col(label)).cast("long") - 1
    rows = df.select((col(fold) if fold else F.lit(0)).cast("long").alias("fold"), cls.alias("y"), F.xxhash64(*[col(k) for k in key]).alias("h"),
                     _vector(cols).alias("x"))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return (rows.repartition(cores, "h") if rows.rdd.getNumPartitions() < cores else rows).persist()


def _classes(df: DataFrame, label: str) -> list:
    return sorted(r[0] for r in df.select(col(label)).distinct().collect())  # classes of a label


def fit_forest(df: DataFrame, cols: list[str], label: str, key: list[str], trees: int = 100, depth: int = 10, min_leaf: int = 1,
               features: str | int | None = "sqrt", bins: int = BINS, bootstrap: bool = True, seed: int = 42) -> Grove:
    """One forest of classification trees. Rows without a label are left out; equal keys share their bootstrap copies."""
    ship_package(df.sparkSession)
    rows = df.where(col(label).isNotNull())
    classes, edges = _classes(rows, label), bin_edges(rows, cols, bins)
    if not classes:
        raise ValueError("no labelled rows")
    held = _staged(rows, cols, label, key, classes, None)
    try:
        return grow(held, edges, cols, classes, [-1], [min_leaf], trees, depth, _feature_count(features, len(cols)), bootstrap, seed)
    finally:
        held.unpersist()


def forest_search(df: DataFrame, cols: list[str], label: str, key: list[str], trees: list[int] = (50, 100, 200), depths: list[int] = (6, 8, 10, 12),
                  min_leaf: list[int] = (2, 5, 10), folds: int = 3, features: str | int | None = "sqrt", bins: int = BINS, seed: int = 42) -> DataFrame:
    """Accuracy of every combination over stratified folds: params, mean_score, std_score (n), best first.

    Only one forest per fold and leaf size is grown; fewer trees and less depth are read off it.
    """
    ship_package(df.sparkSession)
    spark, rows = df.sparkSession, df.where(col(label).isNotNull())
    schema = "params string, mean_score double, std_score double"
    classes = _classes(rows, label)
    if not classes:
        return spark.createDataFrame([], schema)
    edges = bin_edges(rows, cols, bins)
    held = _staged(kfold(rows, key, label, folds, seed), cols, label, key, classes, "fold")
    try:
        pairs = list(product(min_leaf, range(folds)))
        grove = grow(held, edges, cols, classes, [f for _, f in pairs], [m for m, _ in pairs], max(trees), max(depths),
                     _feature_count(features, len(cols)), True, seed)
        hits = _held_out_hits(held, grove, [f for _, f in pairs], list(trees), list(depths))
    finally:
        held.unpersist()
    out = []
    for (i, leaf), d, n in product(enumerate(min_leaf), depths, trees):
        scores = [hits[i * folds + f, d, n] for f in range(folds) if (i * folds + f, d, n) in hits]  # a fold may have no row
        out.append((f"maxDepth={d}, minInstancesPerNode={leaf}, numTrees={n}", float(np.mean(scores)), float(np.std(scores))))
    return spark.createDataFrame(out, schema).orderBy(F.desc("mean_score"), "params")


def _held_out_hits(rows: DataFrame, grove: Grove, left_out: list[int], trees: list[int], depths: list[int]) -> dict[tuple, float]:
    """Accuracy per (forest, depth, number of trees) on the rows of the fold that the forest left out, in one pass."""
    each, shares, edges = grove.trees // len(left_out), grove.shares(), grove.edges
    feature, cut, left = grove.feature, grove.cut, grove.left
    width = max(1, PAIRS_AT_ONCE // (each * shares.shape[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits: dict[tuple, list[int]] = {}
        for fold, y, _, bins in _buffers(batches, edges):
            for g, f in enumerate(left_out):
                mine = np.flatnonzero(fold == f)
                for a in range(0, len(mine), width):
                    r = mine[a:a + width]
                    at = np.repeat(np.arange(g * each, (g + 1) * each)[:, None], len(r), 1)
                    for d in range(1, max(depths) + 1):
                        at = _step(at, bins, r[None, :], feature, cut, left)
                        if d in depths:
                            votes = shares[at].cumsum(0)
                            for n in trees:
                                cell = hits.setdefault((g, d, n), [0, 0])
                                # sums of equal shares may differ in the last digits: ties go to the first class
                                cell[0] += int((np.round(votes[n - 1] / n, 12).argmax(1) == y[r]).sum())
                                cell[1] += len(r)
        if hits:
            yield pa.RecordBatch.from_pydict({"g": [k[0] for k in hits], "d": [k[1] for k in hits], "n": [k[2] for k in hits],
                                              "good": [v[0] for v in hits.values()], "total": [v[1] for v in hits.values()]})

    found = rows.mapInArrow(run, "g long, d long, n long, good long, total long").groupBy("g", "d", "n").agg(F.sum("good").alias("good"), F.sum("total").alias("total"))
    return {(r["g"], r["d"], r["n"]): r["good"] / r["total"] for r in found.collect()}  # one row per fit
