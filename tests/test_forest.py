"""Forests grown together against trees grown one by one in plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.operators import forest


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(7)
    a, b = rng.integers(0, 12, 400), rng.normal(0, 1, 400)
    y = np.where(a + rng.integers(0, 4, 400) > 7, "x", np.where(b > 0.4, "y", "z"))
    rows = [(i, float(p), float(q), str(c)) for i, (p, q, c) in enumerate(zip(a, b, y))]
    return spark.createDataFrame(rows + [(900, None, 0.3, "x"), (901, float("nan"), 0.1, "y"), (902, 3.0, 0.1, None)], "id long, `a b` double, b double, y string").repartition(5)


COLS = ["a b", "b"]


def plain_tree(bins, y, k, depth, least):
    """(feature, cut, counts) per node, depth first."""
    counts = np.bincount(y, minlength=k).astype(float)
    best = None
    if depth:
        for f in range(bins.shape[1]):
            for c in range(32):
                left = bins[:, f] <= c
                n = left.sum()
                if n < least or len(y) - n < least:
                    continue
                sides = [np.bincount(y[m], minlength=k).astype(float) for m in (left, ~left)]
                gain = round((sum((s * s).sum() / s.sum() for s in sides) - (counts * counts).sum() / counts.sum()) / counts.sum(), 12)
                if gain > forest.MIN_GAIN and (best is None or gain > best[0]):
                    best = gain, f, c, left
    if best is None:
        return [(-1, None, counts.tolist())]
    _, f, c, left = best
    return [(f, c, counts.tolist()), *plain_tree(bins[left], y[left], k, depth - 1, least), *plain_tree(bins[~left], y[~left], k, depth - 1, least)]


def grown_tree(g, at):
    if g.feature[at] < 0:
        return [(-1, None, g.counts[at].tolist())]
    return [(int(g.feature[at]), int(g.cut[at]), g.counts[at].tolist()), *grown_tree(g, g.left[at]), *grown_tree(g, g.left[at] + 1)]


def plain_rows(table, g):
    rows = table.where("y IS NOT NULL").orderBy("id").toPandas()
    x = rows[COLS].to_numpy(float)
    return rows["id"].to_numpy(), g.binned(np.where(np.isnan(x), -np.inf, x)), np.array([g.classes.index(v) for v in rows["y"]])


@pytest.mark.parametrize("depth,least", [(1, 1), (4, 1), (6, 5)])
def test_tree_equals_plain_python(table, depth, least):
    g = forest.fit_forest(table, COLS, "y", ["id"], trees=1, depth=depth, min_leaf=least, features=None, bootstrap=False)
    _, bins, y = plain_rows(table, g)
    assert grown_tree(g, 0) == plain_tree(bins, y, 3, depth, least)


def test_bootstrap_trees_equal_plain_python_on_their_copies(table):
    g = forest.fit_forest(table, COLS, "y", ["id"], trees=4, depth=3, min_leaf=2, features=None, seed=5)
    ids, bins, y = plain_rows(table, g)
    h = np.array([r[0] for r in table.where("y IS NOT NULL").orderBy("id").select(F.xxhash64("id")).collect()])
    for t in range(4):
        w = forest._copies(h, np.zeros(len(h), int), np.array([t], np.uint64), np.array([-1]), True, 5)[0].astype(int)
        assert 300 < w.sum() < 500
        assert grown_tree(g, t) == plain_tree(np.repeat(bins, w, 0), np.repeat(y, w), 3, 3, 2)


def test_result_does_not_depend_on_partitions_or_chunks(table, monkeypatch):
    one = forest.fit_forest(table.repartition(1), COLS, "y", ["id"], trees=6, depth=5)
    monkeypatch.setattr(forest, "CELLS_AT_ONCE", 400)
    monkeypatch.setattr(forest, "PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(forest, "PARTS_AT_ONCE", 2)
    two = forest.fit_forest(table.repartition(11), COLS, "y", ["id"], trees=6, depth=5)
    for a, b in ((one.feature, two.feature), (one.cut, two.cut), (one.left, two.left), (one.counts, two.counts)):
        assert np.array_equal(a, b)


def test_a_smaller_forest_is_a_prefix(table):
    small = forest.fit_forest(table, COLS, "y", ["id"], trees=3, depth=3)
    large = forest.fit_forest(table, COLS, "y", ["id"], trees=8, depth=6)

    def upto(g, at, depth):
        return [g.counts[at].tolist()] + ([] if depth == 0 or g.feature[at] < 0 else upto(g, g.left[at], depth - 1) + upto(g, g.left[at] + 1, depth - 1))
    for t in range(3):
        assert upto(small, t, 3) == upto(large, t, 3)


def test_search_scores_the_forests_it_names(table):
    got = {r["params"]: r for r in forest.forest_search(table, COLS, "y", ["id"], [2, 5], [2, 4], [1, 6], folds=3).collect()}
    assert len(got) == 8
    rows = forest.kfold(table.where("y IS NOT NULL"), ["id"], "y", 3, 42).select("id", *[F.col(f"`{c}`") for c in COLS], "y", "fold").cache()
    edges = forest.bin_edges(rows, COLS)
    for leaf, depth, n in ((1, 2, 5), (6, 4, 2)):
        scores = []
        for f in range(3):
            held = forest._staged(rows.where(f"fold != {f}"), COLS, "y", ["id"], ["x", "y", "z"], "fold")
            g = forest.grow(held, edges, COLS, ["x", "y", "z"], [f], [leaf], n, depth, 2)
            out = g.predict(rows.where(f"fold = {f}")).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
            scores.append(out)
        r = got[f"maxDepth={depth}, minInstancesPerNode={leaf}, numTrees={n}"]
        assert np.isclose(r["mean_score"], np.mean(scores)) and np.isclose(r["std_score"], np.std(scores))


def test_empty_one_class_and_no_labels(spark, table):
    empty = table.where("1 = 0")
    assert forest.forest_search(empty, COLS, "y", ["id"], [2], [2], [1]).collect() == []
    with pytest.raises(ValueError):
        forest.fit_forest(empty, COLS, "y", ["id"])
    g = forest.fit_forest(table.where("y = 'x'"), COLS, "y", ["id"], trees=3)
    assert g.predict(table).where("prediction != 'x'").count() == 0 and (g.feature < 0).all()
    nulls = table.withColumn("b", F.lit(None).cast("double"))
    assert forest.fit_forest(nulls, COLS, "y", ["id"], trees=3, depth=3).predict(nulls).where("size(probability) != 3").count() == 0
