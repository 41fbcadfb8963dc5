"""What a query moves: the parts that grow faster than the input stay out of shuffles and out of single tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.functions import runtime
from tabkit.operators import cluster, metrics, neighbors, quality


def shuffled_rows(df) -> int:
    """Rows written to shuffles by the last job of a table that is computed here."""
    df._jdf.queryExecution().executedPlan().executeCollect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


@pytest.fixture
def joined_by_shuffles(spark):
    """Tables too large to broadcast, as far as Spark can tell."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_confusion_grid_is_not_shuffled(spark, joined_by_shuffles):
    rows = spark.range(3_000).selectExpr("cast(id % 500 as int) AS y", "id * 7 % 501 AS pred")
    labels = rows.select(F.col("y").cast("long").alias("y")).distinct()
    grid = metrics.confusion(rows, labels)
    assert shuffled_rows(grid) < 20_000  # of 250,000 rows in the grid
    got = {(r["actual"], r["predicted"]): r["n"] for r in grid.collect()}
    want = {}
    for i in range(3_000):
        want[i % 500, i * 7 % 501] = want.get((i % 500, i * 7 % 501), 0) + 1
    assert len(got) == 250_000
    assert {k: n for k, n in got.items() if n} == {k: n for k, n in want.items() if k[1] < 500}


def test_confusion_shuffles_no_row_per_label_and_block(spark, joined_by_shuffles):
    rows = spark.range(3_000).selectExpr("cast(id % 500 as int) AS y", "id * 7 % 501 AS pred")
    labels = rows.select(F.col("y").cast("long").alias("y")).distinct()
    grid = metrics.confusion(rows, labels, block=1)  # 500 blocks, two groups
    assert shuffled_rows(grid) < 20_000  # of 250,000 pairs of a label and a block
    usual = metrics.confusion(rows, labels)
    assert grid.exceptAll(usual).isEmpty() and usual.exceptAll(grid).isEmpty()


def test_confusion_keeps_null_and_unseen_labels(spark):
    rows = spark.createDataFrame([("a", "b"), ("a", "z"), (None, "a"), ("b", None)], "y string, pred string")
    labels = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "label string")
    got = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion(rows, labels, block=1).collect()}
    assert len(got) == 16 and {k for k, n in got.items() if n} == {("a", "b")}


def cloud(spark, n, dims):
    x = np.random.default_rng(5).normal(size=(n, dims)).round(3)
    return x, spark.createDataFrame([(i, r.tolist(), i % 3) for i, r in enumerate(x)], "id long, v array<double>, label int")


def test_a_radius_that_covers_the_data_sends_each_row_to_a_fixed_number_of_tasks(spark):
    n = 24_000
    counts = neighbors.neighbour_counts(*(lambda single: (single, [9.0], neighbors.choose_pivots(single, None, 9.0)))(
        neighbors.distinct_points(neighbors.as_points(cloud(spark, n, 12)[1], "id", vec="v")).checkpoint()))
    assert shuffled_rows(counts) <= 3 * neighbors.SPREAD * n  # rows of both sides, and a count per row and task


def test_pieces_of_blocks_folded_at_once_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "FOLD", 0)
    x, df = cloud(spark, 2_500, 10)
    d = np.sqrt(np.maximum(np.square(x[:, None, :] - x[None, :, :]).sum(2), 0))
    near = {r["id"]: r["n_neighbours"] for r in neighbors.radius_counts(df, "id", 3.0, vec="v").collect()}
    assert [near[i] for i in range(len(x))] == (d <= 3.0).sum(1).tolist()
    kth = {r["id"]: r["k_distance"] for r in neighbors.k_distance(df, "id", 7, vec="v").collect()}
    np.testing.assert_allclose([kth[i] for i in range(len(x))], np.sort(d, 1)[:, 6], atol=1e-9)
    one = {r["id"]: r["cluster"] for r in cluster.dbscan(df, "id", 2.0, 4, vec="v").collect()}
    small = {r["id"]: r["cluster"] for r in cluster.dbscan(df, "id", 2.0, 4, vec="v", rows_per_pivot=300, block=100).collect()}
    assert one == small and 1 < len(set(one.values()))
    label = np.arange(len(x)) % 3
    mean = np.stack([d[:, label == c].sum(1) / ((label == c).sum() - (label == c)) for c in range(3)], 1)
    a, rest = mean[np.arange(len(x)), label], np.where(np.arange(3)[None, :] == label[:, None], np.inf, mean).min(1)
    assert quality.silhouette(df, "id", "label", vec="v").first()["silhouette"] == pytest.approx(((rest - a) / np.maximum(a, rest)).mean(), abs=1e-9)


def test_cells_that_hold_all_rows_are_not_used(spark):
    single = neighbors.distinct_points(neighbors.as_points(cloud(spark, 24_000, 12)[1], "id", vec="v")).checkpoint()
    assert len(neighbors.choose_pivots(single, None, 9.0)) == 0  # 64 tasks instead of two


def in_pieces(x, **columns):
    import pyarrow as pa
    rows = pa.table({"id": np.arange(len(x)), "vec": pa.array(list(x), pa.list_(pa.float64())), **columns})
    return [neighbors.Piece(rows.slice(at, 100)) for at in range(0, len(x), 100)]


def test_products_in_short_numbers_find_the_same_pairs(spark):
    x = np.random.default_rng(6).normal(size=(300, 12))
    x[7, 3], x[8, 0] = np.nan, np.inf
    x[9] = x[10]
    for moved in (x, x * 1e-3, x + 1e4, x * 1e30):
        d = np.sqrt(np.square(moved[:, None, :] - moved[None, :, :]).sum(2))
        for eps in (0.0, float(np.nanquantile(d[np.isfinite(d)], 0.2)), float(np.sort(d[20])[5])):
            assert (neighbors.within(moved, moved, eps) == (d <= eps)).all()
    assert neighbors.closeness(x, x, 0.1)[0].dtype == np.float32 and neighbors.closeness(x + 1e4, x, 0.1)[0].dtype == np.float64


def test_connected_rows_are_not_compared_again(spark, monkeypatch):
    x = np.random.default_rng(7).normal(size=(1_000, 10))
    x[-1] += 100.0
    pairs = []

    def counted(a, b, eps, within=neighbors.within):
        pairs.append(len(a) * len(b))
        return within(a, b, eps)
    monkeypatch.setattr(cluster, "within", counted)
    pieces = in_pieces(x, core=[[True]] * len(x))
    found = cluster._links([5.0])(pieces, pieces)
    assert sorted(zip(found["u"], found["v"])) == [(i, 0) for i in range(1, 999)] and not found["border"].any()
    assert sum(pairs) < len(x) ** 2 / 3


def test_far_rows_are_passed_over(spark, monkeypatch):
    x = np.random.default_rng(8).normal(size=(1_000, 10)).round(2)
    w = np.arange(len(x)) % 3 + 1
    d = np.sqrt(np.square(x[:, None, :] - x[None, :, :]).sum(2))
    for radius in (np.inf, 2.5):
        looked = []

        def counted(mask, places=neighbors.places):
            looked.append(np.count_nonzero(mask))
            return places(mask)
        with monkeypatch.context() as m:
            m.setattr(neighbors, "places", counted)
            found = neighbors._nearest(4, radius)(in_pieces(x), in_pieces(x, w=w))
        assert sum(looked) < len(x) ** 2 / 10
        for i in range(0, len(x), 50):
            order = np.argsort(d[i])
            order = order[(np.cumsum(w[order]) - w[order] < 4) & (d[i][order] <= radius)]
            np.testing.assert_allclose(np.sort(found["d"][found["id"] == i]), d[i][order], atol=1e-12)


def test_kept_rows_sit_in_bounded_partitions(spark, monkeypatch):
    monkeypatch.setattr(runtime, "MAX_ROWS_PER_PARTITION", 1_000, raising=False)
    with runtime.kept(spark.range(20_000, numPartitions=8)) as held:
        sizes = [r["count"] for r in held.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) <= 1_000
    with runtime.kept(spark.range(0)) as held:
        assert held.count() == 0


def test_label_effect_computes_its_rows_a_few_times(spark):
    from tabkit.plans.lifecycle import label_effect
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return float(x % 7)
    n = 300
    rows = spark.range(n).select("id", counted("id").alias("x"), (F.col("id") % 11).cast("double").alias("y"), (F.col("id") % 3).cast("int").alias("a"), ((F.col("id") * 7) % 3).cast("int").alias("b"))
    assert label_effect(rows, "id", ["x", "y"], "a", "b").count() == 3
    assert 0 < seen.value <= 2 * n
