"""k-means for many models against a plain Lloyd iteration, and its resamples against counting."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.operators import cluster, lloyd


def rows(n=600, seed=5):
    rng = np.random.default_rng(seed)
    centres = np.array([[0, 0], [40, 5], [5, 60], [70, 70]])
    return [(i, float(x), float(y)) for i, (x, y) in enumerate(centres[rng.integers(0, 4, n)] + rng.normal(0, 3, (n, 2)))]


def frame(spark, data):
    return spark.createDataFrame(data, "id long, x double, y double").repartition(5)


def test_each_model_ends_at_a_fixed_point(spark):
    data = np.array([r[1:] for r in rows()])
    models = [lloyd.Model(k, s) for k in (1, 2, 3, 4, 7) for s in range(3)]
    lloyd.fit_many(lloyd.points(frame(spark, rows()), ["x", "y"], None), models, tol=0.0)
    for m in models:
        d2 = ((data[:, None] - m.centres[None]) ** 2).sum(2)
        near = d2.argmin(1)
        assert m.inertia == pytest.approx(d2.min(1).sum())
        for c in range(m.k):
            if (near == c).any():
                assert np.allclose(m.centres[c], data[near == c].mean(0))
    best = lloyd.best_of(models)
    assert best[1, None].inertia == pytest.approx(((data - data.mean(0)) ** 2).sum())
    assert sorted(np.round(best[4, None].centres / 10).tolist()) == [[0, 0], [0, 6], [4, 0], [7, 7]] or best[4, None].inertia < best[3, None].inertia / 3


def test_partitions_and_repeated_rows_do_not_matter(spark):
    data = rows() + rows()[:200]
    a = cluster.elbow(frame(spark, data), [1, 3, 4], ["x", "y"], n_init=2).collect()
    b = cluster.elbow(frame(spark, data[::-1]).coalesce(1), [1, 3, 4], ["x", "y"], n_init=2).collect()
    assert [(r["k"], round(r["inertia"], 6)) for r in a] == [(r["k"], round(r["inertia"], 6)) for r in b]
    points = np.array([r[1:] for r in data])
    assert a[0]["inertia"] == pytest.approx(((points - points.mean(0)) ** 2).sum())


def test_labels_centres_and_inertia_agree(spark):
    labelled, centres, inertia = cluster.kmeans(frame(spark, rows()), 4, ["x", "y"], n_init=5)
    got = labelled.toPandas()
    at = np.array(centres)[got["cluster"]]
    assert ((got[["x", "y"]].to_numpy() - at) ** 2).sum() == pytest.approx(inertia)
    vec = frame(spark, rows()).select("id", F.array("x", "y").alias("v"))
    assert cluster.kmeans(vec, 4, vec="v", n_init=5)[2] == pytest.approx(inertia)


def test_fewer_distinct_rows_than_clusters_and_empty_tables(spark):
    few = spark.createDataFrame([(i, 1.0, 2.0) for i in range(9)], "id long, x double, y double")
    labelled, _, inertia = cluster.kmeans(few, 3, ["x", "y"], n_init=2)
    assert inertia == 0.0 and {r["cluster"] for r in labelled.collect()} == {0}
    assert cluster.elbow(few.where("false"), [1, 2], ["x", "y"]).collect() == []


def test_resamples_are_poisson_copies(spark):
    h = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 20_000)
    w = lloyd.weights_of(h, np.ones(len(h)), 3, 7)
    assert abs(w.mean() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.02
    assert np.array_equal(w, lloyd.weights_of(h, np.ones(len(h)), 3, 7)) and not np.array_equal(w, lloyd.weights_of(h, np.ones(len(h)), 4, 7))


def test_agreement_equals_counting(spark):
    data = rows(200)
    points = lloyd.points(frame(spark, data), ["x", "y"], None, "id").cache()
    ref = lloyd.Model(3, 0, None, np.array([[0.0, 0], [40, 5], [40, 60]]))
    other = [lloyd.Model(2, 0, s, np.array([[10.0 * s, 0], [50, 50]])) for s in range(3)]
    got = {r["sample"]: r["ari"] for r in lloyd.resample_agreement(points, ref, other, 9).collect()}
    table = points.toPandas()
    x, h = np.array(table["x"].tolist()), table["h"].to_numpy()
    pairs = lambda n: (n * (n - 1) / 2).sum()
    for m in other:
        w = lloyd.weights_of(h, np.ones(len(h)), m.sample, 9)
        a, b = (((x[:, None] - c[None]) ** 2).sum(2).argmin(1) for c in (ref.centres, m.centres))
        n = np.zeros((3, 2))
        np.add.at(n, (a, b), w)
        expected = pairs(n.sum(1)) * pairs(n.sum(0)) / pairs(n.sum())
        assert got[m.sample] == pytest.approx((pairs(n) - expected) / ((pairs(n.sum(1)) + pairs(n.sum(0))) / 2 - expected))


def test_stability_of_clear_groups_is_one(spark):
    r = cluster.kmeans_stability(frame(spark, rows()), "id", 4, ["x", "y"], b=6, n_init=4).first()
    assert r["n_samples"] == 6 and r["mean_ari"] > 0.99


def test_squared_silhouettes_equal_all_pairs(spark):
    data = rows(150) + rows(150)[:40]
    points = lloyd.points(frame(spark, data), ["x", "y"], None).cache()
    models = [lloyd.Model(2, 0, None, np.array([[0.0, 0], [70, 70]])), lloyd.Model(3, 0, None, np.array([[0.0, 0], [40, 5], [999, 999]])),
              lloyd.Model(4, 0, None, np.array([[0.0, 0], [40, 5], [5, 60], [70, 70]])), lloyd.Model(1, 0, None, np.array([[0.0, 0]]))]
    got = lloyd.squared_silhouettes(points, models)
    x = np.array([r[1:] for r in data])
    d2 = ((x[:, None] - x[None]) ** 2).sum(2)
    for m, value in zip(models, got):
        near = ((x[:, None] - m.centres[None]) ** 2).sum(2).argmin(1)
        if len(set(near)) < 2:
            assert value is None
            continue
        each = []
        for i in range(len(x)):
            own = near == near[i]
            a = d2[i][own].sum() / max(own.sum() - 1, 1)
            b = min(d2[i][near == c].mean() for c in set(near) if c != near[i])
            each.append((b - a) / max(a, b) if own.sum() > 1 else 0)
        assert value == pytest.approx(np.mean(each))


def test_passes_read_few_records_and_give_the_sums_of_all_rows(spark):
    x = np.random.default_rng(8).normal(size=(5_000, 3)).round(2)
    rows = lloyd.points(spark.createDataFrame([(r.tolist(),) for r in np.vstack([x, x[:500]])], "v array<double>"), None, "v")
    with lloyd._packed(rows) as packed:
        assert packed.count() <= 50  # of 5,000 rows
    model = lloyd.fit_many(rows, [lloyd.Model(4, 1)])[0]
    every, w = np.unique(np.vstack([x, x[:500]]), axis=0, return_counts=True)
    d = np.square(every[:, None, :] - model.centres[None]).sum(2)
    near = d.argmin(1)
    assert model.inertia == pytest.approx(float((w * d.min(1)).sum()), rel=1e-9)
    for c in range(4):
        np.testing.assert_allclose(model.centres[c], np.average(every[near == c], axis=0, weights=w[near == c]), atol=0.05)
    assert lloyd.fit_many(rows.limit(0), [lloyd.Model(2, 1)])[0].centres is None
