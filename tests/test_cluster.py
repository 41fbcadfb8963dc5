"""Distance-based operators against brute force on small fixtures, with block and pivot sizes
small enough that several cells and blocks are in play."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.operators import cluster, neighbors, quality


def brute(x, y):
    return np.sqrt(np.square(x[:, None, :] - y[None, :, :]).sum(2))


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(c, 0.35, (70, 3)) for c in ((0, 0, 0), (3, 0, 0), (0, 4, 1))] + [rng.uniform(-3, 6, (40, 3))])
    x = np.round(x, 2)
    x = np.vstack([x, np.repeat(x[:1], 80, axis=0)])  # a third of the rows are copies
    order = rng.permutation(len(x))
    x = x[order]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    return df, x


COLS = ["a", "b", "c"]
SMALL = dict(rows_per_pivot=30, block=16)


def brute_dbscan(x, eps, m):
    near = brute(x, x) <= eps
    core = near.sum(1) >= m
    label = np.full(len(x), -1)
    c = 0
    for i in range(len(x)):
        if core[i] and label[i] == -1:
            todo = [i]
            label[i] = c
            while todo:
                j = todo.pop()
                for k in np.nonzero(near[j] & core & (label == -1))[0]:
                    label[k] = c
                    todo.append(k)
            c += 1
    for i in range(len(x)):
        if not core[i]:
            hit = label[near[i] & core]
            if len(hit):
                label[i] = hit.min()
    return label


@pytest.mark.parametrize("options", [SMALL, {}])
def test_radius_counts(cloud, options):
    df, x = cloud
    got = {r["id"]: r["n_neighbours"] for r in neighbors.radius_counts(df, "id", 0.5, COLS, **options).collect()}
    assert [got[i] for i in range(len(x))] == (brute(x, x) <= 0.5).sum(1).tolist()


@pytest.mark.parametrize("options", [SMALL, {}])
def test_k_distance(cloud, options):
    df, x = cloud
    got = {r["id"]: r["k_distance"] for r in neighbors.k_distance(df, "id", 5, COLS, **options).collect()}
    want = np.sort(brute(x, x), axis=1)[:, 4]
    np.testing.assert_allclose([got[i] for i in range(len(x))], want, rtol=0, atol=1e-12)


@pytest.mark.parametrize("eps,m", [(0.5, 5), (0.3, 8), (1.5, 3)])
def test_dbscan(cloud, eps, m):
    df, x = cloud
    want = brute_dbscan(x, eps, m).tolist()
    for options in (SMALL, {}):
        got = {r["id"]: r["cluster"] for r in cluster.dbscan(df, "id", eps, m, COLS, **options).collect()}
        assert [got[i] for i in range(len(x))] == want


@pytest.mark.parametrize("bridge", [True, False])
def test_rows_of_dense_cells_are_not_counted(spark, monkeypatch, bridge):
    rng = np.random.default_rng(9)
    x = np.vstack([rng.uniform((0, 0), (3, 0.5), (900, 2)), rng.uniform((0, 1.62), (3, 2.1), (900, 2)), rng.uniform((10, 0), (12, 1), (400, 2)),
                   rng.uniform((13.05, 0), (15, 1), (400, 2)), rng.uniform((-4, -4), (18, 8), (60, 2))]).round(3)
    if bridge:  # the only link of the first two strips
        x = np.vstack([x, [(1.5, 0.55), (1.5, 1.54)]])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double")
    monkeypatch.setattr(cluster, "CELL_SAMPLE", 2, raising=False)
    counted = []

    def counts(points, radii, pivots, block=None, home=None, fn=neighbors.neighbour_counts):
        counted.append((points if home is None else home).count())
        return fn(points, radii, pivots, block, *([] if home is None else [home]))
    monkeypatch.setattr(cluster, "neighbour_counts", counts)
    got = {r["id"]: r["cluster"] for r in cluster.dbscan(df, "id", 1.0, 12, ["a", "b"]).collect()}
    want = brute_dbscan(x, 1.0, 12).tolist()
    assert [got[i] for i in range(len(x))] == want and -1 in want
    assert sum(counted) < len(x) / 5


def test_exact_limit_on_a_grid(spark):
    x = np.array([(i, j) for i in range(7) for j in range(7)], dtype=float)
    wide = np.hstack([x, np.zeros((49, 10))])  # enough columns for the matrix-product path
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(wide)], "id long, v array<double>")
    got = {r["id"]: r["n_neighbours"] for r in neighbors.radius_counts(df, "id", 1.0, vec="v").collect()}
    assert [got[i] for i in range(49)] == (brute(x, x) <= 1.0).sum(1).tolist()


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102)] + [(200, i) for i in range(201, 260)]
    got = {r["id"]: r["root"] for r in neighbors.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100, **{i: 200 for i in range(200, 260)}}
    assert neighbors.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_single_link(cloud):
    df, x = cloud
    got = {r["id"]: r["cluster"] for r in cluster.single_link_cut(df, "id", 0.6, COLS).collect()}
    assert [got[i] for i in range(len(x))] == brute_dbscan(x, 0.6, 1).tolist()


def brute_silhouette(x, y):
    d = brute(x, x)
    out = []
    for i in range(len(x)):
        own = (y == y[i]).sum()
        if own == 1:
            out.append(0.0)
            continue
        a = d[i][y == y[i]].sum() / (own - 1)
        b = min(d[i][y == c].mean() for c in set(y.tolist()) - {y[i]})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_quality(cloud, spark):
    df, x = cloud
    labelled = df.withColumn("cluster", F.when(F.col("a") > 1.5, 1).when(F.col("b") > 2, 2).when(F.col("c") > 5.5, -1).otherwise(0))
    y = np.where(x[:, 0] > 1.5, 1, np.where(x[:, 1] > 2, 2, np.where(x[:, 2] > 5.5, -1, 0)))
    xs, ys = x[y != -1], y[y != -1]
    assert quality.silhouette(labelled, "id", "cluster", COLS).first()[0] == pytest.approx(brute_silhouette(xs, ys), abs=1e-12)
    sample = quality.silhouette(labelled, "id", "cluster", COLS, sample=50).first()
    assert sample["is_estimate"] and abs(sample[0] - brute_silhouette(xs, ys)) < 0.2
    cents = {c: xs[ys == c].mean(0) for c in set(ys.tolist())}
    s = {c: np.sqrt(np.square(xs[ys == c] - m).sum(1)).mean() for c, m in cents.items()}
    db = np.mean([max((s[a] + s[b]) / np.sqrt(np.square(cents[a] - cents[b]).sum()) for b in cents if b != a) for a in cents])
    assert quality.davies_bouldin(labelled, "cluster", COLS).first()[0] == pytest.approx(db, abs=1e-12)
    between = sum((ys == c).sum() * np.square(m - xs.mean(0)).sum() for c, m in cents.items())
    within = sum(np.square(xs[ys == c] - m).sum() for c, m in cents.items())
    ch = (between / (len(cents) - 1)) / (within / (len(xs) - len(cents)))
    assert quality.calinski_harabasz(labelled, "cluster", COLS).first()[0] == pytest.approx(ch, rel=1e-12)
    row = quality.cluster_metrics(labelled, "x", "id", "cluster", COLS).first()
    assert row["n_clusters"] == 3 and row["n_noise"] == int((y == -1).sum())
    one = df.withColumn("cluster", F.lit(0))
    assert quality.silhouette(one, "id", "cluster", COLS).first()[0] is None
    row = quality.cluster_metrics(one, "x", "id", "cluster", COLS).first()
    assert row["davies_bouldin"] is None and row["balance"] == pytest.approx(0.0, abs=1e-9)


def test_kmeans_family(cloud):
    df, x = cloud
    labelled, centres, inertia = cluster.kmeans(df, 3, COLS, n_init=3)
    rows = labelled.orderBy("id").collect()
    y = np.array([r["cluster"] for r in rows])
    assert inertia == pytest.approx(sum(np.square(x[y == c] - np.array(m)).sum() for c, m in enumerate(centres)), rel=1e-9)
    curve = {r["k"]: r["inertia"] for r in cluster.elbow(df, [1, 2, 3], COLS, n_init=2).collect()}
    assert curve[1] == pytest.approx(np.square(x - x.mean(0)).sum(), rel=1e-9) and curve[1] > curve[2] > curve[3]
    best = cluster.best_k(df, "id", [2, 3], COLS, n_init=1).collect()
    assert sum(r["best"] for r in best) == 1
    again = cluster.assign_nearest(df, centres, COLS).orderBy("id").collect()
    assert [r["cluster"] for r in again] == y.tolist()


def test_fuzzy(cloud):
    df, x = cloud
    start = x[:3] + np.array([[0, 0, 0], [0.5, 0, 0], [0, 0.5, 0]])
    table, centres, used = cluster.fuzzy_cmeans(df, "id", 3, COLS, start=start.tolist())
    c, old = start, None
    for rounds in range(1, 1000):
        d2 = np.square(x[:, None] - c[None]).sum(2)
        hit = (d2 == 0).any(1)
        u = np.zeros_like(d2)
        u[~hit] = (1 / d2[~hit]) / (1 / d2[~hit]).sum(1, keepdims=True)
        u[hit] = (d2[hit] == 0) / (d2[hit] == 0).sum(1, keepdims=True)
        new = (u ** 2).T @ x / (u ** 2).sum(0)[:, None]
        if old is not None and np.sqrt(np.square(u - old).sum()) < 0.005:
            break
        c, old = new, u
    assert used == rounds
    np.testing.assert_allclose(centres, c, atol=1e-8)
    got = table.orderBy("id").collect()
    np.testing.assert_allclose([r["membership"] for r in got], u, atol=1e-8)
    assert [r["cluster"] for r in got] == u.argmax(1).tolist()
    assert cluster.fuzzy_cmeans(df, "id", 3, COLS)[0].count() == len(x)


def test_subtractive(cloud):
    df, x = cloud
    ra, rb = 2.2, 3.3
    labelled, centres = cluster.subtractive(df, "id", ra, rb, COLS)
    p = np.exp(-np.square(brute(x, x)) / (ra / 2) ** 2).sum(1)
    table = cluster.potentials(df, "id", ra, COLS).toPandas()
    np.testing.assert_allclose(table["potential"], [p[i] for i in table["id"]], rtol=1e-10)
    assert np.allclose(centres[0], x[p.argmax()])
    d = brute(x, np.array(centres))
    assert [r["cluster"] for r in labelled.orderBy("id").collect()] == d.argmin(1).tolist()
    few = cluster.subtractive(df, "id", ra, rb, COLS, candidates=40)[1]
    assert 1 <= len(few) <= 50


def test_sweep_stability_choice(cloud, spark):
    df, x = cloud
    table = cluster.dbscan_sweep(df, "id", [0.5, 0.9], 5, COLS).collect()
    kth = np.sort(brute(x, x), axis=1)[:, 4]
    for r, p in zip(table, [0.5, 0.9]):
        assert r["eps"] == round(float(np.quantile(kth, p)), 3)
        want = brute_dbscan(x, r["eps"], 5)
        assert (r["n_clusters"], r["n_noise"]) == (len(set(want.tolist()) - {-1}), int((want == -1).sum()))
    fixed = [[0.0, 0.0, 0.0], [3.0, 0.0, 0.0]]
    r = cluster.stability(df, "id", lambda t: cluster.assign_nearest(t, fixed, COLS).select("id", "cluster"), b=3).first()
    assert r["mean_ari"] == 1.0 and r["std_ari"] == 0.0 and r["n_samples"] == 3
    assert cluster.suggest_eps(spark.createDataFrame([(0.0,), (0.0,)], "k_distance double")) == 0.7
    metrics = spark.createDataFrame([("a", None, 1.0, 0, 10), ("b", 0.4, 0.5, 5, 10)],
                                    "algorithm string, silhouette double, balance double, n_noise long, n long")
    best = cluster.select_clustering(metrics).first()
    assert best["algorithm"] == "b" and best["score"] == pytest.approx(0.24 + 0.15 - 0.05)
    both = cluster.with_clusters(df, "id", {"k": cluster.assign_nearest(df, fixed, COLS)})
    assert both.count() == len(x) and "cluster_k" in both.columns
