"""Queries: principal components, clustering, neighbours, supervised models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cluster, forest, metrics, models, neighbors, quality, reduce, split
from .registry import query, table

# principal components -------------------------------------------------------------------

PLANE = ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity AS x", "l_quantity * 0.5 + l_tax * 100 AS y"]
_PLANE_SQL = f"(SELECT {', '.join(PLANE)} FROM lineitem)"
_EIGEN = f"""(SELECT mx, my, a, b, c, (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) AS l1, (a + c) / 2 - sqrt((a - c) * (a - c) / 4 + b * b) AS l2
       FROM (SELECT avg(x) AS mx, avg(y) AS my, var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c FROM {_PLANE_SQL}))"""
# unit eigenvectors (b, l - a); the loading of larger absolute value is made positive
_AXES = f"""(SELECT mx, my, u1 * s1 AS u1, v1 * s1 AS v1, u2 * s2 AS u2, v2 * s2 AS v2 FROM (SELECT *, CASE WHEN (CASE WHEN abs(u1) >= abs(v1) THEN u1 ELSE v1 END) < 0 THEN -1 ELSE 1 END AS s1,
       CASE WHEN (CASE WHEN abs(u2) >= abs(v2) THEN u2 ELSE v2 END) < 0 THEN -1 ELSE 1 END AS s2 FROM (SELECT mx, my, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS u1, (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS v1,
       b / sqrt(b * b + (l2 - a) * (l2 - a)) AS u2, (l2 - a) / sqrt(b * b + (l2 - a) * (l2 - a)) AS v2 FROM {_EIGEN})))"""
_SCORES = f"(SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, (x - mx) * u1 + (y - my) * v1 AS PC1, (x - mx) * u2 + (y - my) * v2 AS PC2 FROM {_PLANE_SQL}, {_AXES})"


def plane(spark, d):
    return table(spark, d, "lineitem").selectExpr(*PLANE)


@query("pca_variance", f"SELECT CAST(1 AS INTEGER) AS component, l1 / (l1 + l2) AS explained_ratio FROM {_EIGEN} UNION ALL SELECT 2, l2 / (l1 + l2) FROM {_EIGEN}", doubles="explained_ratio")
def _(spark, d):
    return reduce.pca_variance(plane(spark, d), ["x", "y"], 2)


@query("pca_scores", f"SELECT l_orderkey, l_linenumber, l_partkey, PC1, PC2 FROM {_SCORES}", doubles="PC1 PC2")
def _(spark, d):
    return reduce.pca(plane(spark, d), ["x", "y"], 2).select("l_orderkey", "l_linenumber", "l_partkey", "PC1", "PC2")


@query("projection_table", f"SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, PC1, PC2 FROM {_SCORES}", doubles="PC1 PC2")
def _(spark, d):
    return reduce.project(plane(spark, d), ["l_orderkey", "l_linenumber", "l_partkey"], ["x", "y"], ["l_returnflag"])


@query("projection_summary", " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
       quantile_cont({c}, 0.75) AS q75, max({c}) AS max FROM {_SCORES}""" for c in ("PC1", "PC2")), doubles="mean std min q25 q50 q75 max")
def _(spark, d):
    return reduce.projection_summary(reduce.pca(plane(spark, d), ["x", "y"], 2))


@query("projection_extremes", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, PC1, PC2, sqrt(PC1 * PC1 + PC2 * PC2) AS distance FROM {_SCORES}
       ORDER BY sqrt(PC1 * PC1 + PC2 * PC2) DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10""", doubles="PC1 PC2 distance", scale=5)
def _(spark, d):
    key = ["l_orderkey", "l_linenumber", "l_partkey"]
    # rounded before ranking, so that equal distances do not depend on the last digit
    scores = reduce.project(plane(spark, d), key, ["x", "y"], ["l_returnflag"])
    return reduce.extremes(scores.withColumns({c: F.round(c, 9) for c in ("PC1", "PC2")}), key, 10)


@query("pca_embedding_variance")
def _(spark, d):
    wide = table(spark, d, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    return reduce.pca_variance(wide, [f"e{i}" for i in range(64)], 3)


# k-means --------------------------------------------------------------------------------

# three groups far apart, so that the best partition is known
BLOBS = ["event_id", "value / 100.0 + CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 100 ELSE 250 END AS x", "CASE event_type WHEN 'click' THEN 0.0 WHEN 'view' THEN 90.0 ELSE 0.0 END AS y",
         "CASE event_type WHEN 'click' THEN 'Low' WHEN 'view' THEN CASE WHEN value < 5 THEN 'Low' ELSE 'Moderate' END ELSE CASE WHEN value < 10 THEN 'Moderate' ELSE 'High' END END AS label"]
_BLOBS_SQL = f"(SELECT {', '.join(BLOBS)}, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS truth FROM events)"


def blobs(spark, d):
    return table(spark, d, "events").selectExpr(*BLOBS)


@query("kmeans_clusters", f"SELECT count(*) AS n, avg(x) AS center_x, avg(y) AS center_y, var_pop(x) * count(*) AS spread FROM {_BLOBS_SQL} GROUP BY truth", doubles="center_x center_y spread", scale=5)
def _(spark, d):
    labelled = cluster.kmeans(blobs(spark, d), 3, ["x", "y"], n_init=10)[0]
    return labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("center_x"), F.avg("y").alias("center_y"),
                                           (F.var_pop("x") * F.count("x")).alias("spread")).drop("cluster")


# ten tight groups on a line, so that the least inertia for every K follows from the groups' sums by dynamic programming
LINE_AT = [0, 12, 61, 75, 160, 183, 340, 370, 700, 741]
TEN = ["event_id", f"element_at(array({', '.join(map(str, LINE_AT))}), CAST(user_id % 10 AS INT) + 1) + event_id % 7 / 10.0 AS x"]
_TEN = f"(SELECT user_id % 10 AS g, list_extract([{', '.join(map(str, LINE_AT))}], CAST(user_id % 10 AS INTEGER) + 1) + event_id % 7 / 10.0 AS x FROM events)"
_LEAST = f"""WITH g AS (SELECT g, count(*) AS n, sum(x) AS s, sum(x * x) AS q FROM {_TEN} GROUP BY 1),
       cost AS (SELECT a.g AS i, b.g AS j, 1.25 * (sum(c.q) - sum(c.s) * sum(c.s) / sum(c.n)) AS w FROM g a JOIN g b ON a.g <= b.g JOIN g c ON c.g BETWEEN a.g AND b.g GROUP BY 1, 2),
       b1 AS (SELECT j, w FROM cost WHERE i = 0), """ + ", ".join(
    f"b{k} AS (SELECT cost.j, min(b{k - 1}.w + cost.w) AS w FROM b{k - 1} JOIN cost ON cost.i = b{k - 1}.j + 1 GROUP BY 1)" for k in range(2, 11)) + """,
       least AS (""" + " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS k, w AS inertia FROM b{k} WHERE j = 9" for k in range(1, 11)) + ")"


def ten_groups(spark, d):
    return table(spark, d, "events").selectExpr(*TEN).withColumn("y", F.col("x") / 2)


@query("kmeans_elbow", f"{_LEAST} SELECT k, inertia FROM least", doubles="inertia", scale=2)
def _(spark, d):
    return cluster.elbow(ten_groups(spark, d), list(range(1, 11)), ["x", "y"], n_init=20)


@query("kmeans_best_k", f"{_LEAST} SELECT k, inertia, k = (SELECT count(*) FROM g) AS best FROM least WHERE k > 1", doubles="inertia", scale=2)
def _(spark, d):
    # squared distances: their silhouette costs one pass at any size
    return cluster.best_k(ten_groups(spark, d), "event_id", list(range(2, 11)), ["x", "y"], n_init=20, metric="squared").drop("silhouette")


@query("kmeans_embeddings")
def _(spark, d):
    labelled = cluster.kmeans(table(spark, d, "embeddings"), 10, vec="embedding", n_init=3)[0]
    return labelled.select("vec_id", "label", "cluster")


CENTRES = [[10.5, 0.021], [30.25, 0.055], [40.125, 0.011]]
_D2 = [f"(l_quantity - {a}) * (l_quantity - {a}) + (l_tax - {b}) * (l_tax - {b})" for a, b in CENTRES]
_NEAREST = f"CASE WHEN {_D2[0]} <= {_D2[1]} AND {_D2[0]} <= {_D2[2]} THEN 0 WHEN {_D2[1]} <= {_D2[2]} THEN 1 ELSE 2 END"


@query("nearest_centre", f"SELECT l_orderkey, l_linenumber, l_partkey, CAST({_NEAREST} AS INTEGER) AS cluster FROM lineitem")
def _(spark, d):
    return cluster.assign_nearest(table(spark, d, "lineitem"), CENTRES, ["l_quantity", "l_tax"]).select("l_orderkey", "l_linenumber", "l_partkey", "cluster")


@query("kmeans_step", f"""SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n, sum(d) AS inertia, avg(l_quantity) AS center_l_quantity, avg(l_tax) AS center_l_tax
       FROM (SELECT l_quantity, l_tax, {_NEAREST} AS cluster, least({', '.join(_D2)}) AS d FROM lineitem) GROUP BY 1""", doubles="inertia center_l_quantity center_l_tax", scale=4)
def _(spark, d):
    return cluster.lloyd_step(table(spark, d, "lineitem"), CENTRES, ["l_quantity", "l_tax"])


# neighbours and density -----------------------------------------------------------------

EPS, MIN_SAMPLES = 1.15, 5
_V = "(SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
_PAIRS = f"(SELECT a.vec_id AS i, b.vec_id AS j, list_distance(a.v, b.v) AS dist FROM {_V} a, {_V} b)"
_C = "(SELECT c_custkey AS id, c_acctbal / 100.0 AS x, c_nationkey * 2.0 AS y FROM customer)"
_C_PAIRS = f"(SELECT a.id AS i, b.id AS j, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist FROM {_C} a, {_C} b)"


def customers(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 100.0).alias("x"), (F.col("c_nationkey") * 2.0).alias("y"))


@query("radius_neighbour_counts", f"SELECT i AS vec_id, count(*) AS n_neighbours FROM {_PAIRS} WHERE dist <= {EPS} GROUP BY 1")
def _(spark, d):
    return neighbors.radius_counts(table(spark, d, "embeddings"), "vec_id", EPS, vec="embedding")


@query("radius_neighbour_counts_plane", f"SELECT i AS id, count(*) AS n_neighbours FROM {_C_PAIRS} WHERE dist <= 2.005 GROUP BY 1")
def _(spark, d):
    return neighbors.radius_counts(customers(spark, d), "id", 2.005, ["x", "y"])


_KDIST = f"(SELECT i, dist FROM {_PAIRS} QUALIFY row_number() OVER (PARTITION BY i ORDER BY dist) = 5)"


@query("k_distance", f"SELECT i AS vec_id, dist AS k_distance FROM {_KDIST}", doubles="k_distance")
def _(spark, d):
    return neighbors.k_distance(table(spark, d, "embeddings"), "vec_id", 5, vec="embedding")


@query("k_distance_plane", f"SELECT i AS id, dist AS k_distance FROM {_C_PAIRS} QUALIFY row_number() OVER (PARTITION BY i ORDER BY dist) = 5", doubles="k_distance")
def _(spark, d):
    return neighbors.k_distance(customers(spark, d), "id", 5, ["x", "y"])


@query("suggested_eps", f"SELECT quantile_cont(dist, 0.9) AS eps FROM {_KDIST}", doubles="eps")
def _(spark, d):
    eps = cluster.suggest_eps(neighbors.k_distance(table(spark, d, "embeddings"), "vec_id", 5, vec="embedding"))
    return spark.createDataFrame([(eps,)], "eps double")


def _dbscan_sql(pairs, key, eps, m):
    return f"""WITH RECURSIVE near AS MATERIALIZED (SELECT i, j FROM {pairs} WHERE dist <= {eps}), core AS MATERIALIZED (SELECT i FROM near GROUP BY 1 HAVING count(*) >= {m}),
      e AS MATERIALIZED (SELECT i, j FROM near WHERE i IN (SELECT i FROM core) AND j IN (SELECT i FROM core)),
      reach AS (SELECT i, i AS r FROM core UNION SELECT e.j, reach.r FROM reach JOIN e ON reach.i = e.i WHERE reach.r < e.j),
      root AS (SELECT i, min(r) AS r FROM reach GROUP BY 1), num AS (SELECT i, dense_rank() OVER (ORDER BY r) - 1 AS c FROM root),
      border AS (SELECT near.i, min(c) AS c FROM near JOIN num ON near.j = num.i WHERE near.i NOT IN (SELECT i FROM core) GROUP BY 1),
      ids AS (SELECT DISTINCT i FROM near)
      SELECT ids.i AS {key}, CAST(coalesce(num.c, border.c, -1) AS INTEGER) AS cluster FROM ids LEFT JOIN num ON ids.i = num.i LEFT JOIN border ON ids.i = border.i"""


@query("dbscan", _dbscan_sql(_PAIRS, "vec_id", EPS, MIN_SAMPLES))
def _(spark, d):
    return cluster.dbscan(table(spark, d, "embeddings"), "vec_id", EPS, MIN_SAMPLES, vec="embedding")


@query("dbscan_plane", _dbscan_sql(_C_PAIRS, "id", 2.005, 6))
def _(spark, d):
    return cluster.dbscan(customers(spark, d), "id", 2.005, 6, ["x", "y"])


@query("single_link_cut", _dbscan_sql(_PAIRS, "vec_id", 1.1, 1))
def _(spark, d):
    return cluster.single_link_cut(table(spark, d, "embeddings"), "vec_id", 1.1, vec="embedding")


@query("dbscan_sensitivity")
def _(spark, d):
    return cluster.dbscan_sweep(table(spark, d, "embeddings"), "vec_id", [0.3, 0.6], MIN_SAMPLES, vec="embedding")


@query("connected_components", """WITH RECURSIVE e AS (SELECT DISTINCT o_custkey % 211 * 10 AS u, o_custkey % 97 * 10 + 1 AS v FROM orders),
       b AS (SELECT u, v FROM e UNION SELECT v, u FROM e), r AS (SELECT u AS id, u AS root FROM b UNION SELECT b.v, r.root FROM r JOIN b ON r.id = b.u WHERE r.root < b.v)
       SELECT id, min(root) AS root FROM r GROUP BY 1""")
def _(spark, d):
    links = table(spark, d, "orders").selectExpr("o_custkey % 211 * 10 AS u", "o_custkey % 97 * 10 + 1 AS v")
    return neighbors.components(links)


# fuzzy and subtractive ------------------------------------------------------------------

FUZZY = [[20.005, 30.5], [200.25, 100.5], [60.125, 120.25]]
_F2 = [f"((value - {a}) * (value - {a}) + (user_id - {b}) * (user_id - {b}))" for a, b in FUZZY]
_U = [f"(1 / {x}) / ({' + '.join(f'1 / {y}' for y in _F2)})" for x in _F2]


@query("fuzzy_memberships", f"SELECT event_id, {', '.join(f'{u} AS u{i}' for i, u in enumerate(_U))} FROM events", doubles="u0 u1 u2")
def _(spark, d):
    out = cluster.fuzzy_cmeans(table(spark, d, "events"), "event_id", 3, ["value", "user_id"], start=FUZZY, rounds=1)[0]
    return out.select("event_id", *[F.col("membership")[i].alias(f"u{i}") for i in range(3)])


@query("fuzzy_step", " UNION ALL ".join(f"SELECT {i} AS center, sum({u} * {u} * value) / sum({u} * {u}) AS x, sum({u} * {u} * user_id) / sum({u} * {u}) AS y FROM events" for i, u in enumerate(_U)), doubles="x y")
def _(spark, d):
    # two rounds: the memberships returned belong to the centres after the first update
    centres = cluster.fuzzy_cmeans(table(spark, d, "events"), "event_id", 3, ["value", "user_id"], start=FUZZY, rounds=2)[1]
    return spark.createDataFrame([(i, *c) for i, c in enumerate(centres)], "center int, x double, y double")


@query("fuzzy_clusters")
def _(spark, d):
    return cluster.fuzzy_cmeans(blobs(spark, d), "event_id", 3, ["x", "y"])[0]


@query("subtractive_potentials", f"SELECT i AS vec_id, sum(exp(-dist * dist / 1.21)) AS potential FROM {_PAIRS} GROUP BY 1", doubles="potential", scale=5)
def _(spark, d):
    return cluster.potentials(table(spark, d, "embeddings"), "vec_id", vec="embedding").select(F.col("id").alias("vec_id"), "potential")


@query("subtractive_clusters", f"SELECT event_id, n FROM {_BLOBS_SQL} JOIN (SELECT truth, count(*) AS n FROM {_BLOBS_SQL} GROUP BY 1) USING (truth)")
def _(spark, d):
    rows = blobs(spark, d)
    labelled = cluster.subtractive(rows, "event_id", 20.0, 30.0, ["x", "y"])[0]
    sizes = labelled.groupBy(F.col("cluster").alias("c")).agg(F.count(F.lit(1)).alias("n"))
    return labelled.join(sizes, F.col("cluster") == F.col("c")).select("event_id", "n")


# quality --------------------------------------------------------------------------------

_SIL = f"""(SELECT avg((b - a) / greatest(a, b)) AS silhouette FROM (SELECT i, max(CASE WHEN own THEN s / (n - 1) END) AS a, min(CASE WHEN NOT own THEN s / n END) AS b FROM
       (SELECT p.i, y.label, x.label = y.label AS own, sum(dist) AS s, count(*) AS n FROM {_PAIRS} p JOIN embeddings x ON p.i = x.vec_id JOIN embeddings y ON p.j = y.vec_id GROUP BY ALL) GROUP BY 1))"""
_CENT = f"(SELECT label, list(m ORDER BY k) AS c FROM (SELECT label, k, avg(v[k]) AS m FROM {_V}, range(1, 65) t(k) GROUP BY 1, 2) GROUP BY 1)"
_ALL = f"(SELECT list(m ORDER BY k) AS c FROM (SELECT k, avg(v[k]) AS m FROM {_V}, range(1, 65) t(k) GROUP BY 1))"
_DB = f"""(SELECT avg(r) AS davies_bouldin FROM (SELECT a.label, max((a.s + b.s) / list_distance(a.c, b.c)) AS r FROM (SELECT e.label, c, avg(list_distance(v, c)) AS s FROM {_V} e JOIN {_CENT} m ON e.label = m.label GROUP BY 1, 2) a,
       (SELECT e.label, c, avg(list_distance(v, c)) AS s FROM {_V} e JOIN {_CENT} m ON e.label = m.label GROUP BY 1, 2) b WHERE a.label <> b.label GROUP BY 1))"""
_CH = f"""(SELECT (between_ss / (k - 1)) / (within_ss / (n - k)) AS calinski_harabasz FROM (SELECT (SELECT sum(n * pow(list_distance(m.c, g.c), 2)) FROM {_CENT} m JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY 1) s ON m.label = s.label, {_ALL} g) AS between_ss,
       (SELECT sum(pow(list_distance(v, c), 2)) FROM {_V} e JOIN {_CENT} m ON e.label = m.label) AS within_ss, (SELECT count(DISTINCT label) FROM embeddings) AS k, (SELECT count(*) FROM embeddings) AS n))"""


@query("silhouette", f"SELECT silhouette, (SELECT count(*) FROM embeddings) AS n, false AS is_estimate FROM {_SIL}", doubles="silhouette")
def _(spark, d):
    return quality.silhouette(table(spark, d, "embeddings"), "vec_id", "label", vec="embedding")


@query("silhouette_squared", f"""SELECT avg((b - a) / greatest(a, b)) AS silhouette, count(*) AS n, false AS is_estimate FROM (SELECT i, max(CASE WHEN own THEN s / (n - 1) END) AS a, min(CASE WHEN NOT own THEN s / n END) AS b FROM
       (SELECT p.i, y.label, x.label = y.label AS own, sum(dist * dist) AS s, count(*) AS n FROM {_PAIRS} p JOIN embeddings x ON p.i = x.vec_id JOIN embeddings y ON p.j = y.vec_id GROUP BY ALL) GROUP BY 1)""", doubles="silhouette")
def _(spark, d):
    return quality.silhouette(table(spark, d, "embeddings"), "vec_id", "label", vec="embedding", metric="squared")


@query("davies_bouldin", f"SELECT * FROM {_DB}", doubles="davies_bouldin")
def _(spark, d):
    return quality.davies_bouldin(table(spark, d, "embeddings"), "label", vec="embedding")


@query("calinski_harabasz", f"SELECT * FROM {_CH}", doubles="calinski_harabasz")
def _(spark, d):
    return quality.calinski_harabasz(table(spark, d, "embeddings"), "label", vec="embedding")


@query("cluster_quality_row", f"""SELECT 'given' AS algorithm, (SELECT count(*) FROM embeddings) AS n, (SELECT count(DISTINCT label) FROM embeddings) AS n_clusters, CAST(0 AS BIGINT) AS n_noise, silhouette, davies_bouldin, calinski_harabasz,
       (SELECT -sum(p * ln(p + 1e-12)) / ln(count(*)) FROM (SELECT count(*) / sum(count(*)) OVER () AS p FROM embeddings GROUP BY label)) AS balance FROM {_SIL}, {_DB}, {_CH}""",
       doubles="silhouette davies_bouldin calinski_harabasz balance")
def _(spark, d):
    return quality.cluster_metrics(table(spark, d, "embeddings"), "given", "vec_id", "label", vec="embedding")


@query("clusters_attached", f"""SELECT l_orderkey * 100 + l_linenumber AS id, CAST({_NEAREST} AS INTEGER) AS cluster_a, CAST(CASE WHEN l_tax < 0.04 THEN 0 ELSE 1 END AS INTEGER) AS cluster_b FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey * 100 + l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1""")
def _(spark, d):
    from ..operators.dedup import drop_duplicates
    rows = table(spark, d, "lineitem").withColumn("id", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    rows = drop_duplicates(rows.select("id", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_tax"), ["id"], "first", ["l_partkey", "l_suppkey", "l_extendedprice"])
    a = cluster.assign_nearest(rows, CENTRES, ["l_quantity", "l_tax"])
    b = rows.withColumn("cluster", F.when(F.col("l_tax") < 0.04, 0).otherwise(1))
    return cluster.with_clusters(rows, "id", {"a": a, "b": b}).select("id", "cluster_a", "cluster_b")


@query("clustering_stability", "SELECT 1.0 AS mean_ari, 0.0 AS std_ari, CAST(20 AS BIGINT) AS n_samples FROM events LIMIT 1", doubles="mean_ari std_ari")
def _(spark, d):
    return cluster.kmeans_stability(blobs(spark, d), "event_id", 3, ["x", "y"], b=20)


# supervised models ----------------------------------------------------------------------

# a rule the trees can learn exactly, next to columns that say nothing about it
RULE = ["l_orderkey", "l_partkey", "l_linenumber", "l_tax + 0.0 AS l_tax", "l_suppkey", "CAST(CASE WHEN l_linenumber < 3 THEN 0 WHEN l_linenumber < 6 THEN 1 ELSE 2 END AS INTEGER) AS class",
        "CAST(CASE WHEN l_linenumber < 4 THEN 0 ELSE 1 END AS INTEGER) AS flag"]
_PREDICTED = "SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, CAST({c} AS DOUBLE) AS prediction FROM (SELECT {cols} FROM lineitem)"
_CLASS_SQL = _PREDICTED.format(c="class", cols=", ".join(RULE))
_FLAG_SQL = _PREDICTED.format(c="flag", cols=", ".join(RULE))


def rule(spark, d):
    return table(spark, d, "lineitem").selectExpr(*RULE)


def _predicted(model, rows):
    return model.transform(rows).select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "prediction")


@query("tree_classifier", _CLASS_SQL)
def _(spark, d):
    rows = rule(spark, d)
    return _predicted(models.tree_classifier(rows, ["l_linenumber", "l_tax"], "class", depth=4), rows)


@query("tree_classifier_entropy", _CLASS_SQL)
def _(spark, d):
    rows = rule(spark, d)
    return _predicted(models.tree_classifier(rows, ["l_linenumber", "l_tax"], "class", depth=4, criterion="entropy", weights={0: 2.0, 1: 1.0}), rows)


@query("tree_regressor", _CLASS_SQL)
def _(spark, d):
    rows = rule(spark, d)
    return _predicted(models.tree_regressor(rows, ["l_linenumber", "l_tax"], "class", depth=3), rows)


@query("random_forest", _CLASS_SQL)
def _(spark, d):
    rows = rule(spark, d)
    return _predicted(models.forest(rows, ["l_linenumber"], "class", trees=10, depth=4), rows)


@query("random_forest_regressor", _CLASS_SQL, doubles="prediction")
def _(spark, d):
    rows = rule(spark, d)
    return _predicted(models.forest(rows, ["l_linenumber"], "class", trees=10, depth=4, regression=True), rows)


@query("boosted_trees", _FLAG_SQL)
def _(spark, d):
    rows = rule(spark, d)
    return _predicted(models.gbt(rows, ["l_linenumber", "l_tax"], "flag", trees=3, depth=2), rows)


@query("boosted_trees_three_classes", _CLASS_SQL)
def _(spark, d):
    rows = rule(spark, d)
    return _predicted(models.gbt(rows, ["l_linenumber", "l_tax"], "class", trees=3, depth=3), rows)


@query("boosted_trees_regressor", _CLASS_SQL, doubles="prediction")
def _(spark, d):
    rows = rule(spark, d)
    return _predicted(models.gbt(rows, ["l_linenumber", "l_tax"], "class", trees=3, depth=3, regression=True), rows)


# y on two columns by the normal equations
_LINE = "(SELECT l_extendedprice AS y, l_quantity AS a, l_linenumber AS b FROM lineitem)"


@query("linear_regression", f"""WITH s AS (SELECT avg(y) AS my, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_ FROM {_LINE}),
       c AS (SELECT *, (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS ca, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS cb FROM s)
       SELECT 'a' AS feature, ca AS value FROM c UNION ALL SELECT 'b', cb FROM c UNION ALL SELECT 'intercept', my - ca * ma - cb * mb FROM c""", doubles="value", scale=4)
def _(spark, d):
    rows = table(spark, d, "lineitem").selectExpr("l_extendedprice AS y", "l_quantity AS a", "l_linenumber AS b")
    return models.coefficients(models.linear(rows, ["a", "b"], "y"), ["a", "b"], spark).drop("class")


@query("ridge_regression", f"""WITH s AS (SELECT avg(y) AS my, avg(a) AS ma, covar_pop(a, y) * count(*) AS ay, var_pop(a) * count(*) AS aa FROM {_LINE}), c AS (SELECT *, ay / (aa + 50000.0) AS ca FROM s)
       SELECT 'a' AS feature, ca AS value FROM c UNION ALL SELECT 'intercept', my - ca * ma FROM c""", doubles="value", scale=4)
def _(spark, d):
    rows = table(spark, d, "lineitem").selectExpr("l_extendedprice AS y", "l_quantity AS a")
    return models.coefficients(models.ridge(rows, ["a"], "y", 50000.0), ["a"], spark).drop("class")


@query("lasso_regression", """WITH s AS (SELECT avg(y) AS my, avg(a) AS ma, covar_pop(a, y) AS ay, var_pop(a) AS aa FROM (SELECT l_quantity + 10 * l_linenumber AS y, l_linenumber AS a FROM lineitem)),
       c AS (SELECT *, sign(ay) * greatest(abs(ay) - 7.0, 0) / aa AS ca FROM s)
       SELECT 'a' AS feature, ca AS value FROM c UNION ALL SELECT 'intercept', my - ca * ma FROM c""", doubles="value", scale=4)
def _(spark, d):
    rows = table(spark, d, "lineitem").selectExpr("l_quantity + 10 * l_linenumber AS y", "l_linenumber AS a")
    return models.coefficients(models.lasso(rows, ["a"], "y", 7.0), ["a"], spark).drop("class")


@query("polynomial_ridge", """WITH r AS (SELECT l_extendedprice AS y, l_linenumber AS x, l_linenumber * l_linenumber AS z FROM lineitem),
       s AS (SELECT count(*) AS n, avg(y) AS my, corr(x, z) AS r, covar_pop(x, y) / stddev_pop(x) * count(*) AS c1, covar_pop(z, y) / stddev_pop(z) * count(*) AS c2 FROM r),
       b AS (SELECT *, ((n + 100.0) * c1 - n * r * c2) / ((n + 100.0) * (n + 100.0) - n * r * n * r) AS b1, ((n + 100.0) * c2 - n * r * c1) / ((n + 100.0) * (n + 100.0) - n * r * n * r) AS b2 FROM s)
       SELECT 'x' AS feature, b1 AS value FROM b UNION ALL SELECT 'x*x', b2 FROM b UNION ALL SELECT 'intercept', my FROM b""", doubles="value", scale=3)
def _(spark, d):
    rows = table(spark, d, "lineitem").selectExpr("l_extendedprice AS y", "l_linenumber AS x")
    return models.coefficients(models.polynomial_regression(rows, ["x"], "y", 2, 100.0)[1], ["x", "x*x"], spark).drop("class")


def _optimality(scored, x, beta, c):
    """Gradient of the penalised log loss at the fitted coefficients, per row: zero at the optimum."""
    gap = F.col("prob") - F.col("y")
    return scored.agg(F.abs(F.avg(gap * F.col("w"))).alias("intercept_gradient"),
                      F.abs((F.sum(gap * F.col("w") * F.col(x)) + F.lit(beta / c)) / F.count(F.lit(1))).alias("slope_gradient"))


@query("logistic_regression", "SELECT 0.0 AS intercept_gradient, 0.0 AS slope_gradient FROM lineitem LIMIT 1", doubles="intercept_gradient slope_gradient", scale=5)
def _(spark, d):
    rows = table(spark, d, "lineitem").selectExpr("l_quantity / 25 AS x", "CAST(l_quantity + l_linenumber * 4 > 40 AS INT) AS y")
    model = models.logistic(rows, ["x"], "y", c=0.01)
    scored = model.transform(rows).select("x", "y", F.lit(1.0).alias("w"), models.vector_to_array("probability")[1].alias("prob"))
    return _optimality(scored, "x", float(model.stages[-1].coefficients[0]), 0.01)


@query("logistic_regression_balanced", "SELECT 0.0 AS intercept_gradient, 0.0 AS slope_gradient FROM lineitem LIMIT 1", doubles="intercept_gradient slope_gradient", scale=5)
def _(spark, d):
    rows = table(spark, d, "lineitem").selectExpr("l_quantity / 25 AS x", "CAST(l_quantity + l_linenumber * 4 > 60 AS INT) AS y")
    model = models.logistic(rows, ["x"], "y", c=0.01, weights="balanced")
    out = models.add_weights(model.transform(rows), "y", "balanced")
    return _optimality(out.select("x", "y", F.col(models.WEIGHT).alias("w"), models.vector_to_array("probability")[1].alias("prob")), "x",
                       float(model.stages[-1].coefficients[0]), 0.01)


@query("logistic_regression_three_classes")
def _(spark, d):
    rows = rule(spark, d)
    model = models.logistic(rows, ["l_linenumber", "l_tax"], "class", multinomial=True)
    return models.coefficients(model, ["l_linenumber", "l_tax"], spark)


@query("regression_to_class", """WITH s AS (SELECT avg(y) AS my, avg(x) AS mx, covar_pop(x, y) / var_pop(x) AS b FROM (SELECT l_linenumber AS x, CASE WHEN l_linenumber < 3 THEN 0 WHEN l_linenumber < 6 THEN 1 ELSE 2 END AS y FROM lineitem))
       SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, CAST(greatest(0, least(2, round_even(my + b * (l_linenumber - mx), 0))) AS INTEGER) AS pred_class FROM lineitem, s""")
def _(spark, d):
    rows = rule(spark, d)
    out = models.predict_class(models.linear(rows, ["l_linenumber"], "class"), rows)
    return out.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "pred_class")


@query("feature_importance", "SELECT 'l_linenumber' AS feature, 1.0 AS importance FROM lineitem LIMIT 1", doubles="importance")
def _(spark, d):
    model = models.tree_classifier(rule(spark, d), ["l_linenumber", "l_tax"], "class", depth=4)
    return models.importances(model, ["l_linenumber", "l_tax"], spark, 1)


@query("exported_scores", f"""SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, flag AS y, flag AS pred, CASE WHEN flag = 1 THEN 1 - 1e-8 ELSE 1e-8 END AS prob FROM (SELECT {', '.join(RULE)} FROM lineitem)""", doubles="prob", scale=9)
def _(spark, d):
    rows = rule(spark, d)
    return models.score(models.tree_classifier(rows, ["l_linenumber", "l_tax"], "flag", depth=4), rows, "flag", key=["l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"])


# documents with a quality label: a small table for the searches
def quality_rows(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars", F.size(F.split("text", r"\s+")).cast("double").alias("words"),
                                               F.size(F.split("text", "\n")).cast("double").alias("lines"))
    return table(spark, d, "labels").join(docs, "doc_id").select("doc_id", "quality", F.col("n_chars").cast("double").alias("n_chars"), "words", "lines")


QUALITY_COLS = ["n_chars", "words", "lines"]


@query("forest_grid_search")
def _(spark, d):
    """36 combinations x 3 folds = 108 forests."""
    return forest.forest_search(quality_rows(spark, d), QUALITY_COLS, "quality", ["doc_id"], [50, 100, 200], [6, 8, 10, 12], [2, 5, 10], 3)


# the split of largest Gini gain, from the counts of both sides of every value
_STUMP_COLS = ["l_linenumber", "l_quantity", "l_discount"]
_STUMP_ROWS = "(" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {i} AS place, CAST({c} AS DOUBLE) AS v, l_returnflag AS y FROM lineitem WHERE l_quantity <= 20"
                                       for i, c in enumerate(_STUMP_COLS)) + ")"
_STUMP_SQL = f"""SELECT feature, threshold, n_left, n_right FROM (
  SELECT feature, place, v AS threshold, sum(l) AS n_left, sum(t - l) AS n_right, sum(CAST(l AS DOUBLE) * l) / sum(l) + sum(CAST(t - l AS DOUBLE) * (t - l)) / sum(t - l) AS pure, sum(t) AS n
  FROM (SELECT feature, place, v, y, sum(n) OVER (PARTITION BY feature, y ORDER BY v) AS l, sum(n) OVER (PARTITION BY feature, y) AS t
        FROM (SELECT g.feature, g.place, g.v, k.y, count(r.y) AS n FROM (SELECT DISTINCT feature, place, v FROM {_STUMP_ROWS}) g CROSS JOIN (SELECT DISTINCT y FROM {_STUMP_ROWS}) k
              LEFT JOIN {_STUMP_ROWS} r ON r.feature = g.feature AND r.v = g.v AND r.y = k.y GROUP BY 1, 2, 3, 4))
  GROUP BY 1, 2, 3 HAVING sum(t - l) > 0)
  ORDER BY round(pure / n, 12) DESC, place, threshold LIMIT 1"""


@query("forest_stump", _STUMP_SQL, doubles="threshold n_left n_right")
def _(spark, d):
    """The root split of a tree on all rows."""
    rows = table(spark, d, "lineitem").where("l_quantity <= 20").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_returnflag")
    grown = forest.fit_forest(rows, _STUMP_COLS, "l_returnflag", ["l_orderkey", "l_linenumber", "l_partkey"], trees=1, depth=1, features=None, bootstrap=False)
    nodes = grown.table(spark)
    sides = nodes.select(F.col("node").alias("side"), F.aggregate("counts", F.lit(0.0), lambda a, x: a + x).alias("n"))
    return (nodes.where("feature IS NOT NULL").join(sides.select("side", F.col("n").alias("n_left")), F.col("left_child") == F.col("side")).drop("side")
            .join(sides.select("side", F.col("n").alias("n_right")), F.col("left_child") + 1 == F.col("side")).select("feature", "threshold", "n_left", "n_right"))


@query("boosting_grid_search")
def _(spark, d):
    est = models.GBTRegressor(seed=42)
    return models.grid_search(est, {"maxIter": [3], "maxDepth": [2, 3]}, quality_rows(spark, d), ["n_chars", "lines"], "words", ["doc_id"], folds=3, regression=True)[1]


@query("ridge_random_search")
def _(spark, d):
    return models.random_search(quality_rows(spark, d), ["n_chars", "lines"], "words", ["doc_id"], kind="ridge")


@query("lasso_random_search")
def _(spark, d):
    return models.random_search(quality_rows(spark, d), ["n_chars", "lines"], "words", ["doc_id"], kind="lasso")


@query("logistic_random_search")
def _(spark, d):
    return models.random_search(quality_rows(spark, d), ["n_chars", "lines"], "quality", ["doc_id"], degrees=(2, 7), penalty=(1e-5, 1e5), kind="logistic")


@query("tree_search")
def _(spark, d):
    rows = split.stratified_split(quality_rows(spark, d), ["doc_id"], "quality", 0.3, 1)
    return models.search_tree(rows.where("split = 'train'").drop("split"), rows.where("split = 'test'").drop("split"), QUALITY_COLS, "quality", ["doc_id"],
                              {"depth": [2, 4], "weights": ["balanced"]}, folds=2)


@query("out_of_fold_scores", "SELECT quality AS y, count(*) AS n FROM labels GROUP BY 1")
def _(spark, d):
    oof = models.out_of_fold(quality_rows(spark, d), QUALITY_COLS, "quality", ["doc_id"], folds=3, depth=3)
    return oof.groupBy("y").agg(F.count(F.lit(1)).alias("n"))


@query("regression_fit_quality", f"SELECT regr_r2(y, a) AS r2 FROM {_LINE}", doubles="r2")
def _(spark, d):
    rows = table(spark, d, "lineitem").selectExpr("l_extendedprice AS y", "l_quantity AS a")
    out = models.linear(rows, ["a"], "y").transform(rows)
    return metrics.regression_metrics(out, "y", "prediction").select("r2")
