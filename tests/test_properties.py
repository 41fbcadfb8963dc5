"""Properties, edge cases, and the large-table paths forced on small tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit import sources
from tabkit.functions import ordered, quantiles
from tabkit.functions.runtime import scratch_path
from tabkit.operators import (
    agreement, clean, combine, correlate, dedup, encode, features, impute, metrics, models,
    outliers, profile, project, relabel, scale, split, validate,
)
from tabkit.operators.params import Params


def rows_of(df, *keys):
    return [tuple(r) for r in df.orderBy(*keys).collect()]


# order and quantile primitives ----------------------------------------------------------

@pytest.fixture(scope="module")
def hot(spark):
    """Half of the rows belong to one group, and the first order column has one very frequent value."""
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 11).cast("string")).alias("g"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") * 37 % 101).alias("t"),
        F.when(F.col("id") % 4 == 0, F.col("id") * 1.0).alias("v"))


@pytest.mark.parametrize("part", [[], ["g"]])
def test_ranges_give_the_same_values(hot, part):
    outputs = {"n": ordered.row_number(), "s": ordered.running_sum(F.col("v")), "p": ordered.previous(F.col("v")),
               "l": ordered.last_seen(F.col("v")), "x": ordered.next_seen(F.col("v"))}
    plain = ordered.in_order(hot, part, ["t", "id"], outputs)
    cut = ordered.in_order(hot, part, ["t", "id"], outputs, rows_per_task=60)
    assert rows_of(plain, "id") == rows_of(cut, "id")
    ranged, split_up = ordered.with_ranges(hot, part, ["t", "id"], 60)
    assert split_up
    assert ranged.groupBy(*part, ordered.RANGE).count().agg(F.max("count")).first()[0] < 400


def test_ranges_by_text_and_time(spark):
    df = spark.range(500).select(F.concat(F.lit("k"), (F.col("id") * 7 % 500).cast("string")).alias("k"),
                                 F.timestamp_seconds(F.col("id") * 13 % 500).alias("ts"), (F.col("id") / 3).alias("f"))
    for order in (["k"], ["ts"], ["f"]):
        out = {"n": ordered.row_number()}
        assert rows_of(ordered.in_order(df, [], order, out), *order) == rows_of(ordered.in_order(df, [], order, out, 20), *order)
    with pytest.raises(TypeError):
        ordered.in_order(df.withColumn("a", F.array("k")), [], ["a"], {"n": ordered.row_number()}, 20)


def test_quantiles_narrowed(spark):
    rng = np.random.default_rng(1)
    data = {
        "skewed": np.exp(rng.normal(0, 3, 4000)), "copies": np.where(rng.random(4000) < 0.6, 7.0, np.round(rng.normal(0, 5, 4000), 1)),
        "huge": np.where(rng.random(4000) < 0.01, 1e300, rng.random(4000)), "flat": np.full(4000, 2.5), "grid": rng.integers(0, 5, 4000) * 1.0,
    }
    df = spark.createDataFrame(list(zip(*[map(float, v) for v in data.values()])), ", ".join(f"{c} double" for c in data)) \
        .withColumn("gaps", F.when(F.col("grid") != 1, F.col("skewed"))).withColumn("none", F.lit(None).cast("double"))
    probs = [0.0, 0.013, 0.25, 0.5, 0.6, 0.75, 0.99, 1.0]
    cols = [*data, "gaps"]
    got = quantiles.quantiles(df, cols, probs, limit=50)
    want = quantiles.quantiles(df, cols, probs)
    for c in cols:
        assert got[c] == pytest.approx(want[c], rel=1e-12), c
    for c, v in data.items():
        np.testing.assert_allclose(want[c], np.quantile(v, probs), rtol=1e-12)
    assert quantiles.quantiles(df, ["none", "grid"], [0.5])["none"] is None
    stats = quantiles.order_statistics(df, {"skewed": list(range(0, 4000, 571))}, {"skewed": 4000}, limit=20)
    assert [stats["skewed"][r] for r in range(0, 4000, 571)] == np.sort(data["skewed"])[::571].tolist()


def test_grouped_quantiles_of_a_hot_group(hot):
    rows = hot.withColumn("y", F.col("id") * 31 % 997 * 1.0)
    a = quantiles.grouped_quantiles(rows, ["g"], ["y"], [0.25, 0.5])
    b = quantiles.grouped_quantiles(rows, ["g"], ["y"], [0.25, 0.5], limit=300)
    key = lambda r: str(r["g"])
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)


@pytest.mark.parametrize("name,make", [
    ("ffill", lambda df, n: impute.ffill(df, "v", ["t", "id"], rows_per_task=n)),
    ("interpolate", lambda df, n: impute.interpolate(df, "v", ["t", "id"], ["g"], rows_per_task=n)),
    ("delta", lambda df, n: combine.delta(df, ["g"], ["t", "id"], "v", rows_per_task=n)),
    ("returns", lambda df, n: combine.returns(df, ["g"], ["t", "id"], "t", rows_per_task=n)),
    ("ranks", lambda df, n: combine.ranks(df, "t", ["id"], rows_per_task=n)),
    ("label", lambda df, n: encode.apply_label(df, "t", encode.fit_label(df, "t", rows_per_task=n))),
    ("factorize", lambda df, n: encode.factorize(df, "g", ["id"], rows_per_task=n)),
    ("positions", lambda df, n: project.drop_positions(df, ["t", "id"], [0, 5, 2999], rows_per_task=n)),
])
def test_operators_on_ranges(hot, name, make):
    assert rows_of(make(hot, None), "id") == rows_of(make(hot, 80), "id")


def test_spearman_and_curve_on_ranges(hot, spark):
    cols = ["id", "t", "v"]
    a, b = (sorted(map(tuple, correlate.corr_matrix(hot, cols, "spearman", rows_per_task=n).collect())) for n in (None, 50))
    assert [x[:2] for x in a] == [x[:2] for x in b] and [x[2] for x in a] == pytest.approx([x[2] for x in b])
    scored = hot.select((F.col("id") % 3 == 1).cast("int").alias("y"), (F.col("t") / 101).alias("prob"))
    one, two = (metrics.ranking_metrics(scored, rows_per_task=n).first() for n in (None, 20))
    assert tuple(one) == pytest.approx(tuple(two))
    t1, t2 = (metrics.threshold_table(scored, rows_per_task=n).collect() for n in (None, 40))
    assert t1 == t2


# results do not depend on partitioning --------------------------------------------------

def test_partitioning_does_not_matter(tables):
    orders = tables("orders", "0.001")
    for fn in (lambda t: split.stratified_split(t, ["o_orderkey"], "o_orderstatus", 0.3, 1).select("o_orderkey", "split"),
               lambda t: split.kfold(t, ["o_orderkey"], "o_orderstatus", 4).select("o_orderkey", "fold"),
               lambda t: split.undersample(t, ["o_orderkey"], "o_orderpriority").select("o_orderkey"),
               lambda t: split.bootstrap(t.select("o_orderkey"), ["o_orderkey"], 2),
               lambda t: dedup.drop_duplicates(t, ["o_custkey"], "last", ["o_orderdate", "o_orderkey"]).select("o_orderkey"),
               lambda t: outliers.iqr_report(t, ["o_totalprice"])):
        a, b = fn(orders.repartition(1)), fn(orders.repartition(16))
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_splits(tables):
    orders = tables("orders", "0.001").select("o_orderkey", "o_orderstatus")
    n = {r[0]: r[1] for r in orders.groupBy("o_orderstatus").count().collect()}
    for limit in (None, 30):  # 30 forces the narrowing search for the cut positions
        parts = split.three_way_split(orders, ["o_orderkey"], "o_orderstatus", limit=limit)
        assert parts.count() == orders.count()
        got = {(r[0], r[1]): r[2] for r in parts.groupBy("o_orderstatus", "split").count().collect()}
        for c, m in n.items():
            test, both = math.floor(0.2 * m + 0.5), math.floor(0.4 * m + 0.5)
            assert (got[c, "test"], got[c, "valid"], got[c, "train"]) == (test, both - test, m - both)
    folds = split.kfold(orders, ["o_orderkey"], "o_orderstatus", 3).groupBy("o_orderstatus", "fold").count().collect()
    for c, m in n.items():
        sizes = [r[2] for r in folds if r[0] == c]
        assert sum(sizes) == m and max(sizes) - min(sizes) <= 1 and len(sizes) == 3
    even = split.undersample(orders, ["o_orderkey"], "o_orderstatus").groupBy("o_orderstatus").count().collect()
    assert {r[1] for r in even} == {min(n.values())}
    drawn = split.bootstrap(orders, ["o_orderkey"], 5)
    assert abs(drawn.count() / (5 * orders.count()) - 1) < 0.1
    a = split.random_split(orders, ["o_orderkey"], 0.25, 1).where("split = 'test'").count()
    assert abs(a / orders.count() - 0.25) < 0.05
    with pytest.raises(ValueError):
        split.period_split(orders, "o_orderstatus")


def test_time_split_leaves_null_dates_out(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-06-01"), (3, None)], "id int, d string").withColumn("d", F.to_date("d"))
    import datetime
    got = dict(split.time_split(df, "d", datetime.date(2024, 6, 1)).select("id", "split").collect())
    assert got == {1: "train", 2: "test"}


# fit and apply --------------------------------------------------------------------------

def test_fits_ignore_other_rows(tables):
    items = tables("lineitem", "0.001").select("l_orderkey", "l_quantity", "l_returnflag")
    train, test = items.where("l_orderkey % 2 = 0"), items.where("l_orderkey % 2 = 1")
    wild = test.withColumns({"l_quantity": F.lit(1e9), "l_returnflag": F.lit("new")})
    fitted = scale.fit_preprocessor(train, ["l_quantity"], ["l_returnflag"], ["l_orderkey"])
    out = fitted.transform(train.unionByName(wild))
    hot_cols = [c for c in out.columns if c.startswith("l_returnflag_")]
    assert hot_cols == ["l_returnflag_A", "l_returnflag_N", "l_returnflag_R"]
    total = sum(F.col(c) for c in hot_cols)
    assert {r[0] for r in out.where("l_orderkey % 2 = 0").select(total).distinct().collect()} == {1}
    assert {r[0] for r in out.where("l_orderkey % 2 = 1").select(total).distinct().collect()} == {0}


def test_scaled_columns(tables):
    items = tables("lineitem", "0.001").select("l_quantity", "l_tax")
    z = scale.apply_scaler(items, scale.fit_scaler(items, ["l_quantity", "l_tax"]))
    r = z.agg(F.avg("l_quantity"), F.stddev_pop("l_quantity"), F.avg("l_tax"), F.stddev_pop("l_tax")).first()
    assert list(r) == pytest.approx([0, 1, 0, 1], abs=1e-9)
    m = scale.apply_scaler(items, scale.fit_scaler(items, ["l_tax"], "minmax")).agg(F.min("l_tax"), F.max("l_tax")).first()
    assert list(m) == [0.0, 1.0]
    with pytest.raises(ValueError):
        scale.fit_scaler(items, ["l_tax"], "other")


def test_params_round_trip(spark):
    p = Params({"a": {"center": 1.5, "scale": 2.0}, "b": {"levels": ["x", "ñ"], "fill": None}})
    path = scratch_path(spark, "params")
    sources.save_params(p.to_frame(spark), path)
    assert Params.from_frame(sources.load_params(spark, path)) == p


def test_fills(spark):
    df = spark.createDataFrame([(1, None, None, 2.0), (2, None, "b", 2.0), (3, None, "a", 7.0), (4, None, "a", 7.0), (5, None, "b", None)],
                               "id int, t string, s string, x double")
    out = impute.apply_impute(df, impute.fit_impute(df, ["t", "s", "x"], "mode"))
    assert rows_of(out, "id")[0] == (1, "desconocido", "a", 2.0) and rows_of(out, "id")[4][3] == 2.0  # ties: the smallest
    even = impute.fit_impute(df, ["x"], "median").values["x"]["fill"]
    assert even == 4.5
    gaps = spark.createDataFrame([(1, None), (2, 1.0), (3, None), (4, None), (5, 4.0), (6, None)], "i int, v double")
    assert [r[1] for r in rows_of(impute.interpolate(gaps, "v", ["i"]), "i")] == [None, 1.0, 2.0, 3.0, 4.0, 4.0]
    assert [r[1] for r in rows_of(impute.bfill(gaps, "v", ["i"]), "i")] == [1.0, 1.0, 4.0, 4.0, 4.0, None]
    kept, report = impute.require_label(gaps, "v")
    assert kept.count() == 2 and tuple(report.first()) == (2, 4)


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "y"), (3, 5, "x"), (4, 5, "z"), (5, 6, "q")], "id int, k int, v string")
    assert [r[3] for r in rows_of(dedup.flag_duplicates(df, ["k"], ["id"]), "id")] == [False, True, False, True, False]
    assert rows_of(dedup.drop_duplicates(df, ["k"], "last", ["id"]), "id") == [(2, None, "y"), (4, 5, "z"), (5, 6, "q")]
    assert dedup.count_duplicates(df, ["k"]).first()[0] == 2
    with pytest.raises(ValueError):
        dedup.drop_duplicates(df, ["k"])


def test_not_a_number_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (-float("inf"),), (1.0,), (None,)], "x double")
    assert clean.inf_to_null(df, ["x"]).where("x is not null").count() == 1
    text = spark.createDataFrame([("NaN",), ("Infinity",), ("1e3",), (" 2 ",), ("x",)], "x string")
    assert sorted(r[0] for r in clean.coerce_numeric(text, ["x"]).where("x is not null").collect()) == [2.0, 1000.0]


def test_coerce_thresholds(spark):
    def kind(values, **kw):
        df = spark.createDataFrame([(v,) for v in values], "x string")
        return dict(clean.coerce_if(df, **kw).dtypes)["x"]
    assert kind(["1", "2", "3", "4", "a"], min_ratio=0.8) == "double"
    assert kind(["1", "2", "3", None, "a"], min_ratio=0.8) == "string"  # nulls count against
    assert kind(["1", "2", None], min_ratio=1.0, of_filled=True) == "double"
    assert kind(["1", "b"], min_ratio=1.0, of_filled=True) == "string"
    assert kind(["a", "b"]) == "string" and kind(["a", "2"]) == "double"


def test_encoders(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "c"), (5, "b")], "id int, k string")
    codes = encode.fit_label(df, "k")
    assert [r[1] for r in rows_of(encode.apply_label(df, "k", codes), "id")] == [1, None, 0, 2, 1]
    assert [r[1] for r in rows_of(encode.apply_label(df, "k", codes.where("value <> 'c'"), unknown=-1), "id")] == [1, -1, 0, -1, 1]
    bits = encode.apply_binary(df, "k", encode.fit_binary(df, "k"))
    assert rows_of(bits, "id") == [(1, 1, 0), (2, 0, 0), (3, 0, 1), (4, 1, 1), (5, 1, 0)]
    assert [r[2] for r in rows_of(encode.factorize(df, "k", ["id"]), "id")] == [0, -1, 1, 2, 0]
    with pytest.raises(ValueError):
        encode.fit_onehot(df, ["k"], cap=2)
    stress = spark.createDataFrame([("Low",), ("High",), ("Moderate",)], "s string")
    assert sorted(r[1] for r in encode.encode_ordinal(stress, "s").collect()) == [0, 1, 2]


# reports --------------------------------------------------------------------------------

def test_report_edges(spark):
    one = spark.createDataFrame([(3.0, None), (3.0, None)], "x double, e double")
    assert profile.histogram(one, "x", 4).agg(F.sum("n")).first()[0] == 2
    assert [r["column"] for r in outliers.iqr_report(one, ["x", "e"]).collect()] == ["x"]
    assert profile.skewness(one, ["x"]).first()["skewness"] is None
    assert correlate.corr_matrix(one.withColumn("y", F.lit(1.0)), ["x", "y"]).first()["r"] is None
    g1 = profile.skewness(spark.createDataFrame([(float(v),) for v in (1, 2, 4, 9, 30)], "x double"), ["x"]).first()["skewness"]
    assert g1 == pytest.approx(1.899, abs=1e-3)
    with pytest.raises(ValueError):
        profile.levels(spark.range(20), "id", 10)
    null_keys = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "k string, v double")
    assert profile.group_mean(null_keys, ["k"], ["v"]).collect()[0][1] == 2.0
    assert {r["value"]: r["n"] for r in profile.value_counts(null_keys, "k").collect()} == {None: 1, "a": 1}
    odd = spark.createDataFrame([(1.0, 2)], ["0-60 MPH Time (seconds)", "a.b"])
    assert profile.missing_report(odd).count() == 2 and profile.describe(odd, odd.columns).count() == 2


def test_contracts(spark, tables):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "a int, b double")
    with pytest.raises(ValueError, match="no_nulls"):
        validate.require_contract(df, no_nulls=True)
    assert validate.require_contract(df, required=["a"]) is df
    with pytest.raises(ValueError, match="unmapped"):
        validate.unmapped(df, "a", [1], fail=True)
    with pytest.raises(ValueError):
        project.select_features(df, drop=["a", "b"])
    with pytest.raises(ValueError):
        validate.require_periods(df, "a", 4)
    report = {r["column"]: r["n_outside"] for r in validate.range_report(df, {"b": (0, 2), "zzz": (0, 1)}).collect()}
    assert report == {"b": 1, "zzz": None}


def test_bucket_case_null_takes_the_last_branch(spark):
    from tabkit.functions.scalars import bucket_case
    df = spark.createDataFrame([(4,), (6,), (9,), (None,)], "q int")
    assert [r[0] for r in df.select(bucket_case(F.col("q"), [(5, 1), (6, 2)], 3)).collect()] == [1, 2, 3, 3]


# files ----------------------------------------------------------------------------------

def test_csv_details(spark, tmp_path):
    (tmp_path / "b.csv").write_bytes("x;y\n1;2\n".encode())
    (tmp_path / "a.csv").write_bytes("﻿age,name\n1,José\n2,Ana\n".encode("utf-8"))
    (tmp_path / "z").mkdir()
    first = sources.first_csv(spark, str(tmp_path))
    assert first.columns == ["age", "name"] and rows_of(first, "age") == [(1, "José"), (2, "Ana")]
    assert sources.read_csv(spark, str(tmp_path / "b.csv")).collect()[0] == (1, 2)
    (tmp_path / "z" / "l.csv").write_bytes("n\nmañana\n".encode("latin-1"))
    assert sources.read_csv(spark, str(tmp_path / "z" / "l.csv")).first()[0] == "mañana"
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        sources.first_csv(spark, str(tmp_path / "empty"))
    (tmp_path / "choice.txt").write_text("Best: Fuzzy c-means\nthen DBSCAN\n")
    assert sources.selected_model(spark, str(tmp_path / "choice.txt")) == ("dbscan", "cluster_dbscan")
    (tmp_path / "none.txt").write_text("nothing\n")
    with pytest.raises(ValueError):
        sources.selected_model(spark, str(tmp_path / "none.txt"))


def test_model_files(spark):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(20)], "x double, y int")
    model = models.tree_classifier(df, ["x"], "y", depth=5)
    path = scratch_path(spark, "model")
    sources.save_pipeline(model, path)
    again = sources.load_pipeline(path)
    assert [r.prediction for r in again.transform(df).collect()] == [r.prediction for r in model.transform(df).collect()]


# metrics and agreement ------------------------------------------------------------------

def test_metric_edges(spark):
    one_class = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, prob double")
    r = metrics.evaluate(one_class, 0.5).first()
    assert r["roc_auc"] is None and r["specificity"] is None and r["balanced_accuracy"] == 0.5 and r["pr_auc"] == 1.0
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)], "y int, prob double")
    r = metrics.ranking_metrics(tied).first()
    assert r["roc_auc"] == 0.5 and r["pr_auc"] == 0.5
    assert metrics.ranking_metrics(tied.withColumn("y", F.lit(0))).first()["pr_auc"] == 0.0
    assert metrics.selection_score(metrics.evaluate(one_class)).first()["selection_score"] is not None
    best = metrics.select_threshold(spark.createDataFrame([(0, 0.1), (0, 0.45), (1, 0.47), (1, 0.9)], "y int, prob double"))
    assert best == 0.454  # the rounded 0.4 quantile; the midpoint 0.46 scores the same, the smaller one wins


def test_agreement_edges(spark):
    df = spark.createDataFrame([(i % 3, i % 3, 0, i) for i in range(12)], "a int, b int, c int, d int")
    assert agreement.ari(df, "a", "b").first()[0] == 1.0
    assert agreement.ari(df, "c", "c").first()[0] == 1.0
    assert agreement.mutual_info(df, "a", "c").first()["homogeneity"] == 0.0
    assert agreement.mutual_info(df, "c", "a").first()["homogeneity"] == 1.0
    assert agreement.mutual_info(df, "a", "d").first()["homogeneity"] == pytest.approx(1.0)
    noise = df.withColumn("b", F.lit(-1))
    r = agreement.agreement(noise, "a", "b").first()
    assert r["n_clusters"] == 0 and r["n_noise"] == 12 and r["n"] == 12 and r["purity"] == 0.0
    assert agreement.cluster_balance(noise, "b").first()[0] == 0.0


def test_uncovered_class_gets_a_cluster(spark):
    rows = [(0, "Low")] * 6 + [(0, "High")] * 4 + [(1, "Low")] * 7 + [(1, "Moderate")] * 3 + [(2, "Moderate")] * 9 + [(2, "High")] * 1
    df = spark.createDataFrame(rows, "c int, s string")
    # dominant labels are Low, Low, Moderate; High goes to the free cluster with the largest share of it
    assert relabel.map_clusters_to_labels(df, "c", "s", ["Low", "Moderate", "High"]) == {0: "High", 1: "Low", 2: "Moderate"}
    out = relabel.relabel(df, "c", "s", {0: "High", 1: "Low"})  # cluster 2 unmapped: original label stays
    assert out.where("c = 2 and label_changed").count() == 0
    report = {r["label"]: tuple(r)[1:] for r in relabel.change_report(out, "s").collect()}
    assert report["Moderate"] == (12, 3, 25.0, "Low") and report["High"] == (5, 0, 0.0, "Sin cambios") and report["Low"] == (13, 6, 46.15, "High")
    assert relabel.change_level(out).first()["level"] == "ok"
    assert combine.same_set(out.select("s"), out.select(F.col("corrected").alias("s")), "s")


# models ---------------------------------------------------------------------------------

def test_penalties(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(80, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=80) + 3
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    xc, yc = x - x.mean(0), y - y.mean()
    got = {r["feature"]: r["value"] for r in models.coefficients(models.ridge(df, ["a", "b", "c"], "y", 4.0), ["a", "b", "c"], spark).collect()}
    np.testing.assert_allclose([got["a"], got["b"], got["c"]], np.linalg.solve(xc.T @ xc + 4 * np.eye(3), xc.T @ yc), atol=1e-9)
    got = models.coefficients(models.lasso(df, ["a", "b", "c"], "y", 0.3), ["a", "b", "c"], spark).collect()
    beta = np.array([r["value"] for r in got[:3]])
    grad = xc.T @ (yc - xc @ beta) / 80
    for b, g in zip(beta, grad):
        assert (abs(g) <= 0.3 + 1e-5) if abs(b) < 1e-9 else g == pytest.approx(0.3 * np.sign(b), abs=1e-5)


@pytest.mark.parametrize("weights", [None, "balanced", {0: 3.0, 1: 0.5}])
def test_logistic_against_newton(spark, weights):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(120, 2))
    y = (x[:, 0] + rng.normal(size=120) > 0.6).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], "a double, b double, y int")
    n = np.bincount(y)
    w = np.ones(120) if weights is None else np.array([120 / (2 * n[v]) if weights == "balanced" else weights[int(v)] for v in y])
    z, beta = np.hstack([x, np.ones((120, 1))]), np.zeros(3)
    penalty = np.diag([1 / 0.7, 1 / 0.7, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ beta))
        beta -= np.linalg.solve(z.T @ (z * (w * p * (1 - p))[:, None]) + penalty, z.T @ (w * (p - y)) + penalty @ beta)
    got = [r["value"] for r in models.coefficients(models.logistic(df, ["a", "b"], "y", 0.7, weights), ["a", "b"], spark).collect()]
    np.testing.assert_allclose(got, beta, atol=1e-5)


def test_log_features(spark):
    df = spark.createDataFrame([(float(v), -float(v)) for v in (0, 1, 1, 2, 2, 3, 90)], "x double, neg double")
    out, report = features.log_skewed(df, ["x", "neg"])
    assert out.columns == ["x", "neg", "x_log10"]
    assert {r["column"]: r["transformed"] for r in report.collect()} == {"x": True, "neg": False}


def test_family(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (None, 1)], "a int, b int")
    assert [tuple(r)[2:] for r in features.family_features(df, "a", "b").collect()] == [(1, 1), (4, 0), (None, 0)]


# types, gaps and many values --------------------------------------------------------------

def test_separator_of_quoted_header():
    from tabkit.sources.readers import separator_of
    assert separator_of('id;"price, usd"', (",", ";")) == ";"
    assert separator_of('id,"a;b",c', (",", ";")) == ","
    assert separator_of("one", (",", ";")) == ","


def test_csv_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,price,flag,day,note\n1,NaN,true,2024-01-02,"a\nb"\n2,N/A,,2024-01-03,"say ""x"""\n3,inf,false,,None\n4,1.5,true,2024-02-01,007 x\n')
    df = sources.read_csv(spark, f"{tmp_path}/a.csv", multiline=True)
    assert df.dtypes == [("id", "int"), ("price", "double"), ("flag", "boolean"), ("day", "date"), ("note", "string")]
    rows = df.orderBy("id").collect()
    assert [r["price"] for r in rows] == [None, None, None, 1.5] and [r["flag"] for r in rows] == [True, None, False, True]
    assert [r["note"] for r in rows] == ["a\nb", 'say "x"', None, "007 x"]


def test_modes_keep_their_type(spark):
    import datetime

    from tabkit.operators import impute
    day, big = datetime.date(2024, 5, 1), 2**60 + 1
    df = spark.createDataFrame([(True, day, big, "a"), (True, day, big, "a"), (False, None, 3, None), (None, None, None, "b")], "f boolean, d date, n long, s string")
    out = impute.apply_impute(df, impute.fit_impute(df, df.columns, "mode"))
    assert out.dtypes == df.dtypes and out.where("f and d is not null and n > 3").count() == 3
    assert out.where(f"n = {big}").count() == 3 and out.where("s is null").count() == 0
    kinds = {r["column"]: r["count"] for r in profile.describe_all(df).collect()}
    assert kinds == {"n": 3, "s": 3, "f": 3, "d": 2}


def test_one_hot_order_and_empty_report(spark):
    df = spark.createDataFrame([(10,), (2,), (None,)], "g int")
    assert encode.fit_onehot(df, ["g"]).values["g"]["levels"] == ["2", "10"]
    empty = spark.createDataFrame([(None,)], "x double")
    assert outliers.iqr_report(empty, ["x"]).count() == 0


def test_large_value_map(spark):
    df = spark.range(200).selectExpr("id", "id * 2 AS other")
    out = combine.map_values(df, "id", {i: f"v{i}" for i in range(100)}, "m")
    assert out.columns == ["id", "other", "m"] and out.where("m = concat('v', id)").count() == 100 and out.where("m is null").count() == 100


def test_potentials_prune_beyond_reach(spark):
    from tabkit.operators import cluster
    df = spark.range(3_000).selectExpr("id", "CAST(id % 50 AS DOUBLE) * 40 AS x", "CAST(id % 7 AS DOUBLE) AS y")
    got = {r["id"]: r["potential"] for r in cluster.potentials(df, "id", 2.0, ["x", "y"]).collect()}
    p = np.array([[i % 50 * 40.0, float(i % 7)] for i in range(3_000)])
    for i in list(got)[:20]:
        assert abs(got[i] - np.exp(-np.square(p - p[i]).sum(1)).sum()) < 1e-8
