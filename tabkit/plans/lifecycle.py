"""Whole preparations: profile-clean-transform, temporal classification, cluster-driven relabelling.

Each function composes operators on the caller's table; the queries at the end run them on the
given tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import (
    agreement, clean, cluster, combine, correlate, dedup, encode, features, impute, metrics, models,
    outliers, profile, project, quality, relabel, scale, split, validate,
)
from ..functions.runtime import col, cut_lineage
from ..operators.params import Params
from .combine import panel, _PANEL
from .learn import blobs
from .registry import query, table


# profile, explore, transform, prepare ---------------------------------------------------

def explore(df: DataFrame, numeric: list[str], categorical: list[str] = (), pairs: list[tuple[str, str]] = (),
            group: tuple[str, str] | None = None) -> dict[str, DataFrame]:
    """Report tables of one data set; bounds are computed once and shared."""
    bounds = outliers.iqr_bounds(df, numeric)
    out = {
        "measures": profile.measures(df, numeric),
        "quantiles": profile.quantile_table(df, numeric, [i / 100 for i in (1, 5, 10, 20, 25, 30, 40, 50, 60, 70, 75, 80, 90, 95, 99)]),
        "iqr": outliers.iqr_report(df, numeric, bounds=bounds),
        "impact": outliers.outlier_impact(df, numeric),
        "skewness": profile.skewness(df, numeric),
        "pearson": correlate.corr_matrix(df, numeric),
        "spearman": correlate.corr_matrix(df, numeric, "spearman"),
        "high_pairs": correlate.corr_pairs(df, numeric),
    }
    if pairs:
        out["named_pairs"] = correlate.corr_named(df, list(pairs))
    for c in categorical:
        out[f"counts_{c}"] = profile.value_counts(df, c)
    if group:
        out["group_mean"] = profile.group_mean(df, [group[0]], [group[1]])
    return out


def prepare(df: DataFrame, label: str, drop: list[str], preferred: dict[str, int] | None = None,
            scaler: str = "standard") -> tuple[DataFrame, Params]:
    """Drop columns and duplicates, keep complete cases, encode the label, sort and scale features."""
    rows = dedup.drop_duplicates(project.drop_columns(df, drop))
    names = [c for c in project.columns_of(rows, "numeric") if c != label]
    rows = impute.complete_cases(rows, [*names, label])
    coded = encode.encode_ordinal(rows, label, preferred)
    fitted = scale.fit_scaler(coded, names, scaler)
    out = scale.apply_scaler(coded, fitted)
    return out.select(*sorted(names), project.col(label), project.col(f"{label}_code")), fitted


# temporal classification ----------------------------------------------------------------

@dataclass(frozen=True)
class TemporalSplits:
    raw: dict[str, DataFrame]
    model: dict[str, DataFrame]
    features: list[str]
    caps: Params
    weights: dict
    dropped_labels: int


def temporal_splits(df: DataFrame, unit: str = "unidad", time: str = "anio", label: str = "label") -> TemporalSplits:
    """Clean, derive features, split by period, then cap, impute, scale and encode with what the
    training periods alone say."""
    rows = project.normalize_names(df)
    text = [c for c in project.columns_of(rows, "text")]
    rows = clean.tokens_to_null(rows, text, ["", "nan"])
    rows = clean.coerce_if(rows, [c for c in text if c not in (unit, time, label)])
    rows = clean.to_int(clean.coerce_numeric(rows, [time, label]), [time, label], "round")
    rows = dedup.drop_duplicates(rows)
    rows, report = impute.require_label(rows, label)
    dropped = report.first()["n_dropped"]
    rows = cut_lineage(features.panel_features(rows, unit, time))  # read by every fit below
    parts = split.period_split(rows, time)
    train = parts.where(F.col("split") == "train")
    numeric = [c for c in project.columns_of(rows, "numeric") if c != label]
    categorical = project.columns_of(rows, "categorical")
    caps = outliers.fit_iqr_cap(train, numeric)
    capped = outliers.apply_iqr_cap(parts, caps)
    fitted = scale.fit_preprocessor(capped.where(F.col("split") == "train"), numeric, categorical, [label, "split"], "median", "robust")
    ready = cut_lineage(fitted.transform(capped))
    weights = {r["label"]: r["weight"] for r in profile.class_weights(train, label).collect()}  # one row per class
    names = ["train", "valid", "test", "holdout"]
    feature_names = [c for c in ready.columns if c not in (label, "split")]
    return TemporalSplits({n: parts.where(F.col("split") == n).drop("split") for n in names},
                          {n: ready.where(F.col("split") == n).drop("split") for n in names}, feature_names, caps, weights, dropped)


def temporal_model(splits: TemporalSplits, label: str, depth: int = 4, weights="balanced") -> DataFrame:
    """Tree fitted on train, threshold from valid, all metrics per split."""
    model = models.tree_classifier(splits.model["train"], splits.features, label, depth, weights=weights)
    threshold = metrics.select_threshold(models.score(model, splits.model["valid"], label))
    parts = [metrics.evaluate(models.score(model, rows, label), threshold).withColumn("split", F.lit(name))
             for name, rows in splits.model.items()]
    return combine.union_all(parts)


# cluster-driven relabelling -------------------------------------------------------------

def student_checks(df: DataFrame, hours: list[str], grade: str) -> tuple[DataFrame, DataFrame]:
    """Range and daily-sum checks."""
    rules = {**{h: validate.HOURS for h in hours}, grade: validate.GRADE}
    return validate.range_report(df, rules), validate.rowsum_report(df, hours, validate.HOURS[1])


def cluster_and_choose(df: DataFrame, key: str, cols: list[str], k: int = 3, eps: float | None = None, min_samples: int = 5,
                       metric: str = "squared", candidates: int | None = None) -> tuple[DataFrame, DataFrame, str]:
    """Four algorithms on scaled columns: rows with all labels, metric table best first, winning column."""
    from ..operators.neighbors import k_distance
    tables = {"kmeans": cluster.kmeans(df, k, cols)[0]}
    eps = eps or cluster.suggest_eps(k_distance(df, key, min_samples, cols))
    tables["dbscan"] = cluster.dbscan(df, key, eps, min_samples, cols)
    tables["fuzzy"] = cluster.fuzzy_cmeans(df, key, k, cols)[0]
    tables["subtractive"] = cluster.subtractive(df, key, cols=cols, candidates=candidates)[0]
    rows = cluster.with_clusters(df, key, tables)
    table_ = cluster.select_clustering(combine.union_all(
        [quality.cluster_metrics(rows, name, key, f"cluster_{name}", cols, metric=metric) for name in tables]))
    return rows, table_, f"cluster_{table_.first()['algorithm']}"


def relabel_by_cluster(df: DataFrame, column: str, label: str, classes: list[str]) -> dict[str, DataFrame]:
    """Corrected labels with their reports."""
    mapping = relabel.map_clusters_to_labels(df, column, label, classes)
    rows = relabel.relabel(df, column, label, mapping)
    return {"rows": rows, "changes": relabel.change_report(rows, label), "level": relabel.change_level(rows),
            "transitions": relabel.transition(rows, label), "lost": relabel.lost_classes(rows, label),
            "agreement": agreement.mutual_info(rows, "corrected", column, noise=None)}


def label_effect(rows: DataFrame, key: str, cols: list[str], before: str, after: str) -> DataFrame:
    """The same split and the same models with the original and the corrected labels. The split rows are written once, with the columns
    that models and scores read: every fit and every score passes over them several times."""
    parts = cut_lineage(split.stratified_split(rows, [key], before, 0.2, 42).select(*[col(c) for c in dict.fromkeys([*cols, before, after])], "split"))
    out = []
    for name, y in (("original", before), ("corrected", after)):
        train, test = parts.where("split = 'train'"), parts.where("split = 'test'")
        fits = {"tree": models.tree_classifier(train, cols, y), "logistic": models.logistic(train, cols, y, weights="balanced")}
        for model_name, model in fits.items():
            scored = model.transform(test).select(F.col(y).cast("double").alias("y"), F.col("prediction").alias("pred"))
            out.append(metrics.class_metrics(scored).withColumns({"model": F.lit(model_name), "labels": F.lit(name)}))
        linear = models.predict_class(models.linear(train, cols, y), test)
        out.append(metrics.class_metrics(linear.select(F.col(y).cast("int").alias("y"), F.col("pred_class").alias("pred")))
                   .withColumns({"model": F.lit("linear"), "labels": F.lit(name)}))
    return models.compare_labels(combine.union_all(out), ["accuracy", "f1"])


# on the given tables --------------------------------------------------------------------

@query("prepared_table", f"""WITH t AS (SELECT l_quantity, l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax, l_returnflag FROM lineitem GROUP BY ALL)
       SELECT (l_discount - avg(l_discount) OVER ()) / stddev_pop(l_discount) OVER () AS l_discount, (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS l_quantity,
       (l_tax - avg(l_tax) OVER ()) / stddev_pop(l_tax) OVER () AS l_tax, l_returnflag, dense_rank() OVER (ORDER BY l_returnflag) - 1 AS l_returnflag_code FROM t""", doubles="l_discount l_quantity l_tax")
def _(spark, d):
    rows = table(spark, d, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_orderkey")
    return prepare(rows, "l_returnflag", ["l_orderkey"])[0]


@query("exploration_reports", """SELECT 'skewness' AS report, 'value' AS item, skewness(value) AS number FROM events
       UNION ALL SELECT 'group_mean', event_type, avg(value) FROM events GROUP BY 2 UNION ALL SELECT 'pearson', 'event_id,value', corr(event_id, value) FROM events
       UNION ALL SELECT 'counts', event_type, count(*) FROM events GROUP BY 2""", doubles="number", scale=5)
def _(spark, d):
    made = explore(table(spark, d, "events").select("event_id", "value", "event_type"), ["event_id", "value"], ["event_type"], group=("event_type", "value"))
    return combine.union_all([
        made["skewness"].where(F.col("column") == "value").select(F.lit("skewness").alias("report"), F.col("column").alias("item"), F.col("skewness").alias("number")),
        made["group_mean"].select(F.lit("group_mean").alias("report"), F.col("event_type").alias("item"), F.col("mean_value").alias("number")),
        made["pearson"].select(F.lit("pearson").alias("report"), F.concat_ws(",", "a", "b").alias("item"), F.col("r").alias("number")),
        made["counts_event_type"].select(F.lit("counts").alias("report"), F.col("value").alias("item"), F.col("n").cast("double").alias("number"))])


def _labelled_panel(spark, d):
    return panel(spark, d).withColumn("label", (F.col("dias_efectivo") % 2 == 0).cast("int"))


@query("temporal_training_table", f"""WITH f AS (SELECT *, gp_ratio - lag(gp_ratio) OVER (PARTITION BY unidad ORDER BY anio) AS delta, dense_rank() OVER (ORDER BY anio DESC) AS age FROM ({_PANEL})),
       q AS (SELECT quantile_cont(delta, 0.25) AS q1, quantile_cont(delta, 0.75) AS q3, quantile_cont(liquidez, 0.25) AS l1, quantile_cont(liquidez, 0.75) AS l3 FROM f WHERE age > 3),
       c AS (SELECT f.*, greatest(l1 - 1.5 * (l3 - l1), least(l3 + 1.5 * (l3 - l1), liquidez)) AS lq,
         CASE WHEN delta IS NOT NULL THEN greatest(q1 - 1.5 * (q3 - q1), least(q3 + 1.5 * (q3 - q1), delta)) END AS dl FROM f, q),
       m AS (SELECT quantile_cont(dl, 0.5) AS med FROM c WHERE age > 3),
       r AS (SELECT quantile_cont(coalesce(dl, med), 0.25) AS a, quantile_cont(coalesce(dl, med), 0.5) AS b, quantile_cont(coalesce(dl, med), 0.75) AS e,
         quantile_cont(lq, 0.25) AS la, quantile_cont(lq, 0.5) AS lb, quantile_cont(lq, 0.75) AS le FROM c, m WHERE age > 3)
       SELECT CASE age WHEN 1 THEN 'holdout' WHEN 2 THEN 'test' WHEN 3 THEN 'valid' ELSE 'train' END AS split, CAST(dias_efectivo % 2 = 0 AS INTEGER) AS label, (lq - lb) / (le - la) AS liquidez,
       (coalesce(dl, med) - b) / (e - a) AS delta_gp_ratio_anual, CAST(unidad = '7' AS INTEGER) AS unidad_7 FROM c, m, r""", doubles="liquidez delta_gp_ratio_anual", scale=5)
def _(spark, d):
    made = temporal_splits(_labelled_panel(spark, d))
    return combine.union_all([t.select(F.lit(n).alias("split"), F.col("label").cast("int").alias("label"), "liquidez", "delta_gp_ratio_anual", "unidad_7")
                              for n, t in made.model.items()])


@query("temporal_classification", f"""SELECT CASE age WHEN 1 THEN 'holdout' WHEN 2 THEN 'test' WHEN 3 THEN 'valid' ELSE 'train' END AS split, count(*) AS n, avg((dias_efectivo % 2 = 0)::INT) AS prevalence
       FROM (SELECT *, dense_rank() OVER (ORDER BY anio DESC) AS age FROM ({_PANEL})) GROUP BY 1""", doubles="prevalence")
def _(spark, d):
    # the numbers that do not depend on the fitted tree are compared; the rest is tested on fixtures
    made = temporal_splits(_labelled_panel(spark, d))
    return temporal_model(made, "label").select("split", "n", "prevalence")


_GROUP = "CASE event_type WHEN 'click' THEN 'Low' WHEN 'view' THEN 'Moderate' ELSE 'High' END"
_LABEL = "CASE event_type WHEN 'click' THEN 'Low' WHEN 'view' THEN CASE WHEN value < 5 THEN 'Low' ELSE 'Moderate' END ELSE CASE WHEN value < 10 THEN 'Moderate' ELSE 'High' END END"


@query("cluster_relabelling", f"""SELECT label, count(*) AS n_rows, count(*) FILTER (label <> g) AS n_changed, round(100.0 * count(*) FILTER (label <> g) / count(*), 2) AS pct_changed,
       CASE WHEN count(*) FILTER (label <> g) = 0 THEN 'Sin cambios' WHEN label = 'Low' THEN 'Moderate' ELSE 'High' END AS main_destination FROM (SELECT {_LABEL} AS label, {_GROUP} AS g FROM events) GROUP BY 1""")
def _(spark, d):
    rows = cluster.kmeans(blobs(spark, d), 3, ["x", "y"], n_init=5)[0]
    return relabel_by_cluster(rows, "cluster", "label", list(encode.STRESS_CODES))["changes"]


@query("label_effect_on_models")
def _(spark, d):
    rows = cluster.kmeans(blobs(spark, d), 3, ["x", "y"], n_init=3)[0]
    made = relabel_by_cluster(rows, "cluster", "label", list(encode.STRESS_CODES))["rows"]
    coded = combine.map_values(made, "label", encode.STRESS_CODES, "label_code")
    return label_effect(coded, "event_id", ["x", "y"], "label_code", "corrected_code")
