"""Queries: supervised metrics, agreement of labelings, relabelling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import agreement, cluster, metrics, models, relabel
from .combine import _unit
from .registry import query, table

# scored rows: deterministic score with many ties, derived from the line items
SCORED = ["CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y", "l_quantity / 50.0 * 0.9 + l_discount AS prob"]
SCORED_SQL = f"(SELECT {', '.join(SCORED)} FROM lineitem)"
# three classes; the predicted class X never occurs and R is never predicted
CLASSES = ["l_returnflag AS y", "CASE WHEN l_quantity < 17 THEN 'A' WHEN l_quantity < 45 THEN 'N' ELSE 'X' END AS pred"]
CLASSES_SQL = f"(SELECT {', '.join(CLASSES)} FROM lineitem)"


def scored(spark, d):
    return table(spark, d, "lineitem").selectExpr(*SCORED)


def classes(spark, d):
    return table(spark, d, "lineitem").selectExpr(*CLASSES)


_REPORT = f"""SELECT l AS label, coalesce(tp / nullif(p, 0), 0) AS precision, coalesce(tp / nullif(s, 0), 0) AS recall, coalesce(2.0 * tp / nullif(s + p, 0), 0) AS f1, s AS support, tp
      FROM (SELECT l, (SELECT count(*) FROM {CLASSES_SQL} WHERE y = l) AS s, (SELECT count(*) FROM {CLASSES_SQL} WHERE pred = l) AS p,
      (SELECT count(*) FROM {CLASSES_SQL} WHERE y = l AND pred = l) AS tp FROM (VALUES ('A'), ('N'), ('R'), ('X')) t(l))"""


@query("class_report", _REPORT, doubles="precision recall f1")
def _(spark, d):
    return metrics.class_report(classes(spark, d))


@query("class_metrics_macro", f"SELECT sum(tp) / sum(support) AS accuracy, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1 FROM ({_REPORT})", doubles="accuracy precision recall f1")
def _(spark, d):
    return metrics.class_metrics(classes(spark, d), "macro")


@query("class_metrics_weighted", f"""SELECT sum(tp) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS precision, sum(recall * support) / sum(support) AS recall,
       sum(f1 * support) / sum(support) AS f1 FROM ({_REPORT})""", doubles="accuracy precision recall f1")
def _(spark, d):
    return metrics.class_metrics(classes(spark, d), "weighted")


@query("confusion_matrix", f"""SELECT a.l AS actual, b.l AS predicted, (SELECT count(*) FROM {CLASSES_SQL} WHERE y = a.l AND pred = b.l) AS n
       FROM (VALUES ('A'), ('N'), ('R'), ('X')) a(l), (VALUES ('A'), ('N'), ('R'), ('X')) b(l)""")
def _(spark, d):
    return metrics.confusion(classes(spark, d), ["A", "N", "R", "X"])


_MANY = "(SELECT l_suppkey AS y, l_partkey % 100 + 1 AS pred FROM lineitem)"


@query("confusion_many_labels", f"""SELECT a.y AS actual, b.y AS predicted, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT y FROM {_MANY}) a CROSS JOIN (SELECT DISTINCT y FROM {_MANY}) b
       LEFT JOIN (SELECT y, pred, count(*) AS n FROM {_MANY} GROUP BY 1, 2) c ON c.y = a.y AND c.pred = b.y""")
def _(spark, d):
    rows = table(spark, d, "lineitem").selectExpr("l_suppkey AS y", "l_partkey % 100 + 1 AS pred")
    return metrics.confusion(rows, rows.select("y").distinct())


_CLIPPED = f"(SELECT y, greatest(1e-8, least(1 - 1e-8, prob)) AS p FROM {SCORED_SQL})"


def _binary_sql(threshold):
    return f"""SELECT n, prevalence, CAST({threshold} AS DOUBLE) AS threshold, tn, fp, fn, tp, (tp + tn) / n AS accuracy, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS balanced_accuracy,
      coalesce(tp / nullif(tp + fp, 0), 0) AS precision, tp / (tp + fn) AS recall, tn / (tn + fp) AS specificity, tn / nullif(tn + fn, 0) AS npv,
      coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, brier, log_loss FROM (SELECT count(*) AS n, avg(y) AS prevalence,
      count(*) FILTER (y = 1 AND p >= {threshold}) AS tp, count(*) FILTER (y = 0 AND p >= {threshold}) AS fp, count(*) FILTER (y = 1 AND p < {threshold}) AS fn,
      count(*) FILTER (y = 0 AND p < {threshold}) AS tn, avg((p - y) * (p - y)) AS brier, avg(-CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END) AS log_loss FROM {_CLIPPED})"""


BINARY = "prevalence accuracy balanced_accuracy precision recall specificity npv f1 brier log_loss"


@query("binary_metrics", _binary_sql(0.5), doubles=BINARY)
def _(spark, d):
    return metrics.binary_metrics(scored(spark, d), 0.5)


@query("binary_metrics_nothing_predicted", _binary_sql(2.0), doubles=BINARY)
def _(spark, d):
    return metrics.binary_metrics(scored(spark, d), 2.0)


_AUC = """(SELECT (sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))) FROM
       (SELECT y, rank() OVER (ORDER BY {s}) + (count(*) OVER (PARTITION BY {s}) - 1) / 2.0 AS rk FROM {t}))"""
_AP = """(SELECT sum(pos * tp / (tp + fp)) / sum(pos) FROM (SELECT pos, sum(pos) OVER (ORDER BY {s} DESC) AS tp, sum(neg) OVER (ORDER BY {s} DESC) AS fp
       FROM (SELECT {s}, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM {t} GROUP BY 1)))"""


@query("ranking_metrics", f"SELECT {_AUC.format(s='prob', t=SCORED_SQL)} AS roc_auc, {_AP.format(s='prob', t=SCORED_SQL)} AS pr_auc", doubles="roc_auc pr_auc")
def _(spark, d):
    return metrics.ranking_metrics(scored(spark, d))


@query("ranking_metrics_one_class", "SELECT CAST(NULL AS DOUBLE) AS roc_auc, 1.0 AS pr_auc FROM lineitem LIMIT 1", doubles="roc_auc pr_auc")
def _(spark, d):
    return metrics.ranking_metrics(scored(spark, d).withColumn("y", F.lit(1)))


@query("score_curve", f"""SELECT prob AS score, pos, neg, CAST(sum(pos) OVER (ORDER BY prob DESC) AS BIGINT) AS tp, CAST(sum(neg) OVER (ORDER BY prob DESC) AS BIGINT) AS fp
       FROM (SELECT prob, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM {SCORED_SQL} GROUP BY 1)""", doubles="score", scale=9)
def _(spark, d):
    return metrics.score_curve(scored(spark, d))


@query("document_quality_scores", f"""WITH s AS (SELECT quality AS y, floor(100 * n_chars / (n_chars + 2000)) / 100 AS prob FROM labels JOIN documents USING (doc_id))
       SELECT {_AUC.format(s='prob', t='s')} AS roc_auc, {_AP.format(s='prob', t='s')} AS pr_auc""", doubles="roc_auc pr_auc")
def _(spark, d):
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return metrics.ranking_metrics(rows.select(F.col("quality").alias("y"), (F.floor(100 * F.col("n_chars") / (F.col("n_chars") + 2000)) / 100).alias("prob")))


@query("binary_evaluation", f"SELECT m.*, {_AUC.format(s='p', t=_CLIPPED)} AS roc_auc, {_AP.format(s='p', t=_CLIPPED)} AS pr_auc FROM ({_binary_sql(0.4)}) m", doubles=BINARY + " roc_auc pr_auc")
def _(spark, d):
    return metrics.evaluate(scored(spark, d), 0.4)


_CANDIDATES = f"""(SELECT unnest([0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7]) AS threshold UNION SELECT unnest([round_even(x, 3) FOR x IN q]) FROM (SELECT quantile_cont(prob, [0.2, 0.4, 0.6, 0.8]) AS q FROM {SCORED_SQL})
       UNION SELECT round_even((s + p) / 2, 6) FROM (SELECT s, lag(s) OVER (ORDER BY s) AS p FROM (SELECT DISTINCT round_even(prob, 6) AS s FROM {SCORED_SQL})) WHERE p IS NOT NULL)"""


_FULL_CANDIDATES = f"""(SELECT DISTINCT round(threshold, 9) AS threshold FROM (SELECT unnest([0.2 + 0.6 * i / 24 FOR i IN range(25)]) AS threshold UNION SELECT 0.5
       UNION SELECT round_even(prob, 3) FROM {SCORED_SQL} WHERE prob IS NOT NULL
       UNION SELECT round_even((s + p) / 2, 6) FROM (SELECT s, lag(s) OVER (ORDER BY s) AS p FROM (SELECT DISTINCT round_even(prob, 6) AS s FROM {SCORED_SQL})) WHERE p IS NOT NULL))"""


def _thresholds_sql(candidates):
    return f"""SELECT threshold, tn, fp, fn, tp, (tp + tn) / (tp + tn + fp + fn) AS accuracy, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS balanced_accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
       tp / (tp + fn) AS recall, tn / (tn + fp) AS specificity, tn / nullif(tn + fn, 0) AS npv, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM (
       SELECT threshold, count(*) FILTER (y = 1 AND p >= threshold) AS tp, count(*) FILTER (y = 0 AND p >= threshold) AS fp, count(*) FILTER (y = 1 AND p < threshold) AS fn,
       count(*) FILTER (y = 0 AND p < threshold) AS tn FROM {_CLIPPED}, {candidates} GROUP BY 1)"""


@query("threshold_table", _thresholds_sql(_CANDIDATES), doubles="threshold accuracy balanced_accuracy precision recall specificity npv f1")
def _(spark, d):
    return metrics.threshold_table(scored(spark, d))


@query("threshold_table_full", _thresholds_sql(_FULL_CANDIDATES), doubles="threshold accuracy balanced_accuracy precision recall specificity npv f1")
def _(spark, d):
    return metrics.threshold_table(scored(spark, d), full=True)


@query("selection_score", f"""SELECT n, 0.28 * f1 + 0.22 * balanced_accuracy + 0.18 * specificity + 0.17 * {_AP.format(s='p', t=_CLIPPED)} + 0.10 * {_AUC.format(s='p', t=_CLIPPED)} + 0.05 * (1 - brier) AS selection_score
       FROM ({_binary_sql(0.5)})""", doubles="selection_score")
def _(spark, d):
    return metrics.selection_score(metrics.evaluate(scored(spark, d))).select("n", "selection_score")


@query("regression_metrics", """SELECT avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2
       FROM (SELECT l_extendedprice AS y, l_quantity * 2100 AS p FROM lineitem)""", doubles="mae rmse r2", scale=4)
def _(spark, d):
    return metrics.regression_metrics(table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2100).alias("pred")))


# accuracy of three rules on three parts of the line items, as a metrics table
_RULES = {"by_quantity": "l_quantity > 25", "by_tax": "l_tax > 0.04", "by_line": "l_linenumber > 4"}
_PART = "CASE WHEN l_orderkey % 10 < 6 THEN 'train' WHEN l_orderkey % 10 < 8 THEN 'valid' ELSE 'test' END"
_RULE_SQL = " UNION ALL ".join(f"SELECT '{m}' AS model, {_PART} AS split, avg(CASE WHEN ({r}) = (l_returnflag = 'R') THEN 1.0 ELSE 0.0 END) AS accuracy FROM lineitem GROUP BY 2" for m, r in _RULES.items())


def rule_metrics(spark, d):
    rows = table(spark, d, "lineitem").withColumn("split", F.expr(_PART))
    hits = rows.groupBy("split").agg(*[F.avg((F.expr(r) == (F.col("l_returnflag") == "R")).cast("double")).alias(m) for m, r in _RULES.items()])
    return hits.unpivot(["split"], list(_RULES), "model", "accuracy")


@query("best_model", f"SELECT * FROM ({_RULE_SQL}) WHERE split = 'test' ORDER BY accuracy DESC, model LIMIT 1", doubles="accuracy")
def _(spark, d):
    return metrics.best_model(rule_metrics(spark, d).where("split = 'test'"), "accuracy").select("model", "split", "accuracy")


@query("model_comparison", f"""SELECT model, any_value(accuracy) FILTER (split = 'train') AS train, any_value(accuracy) FILTER (split = 'valid') AS valid, any_value(accuracy) FILTER (split = 'test') AS test,
       any_value(accuracy) FILTER (split = 'train') - any_value(accuracy) FILTER (split = 'test') AS gap FROM ({_RULE_SQL}) GROUP BY 1""", doubles="train valid test gap")
def _(spark, d):
    return metrics.comparison(rule_metrics(spark, d))


@query("label_comparison", f"""SELECT model, any_value(accuracy) FILTER (split = 'train') AS original_accuracy, any_value(accuracy) FILTER (split = 'test') AS corrected_accuracy,
       any_value(accuracy) FILTER (split = 'test') - any_value(accuracy) FILTER (split = 'train') AS delta_accuracy FROM ({_RULE_SQL}) GROUP BY 1""", doubles="original_accuracy corrected_accuracy delta_accuracy")
def _(spark, d):
    rows = rule_metrics(spark, d).where("split <> 'valid'")
    named = rows.select("model", F.when(F.col("split") == "train", "original").otherwise("corrected").alias("labels"), "accuracy")
    return models.compare_labels(named, ["accuracy"])


# agreement ------------------------------------------------------------------------------

# truth: return flag as a number; cluster: bands of quantity, with a noise band
LABELED = ["l_suppkey % 7 AS unit", "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS truth",
           "CASE WHEN l_tax > 0.07 THEN -1 WHEN l_returnflag = 'A' AND l_linenumber < 5 THEN 0 WHEN l_quantity < 20 THEN 1 WHEN l_quantity < 40 THEN 2 ELSE 3 END AS cluster",
           "CASE WHEN l_linenumber < 4 THEN 0 WHEN l_returnflag = 'R' THEN 1 ELSE 2 END AS other"]
LABELED_SQL = f"(SELECT {', '.join(LABELED)} FROM lineitem)"
_KEPT = f"(SELECT * FROM {LABELED_SQL} WHERE cluster <> -1)"


def labeled(spark, d):
    return table(spark, d, "lineitem").selectExpr(*LABELED)


_ARI = """(SELECT (ij - pa * pb / t) / ((pa + pb) / 2 - pa * pb / t) FROM (SELECT (SELECT sum(n * (n - 1) / 2) FROM (SELECT count(*) AS n FROM {t} GROUP BY truth, cluster)) AS ij,
       (SELECT sum(n * (n - 1) / 2) FROM (SELECT count(*) AS n FROM {t} GROUP BY truth)) AS pa, (SELECT sum(n * (n - 1) / 2) FROM (SELECT count(*) AS n FROM {t} GROUP BY cluster)) AS pb,
       (SELECT count(*) * (count(*) - 1) / 2 FROM {t}) AS t))"""
_INFO = """(SELECT mi / ((ha + hb) / 2) AS nmi, mi / ha AS homogeneity, mi / hb AS completeness, 2 * (mi / ha) * (mi / hb) / (mi / ha + mi / hb) AS v_measure FROM (SELECT
       (SELECT sum(p * ln(p / (pa * pb))) FROM (SELECT n / sum(n) OVER () AS p, sum(n) OVER (PARTITION BY truth) / sum(n) OVER () AS pa, sum(n) OVER (PARTITION BY cluster) / sum(n) OVER () AS pb
         FROM (SELECT truth, cluster, count(*) AS n FROM {t} GROUP BY 1, 2))) AS mi,
       (SELECT -sum(p * ln(p)) FROM (SELECT count(*) / sum(count(*)) OVER () AS p FROM {t} GROUP BY truth)) AS ha, (SELECT -sum(p * ln(p)) FROM (SELECT count(*) / sum(count(*)) OVER () AS p FROM {t} GROUP BY cluster)) AS hb))"""
_PURITY = "(SELECT avg(m / s) AS purity, count(*) AS n_clusters FROM (SELECT cluster, max(n) AS m, sum(n) AS s FROM (SELECT cluster, truth, count(*) AS n FROM {t} GROUP BY 1, 2) GROUP BY 1))"


@query("adjusted_rand_index", f"SELECT {_ARI.format(t=_KEPT)} AS ari", doubles="ari")
def _(spark, d):
    return agreement.ari(labeled(spark, d), "truth", "cluster")


@query("mutual_information", f"SELECT * FROM {_INFO.format(t=_KEPT)}", doubles="nmi homogeneity completeness v_measure")
def _(spark, d):
    return agreement.mutual_info(labeled(spark, d), "truth", "cluster")


@query("cluster_purity", f"SELECT * FROM {_PURITY.format(t=_KEPT)}", doubles="purity")
def _(spark, d):
    return agreement.purity(labeled(spark, d), "truth", "cluster")


@query("agreement_report", f"""SELECT (SELECT count(*) FROM {LABELED_SQL}) AS n, (SELECT count(*) FROM {LABELED_SQL} WHERE cluster = -1) AS n_noise, n_clusters, {_ARI.format(t=_KEPT)} AS ari,
       i.*, purity FROM {_PURITY.format(t=_KEPT)}, {_INFO.format(t=_KEPT)} i""", doubles="ari nmi homogeneity completeness v_measure purity")
def _(spark, d):
    return agreement.agreement(labeled(spark, d), "truth", "cluster")


@query("embedding_agreement", f"""WITH t AS (SELECT label AS truth, CASE WHEN embedding[1] < -0.05 THEN 0 WHEN embedding[1] < 0.05 THEN 1 ELSE 2 END AS cluster FROM embeddings)
       SELECT {_ARI.format(t="t")} AS ari""", doubles="ari")
def _(spark, d):
    x = F.col("embedding")[0]
    rows = table(spark, d, "embeddings").select(F.col("label").alias("truth"), F.when(x < -0.05, 0).when(x < 0.05, 1).otherwise(2).alias("cluster"))
    return agreement.ari(rows, "truth", "cluster")


@query("truth_cluster_counts", f"SELECT truth AS a, cluster AS b, count(*) AS n FROM {_KEPT} GROUP BY 1, 2")
def _(spark, d):
    return agreement.contingency(labeled(spark, d), "truth", "cluster")


def _majority(c):
    return f"(SELECT cluster, truth AS majority FROM (SELECT {c} AS cluster, truth, row_number() OVER (PARTITION BY {c} ORDER BY count(*) DESC, truth) AS rn FROM {LABELED_SQL} GROUP BY 1, 2) WHERE rn = 1)"


def _unit_errors(c):
    return f"""(SELECT unit, count(*) AS n, CAST(sum((truth <> majority)::INT) AS BIGINT) AS errors, 100.0 * sum((truth <> majority)::INT) / count(*) AS error_pct FROM {LABELED_SQL} t JOIN {_majority(c)} m ON t.{c} = m.cluster GROUP BY 1)"""


@query("majority_class_map", f"SELECT * FROM {_majority('cluster')}")
def _(spark, d):
    return agreement.majority_map(labeled(spark, d), "truth", "cluster")


@query("majority_errors_by_unit", f"SELECT * FROM {_unit_errors('cluster')}", doubles="error_pct")
def _(spark, d):
    return agreement.majority_errors(labeled(spark, d), "truth", "cluster", "unit")


@query("two_model_consensus", f"""SELECT a.unit, a.n, a.errors AS errors_a, a.error_pct AS error_pct_a, b.errors AS errors_b, b.error_pct AS error_pct_b, (a.error_pct + b.error_pct) / 2 AS error_pct_mean
       FROM {_unit_errors('cluster')} a JOIN {_unit_errors('other')} b ON a.unit = b.unit""", doubles="error_pct_a error_pct_b error_pct_mean")
def _(spark, d):
    from ..operators.combine import consensus
    rows = labeled(spark, d)
    return consensus(agreement.majority_errors(rows, "truth", "cluster", "unit"), agreement.majority_errors(rows, "truth", "other", "unit"), "unit")


@query("purity_verdict", f"""SELECT purity AS best_purity, CASE WHEN purity > 0.8 THEN 'well labelled' WHEN purity > 0.6 THEN 'partial structure' ELSE 'not well labelled' END AS verdict
       FROM (SELECT max(purity) AS purity FROM (SELECT purity FROM {_PURITY.format(t=_KEPT)} UNION ALL SELECT purity FROM {_PURITY.format(t="(SELECT truth, other AS cluster FROM " + LABELED_SQL + ")")}))""", doubles="best_purity")
def _(spark, d):
    rows = labeled(spark, d)
    return agreement.purity_verdict(agreement.purity(rows, "truth", "cluster").unionByName(agreement.purity(rows, "truth", "other")))


_BALANCE = "(SELECT -sum(p * ln(p + 1e-12)) / ln(count(*)) FROM (SELECT count(*) / sum(count(*)) OVER () AS p FROM {t} GROUP BY cluster))"


@query("cluster_balance", f"SELECT {_BALANCE.format(t=_KEPT)} AS balance", doubles="balance")
def _(spark, d):
    return agreement.cluster_balance(labeled(spark, d), "cluster")


@query("algorithm_choice", f"""SELECT algorithm, balance, silhouette, n_noise, n, 0.6 * coalesce(silhouette, -1) + 0.3 * balance - 0.1 * n_noise / n AS score FROM (
       SELECT 'bands' AS algorithm, {_BALANCE.format(t=_KEPT)} AS balance, CAST(0.25 AS DOUBLE) AS silhouette, (SELECT count(*) FROM {LABELED_SQL} WHERE cluster = -1) AS n_noise, (SELECT count(*) FROM lineitem) AS n
       UNION ALL SELECT 'other', {_BALANCE.format(t="(SELECT other AS cluster FROM " + LABELED_SQL + ")")}, NULL, 0, (SELECT count(*) FROM lineitem))""", doubles="balance silhouette score")
def _(spark, d):
    rows = labeled(spark, d)
    one = lambda name, c, s: (cluster.cluster_counts(rows, c).select("n", "n_noise").withColumns({
        "algorithm": F.lit(name), "balance": agreement.cluster_balance(rows, c).scalar(), "silhouette": F.lit(s).cast("double")}))
    return cluster.select_clustering(one("bands", "cluster", 0.25).unionByName(one("other", "other", None)))


# relabelling ----------------------------------------------------------------------------

# label by value band, cluster by event type and band, so that all three labels dominate somewhere
STRESS = ["event_id", "CASE WHEN value < 15 THEN 'Low' WHEN value < 60 THEN 'Moderate' ELSE 'High' END AS label",
          "CASE WHEN value < 12 THEN 0 WHEN value < 65 AND event_type <> 'view' THEN 1 WHEN value < 40 THEN 2 WHEN event_type = 'click' THEN -1 ELSE 3 END AS cluster"]
STRESS_SQL = f"(SELECT {', '.join(STRESS)} FROM events)"
_DOMINANT = f"(SELECT cluster, label FROM (SELECT cluster, label, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, label) AS rn FROM {STRESS_SQL} GROUP BY 1, 2) WHERE rn = 1)"
_CODE = "CASE {c} WHEN 'Low' THEN 0 WHEN 'Moderate' THEN 1 WHEN 'High' THEN 2 END"
_RELABELED = f"(SELECT s.event_id, s.label, s.cluster, m.label AS corrected, CAST({_CODE.format(c='m.label')} AS INTEGER) AS corrected_code, s.label <> m.label AS label_changed FROM {STRESS_SQL} s JOIN {_DOMINANT} m ON s.cluster = m.cluster)"


def relabeled(spark, d):
    rows = table(spark, d, "events").selectExpr(*STRESS)
    return relabel.relabel(rows, "cluster", "label", relabel.map_clusters_to_labels(rows, "cluster", "label", ["Low", "Moderate", "High"]))


@query("cluster_label_shares", f"SELECT cluster, label, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY cluster) AS share FROM {STRESS_SQL} GROUP BY 1, 2", doubles="share")
def _(spark, d):
    return relabel.cluster_shares(table(spark, d, "events").selectExpr(*STRESS), "cluster", "label")


@query("corrected_labels", f"SELECT event_id, label, cluster, corrected, corrected_code, label_changed FROM {_RELABELED}")
def _(spark, d):
    return relabeled(spark, d)


@query("label_change_report", f"""SELECT label, count(*) AS n_rows, count(*) FILTER (label_changed) AS n_changed, round(100.0 * count(*) FILTER (label_changed) / count(*), 2) AS pct_changed,
       coalesce((SELECT corrected FROM {_RELABELED} x WHERE x.label = r.label AND label_changed GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), 'Sin cambios') AS main_destination FROM {_RELABELED} r GROUP BY 1""")
def _(spark, d):
    return relabel.change_report(relabeled(spark, d), "label")


@query("label_change_level", f"""SELECT count(*) AS n_rows, count(*) FILTER (label_changed) AS n_changed, 100.0 * count(*) FILTER (label_changed) / count(*) AS pct_changed,
       CASE WHEN 100.0 * count(*) FILTER (label_changed) / count(*) <= 30 THEN 'ok' WHEN 100.0 * count(*) FILTER (label_changed) / count(*) <= 50 THEN 'high' ELSE 'critical' END AS level FROM {_RELABELED}""", doubles="pct_changed")
def _(spark, d):
    return relabel.change_level(relabeled(spark, d))


@query("lost_labels", f"SELECT DISTINCT label FROM {STRESS_SQL} EXCEPT SELECT 'Low' FROM {_RELABELED}")
def _(spark, d):
    # every row mapped to Low: the other two labels are lost
    rows = table(spark, d, "events").selectExpr(*STRESS).withColumn("corrected", F.lit("Low"))
    return relabel.lost_classes(rows, "label")


@query("label_transitions", f"""SELECT a.l AS before, b.l AS after, (SELECT count(*) FROM {_RELABELED} WHERE label = a.l AND corrected = b.l) AS n FROM (VALUES ('Low'), ('Moderate'), ('High')) a(l),
       (VALUES ('Low'), ('Moderate'), ('High')) b(l)""")
def _(spark, d):
    return relabel.transition(relabeled(spark, d), "label")


@query("homogeneity_before_after", f"""SELECT 'before' AS labels, homogeneity FROM {_INFO.format(t="(SELECT label AS truth, cluster FROM " + STRESS_SQL + ")")}
       UNION ALL SELECT 'after', homogeneity FROM {_INFO.format(t="(SELECT corrected AS truth, cluster FROM " + _RELABELED + ")")}""", doubles="homogeneity")
def _(spark, d):
    rows = relabeled(spark, d)
    one = lambda name, c: agreement.mutual_info(rows, c, "cluster", noise=None).select(F.lit(name).alias("labels"), "homogeneity")
    return one("before", "label").unionByName(one("after", "corrected"))


@query("cross_validation_report", f"""WITH f AS (SELECT *, (rn > n * 1 // 4)::INT + (rn > n * 2 // 4)::INT + (rn > n * 3 // 4)::INT AS fold FROM (SELECT doc_id, quality, n_chars,
         row_number() OVER (PARTITION BY quality ORDER BY {_unit('doc_id', 42)}) AS rn, count(*) OVER (PARTITION BY quality) AS n FROM labels JOIN documents USING (doc_id))),
       m AS (SELECT k AS fold, (SELECT avg(n_chars) FROM f WHERE fold <> k) AS cut FROM range(4) t(k)),
       p AS (SELECT f.fold, quality AS y, CASE WHEN n_chars > cut / 4 THEN 1 ELSE 0 END AS pred FROM f JOIN m ON f.fold = m.fold),
       s AS (SELECT fold, avg((y = pred)::INT) AS acc, (coalesce(2.0 * count(*) FILTER (y = 1 AND pred = 1) / nullif(count(*) FILTER (y = 1) + count(*) FILTER (pred = 1), 0), 0)
         + coalesce(2.0 * count(*) FILTER (y = 0 AND pred = 0) / nullif(count(*) FILTER (y = 0) + count(*) FILTER (pred = 0), 0), 0)) / 2 AS f1 FROM p GROUP BY 1)
       SELECT avg(acc) AS accuracy_mean, stddev_pop(acc) AS accuracy_std, avg(f1) AS f1_mean, stddev_pop(f1) AS f1_std, count(*) AS n_folds FROM s""", doubles="accuracy_mean accuracy_std f1_mean f1_std")
def _(spark, d):
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id").select("doc_id", "quality", "n_chars")

    def fit(train):  # a rule learned from the training rows: longer than a quarter of their mean length
        cut = train.agg(F.avg("n_chars")).first()[0]
        return lambda held: held.withColumn("prediction", F.when(F.col("n_chars") > cut / 4, 1.0).otherwise(0.0))
    return models.cv_report(fit, rows, "quality", ["doc_id"], 4, 42)
