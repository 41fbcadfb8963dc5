"""Queries: data validation, profiling, outliers, correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import correlate, outliers, profile, validate
from . import dirty
from .registry import query, table

I, O, E, D = dirty.ITEMS_SQL, dirty.ORDERS_SQL, dirty.EVENTS_SQL, dirty.DOUBLED_SQL
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(parts):
    return " UNION ALL ".join(parts)


# validation -----------------------------------------------------------------------------

RULES = {"quantity": (5.0, 45.0), "price": (1000.0, 90000.0), "not_there": (0.0, 1.0)}


@query("range_report", _union([f"""SELECT '{c}' AS "column", CAST({lo} AS DOUBLE) AS low, CAST({hi} AS DOUBLE) AS high,
       count(*) FILTER ({c} < {lo} OR {c} > {hi}) AS n_outside, 100.0 * count(*) FILTER ({c} < {lo} OR {c} > {hi}) / count(*) AS pct_outside FROM ({I})"""
       for c, (lo, hi) in RULES.items() if c != "not_there"] + ["SELECT 'not_there', 0.0, 1.0, NULL, NULL"]), doubles="low high pct_outside")
def _(spark, d):
    return validate.range_report(dirty.items(spark, d), RULES)


@query("rowsum_report", f"""SELECT count(*) AS n_rows, count(*) FILTER (s > 40) AS n_over, 100.0 * count(*) FILTER (s > 40) / count(*) AS pct_over
       FROM (SELECT coalesce(quantity, 0) + coalesce(l_linenumber, 0) AS s FROM ({I}))""", doubles="pct_over")
def _(spark, d):
    return validate.rowsum_report(dirty.items(spark, d), ["quantity", "l_linenumber"], 40.0)


@query("domain_report", """SELECT 'o_orderkey' AS "column", count(DISTINCT o_orderkey) AS n_unique, count(DISTINCT o_orderkey) = count(o_orderkey) AS is_unique FROM orders
       UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus), count(DISTINCT o_orderstatus) = count(o_orderstatus) FROM orders
       UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority), count(DISTINCT o_orderpriority) = count(o_orderpriority) FROM orders""")
def _(spark, d):
    return validate.domain_report(table(spark, d, "orders"), ["o_orderkey", "o_orderstatus", "o_orderpriority"])


@query("domain_values", """SELECT 'o_custkey' AS "column", CAST(o_custkey AS VARCHAR) AS value, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey
       UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority""")
def _(spark, d):
    return validate.domain_values(table(spark, d, "orders"), ["o_custkey", "o_orderpriority"])


@query("unmapped_values", "SELECT o_orderpriority AS value, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1")
def _(spark, d):
    return validate.unmapped(table(spark, d, "orders"), "o_orderpriority", {"1-URGENT": 0, "2-HIGH": 1})


@query("scaling_report", _union([f"""SELECT '{c}' AS "column", avg(z) AS mean, {std}(z) AS std, {ok} AS is_standardised FROM (SELECT ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS z FROM lineitem)"""
       for c, std, ok in (("l_quantity", "stddev_pop", "true"), ("l_tax", "stddev_pop", "true"))] + [
       """SELECT 'l_extendedprice', avg(l_extendedprice), stddev_pop(l_extendedprice), false FROM lineitem"""]), doubles="mean std", scale=4)
def _(spark, d):
    from ..operators.scale import apply_scaler, fit_scaler
    rows = table(spark, d, "lineitem").select("l_quantity", "l_tax", "l_extendedprice")
    return validate.scaling_report(apply_scaler(rows, fit_scaler(rows, ["l_quantity", "l_tax"])), ["l_quantity", "l_tax", "l_extendedprice"])


@query("scaling_report_strict", """SELECT 'z' AS "column", avg(z) AS mean, stddev_samp(z) AS std, true AS is_standardised
       FROM (SELECT (value - avg(value) OVER ()) / stddev_samp(value) OVER () AS z FROM events)
       UNION ALL SELECT 'half', avg(z) / 2, stddev_samp(z) / 2, false FROM (SELECT (value - avg(value) OVER ()) / stddev_samp(value) OVER () AS z FROM events)""",
       doubles="mean std")
def _(spark, d):
    rows = table(spark, d, "events")
    m, s = rows.agg(F.avg("value"), F.stddev_samp("value")).first()
    z = (F.col("value") - m) / s
    return validate.scaling_report(rows.select(z.alias("z"), (z / 2).alias("half")), ["z", "half"], "strict")


@query("input_contract", f"""SELECT 'required_columns' AS "check", true AS ok UNION ALL SELECT 'numeric_only', false UNION ALL SELECT 'same_columns', true
       UNION ALL SELECT 'non_empty', count(*) > 0 FROM ({I}) UNION ALL SELECT 'no_nulls', bool_and(quantity IS NOT NULL) FROM ({I})
       UNION ALL SELECT 'same_rows', (SELECT count(*) FROM ({I})) = (SELECT count(*) FROM orders)""")
def _(spark, d):
    rows = dirty.items(spark, d)
    return validate.check_contract(rows, required=["quantity", "price"], numeric_only=True, no_nulls=True,
                                   same_rows_as=table(spark, d, "orders"), same_columns_as=rows)


NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "quantity", "price", "discount", "tax"]


def _describe_sql(cols, source):
    return _union([f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min,
        quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM ({source})""" for c in cols])


_FLAT = f"SELECT {', '.join(NUMERIC)}, flag FROM ({I})"


@query("dataset_overview", f"""WITH t AS ({_FLAT}), s AS ({_describe_sql(NUMERIC, "SELECT * FROM t")})
       SELECT '*' AS "column", 'n_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM t UNION ALL SELECT '*', 'n_cols', 9.0
       UNION ALL SELECT '*', 'n_duplicates', (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t))
       UNION ALL {_union([f"SELECT '{c}', 'n_missing', count(*) - count({c}) FROM t UNION ALL SELECT '{c}', 'pct_missing', 100.0 * (count(*) - count({c})) / count(*) FROM t" for c in [*NUMERIC, "flag"]])}
       UNION ALL {_union([f'SELECT "column", {chr(39)}{m}{chr(39)}, "{m}" FROM s' for m in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")])}
       UNION ALL SELECT 'quantity', 'n_outside', count(*) FILTER (quantity < 5 OR quantity > 45) FROM t
       UNION ALL SELECT 'quantity', 'pct_outside', 100.0 * count(*) FILTER (quantity < 5 OR quantity > 45) / count(*) FROM t""", doubles="value", scale=4)
def _(spark, d):
    return validate.overview(dirty.items(spark, d).select(*NUMERIC, "flag"), {"quantity": (5.0, 45.0)})


@query("period_count_check", "SELECT year, count(*) AS n FROM (SELECT CAST(extract(year FROM o_orderdate) AS INTEGER) AS year FROM orders) GROUP BY 1")
def _(spark, d):
    rows = table(spark, d, "orders").select(F.year("o_orderdate").alias("year"))
    return validate.require_periods(rows, "year", 4).groupBy("year").agg(F.count(F.lit(1)).alias("n"))


# profiling ------------------------------------------------------------------------------

MISSING = ["quantity", "price", "flag", "tax", "empty"]


@query("missing_report", _union([f"""SELECT '{c}' AS "column", count(*) - count({c}) AS n_missing, 100.0 * (count(*) - count({c})) / count(*) AS pct_missing FROM ({I})""" for c in MISSING]),
       doubles="pct_missing")
def _(spark, d):
    return profile.missing_report(dirty.items(spark, d), MISSING)


@query("describe", _describe_sql(MEASURES, "SELECT * FROM lineitem"), doubles="mean std min q25 q50 q75 max", scale=4)
def _(spark, d):
    return profile.describe(table(spark, d, "lineitem"), MEASURES)


@query("describe_all", _union([f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS q25,
       quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS max, NULL AS top, CAST(NULL AS BIGINT) AS freq, CAST(NULL AS BIGINT) AS n_unique FROM part""" for c in ("p_size", "p_retailprice")]
       + [f"""SELECT '{c}', (SELECT count({c}) FROM part), NULL, NULL, NULL, NULL, NULL, NULL, NULL, {c}, n, (SELECT count(DISTINCT {c}) FROM part) FROM
       (SELECT {c}, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, {c} LIMIT 1)""" for c in ("p_brand", "p_type")]), doubles="mean std min q25 q50 q75 max", scale=4)
def _(spark, d):
    return profile.describe_all(table(spark, d, "part").select("p_size", "p_retailprice", "p_brand", "p_type"))


@query("measures", _union([f"""SELECT '{c}' AS "column", avg({c}) AS mean, quantile_cont({c}, 0.5) AS median, stddev_samp({c}) AS std, var_samp({c}) AS variance, CAST(min({c}) AS DOUBLE) AS min,
       CAST(max({c}) AS DOUBLE) AS max, (SELECT {c} FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1) AS mode FROM lineitem""" for c in MEASURES]),
       doubles="mean median std variance min max mode", scale=3)
def _(spark, d):
    return profile.measures(table(spark, d, "lineitem"), MEASURES)


PROBS = [0.0, 0.01, 0.1, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.9, 0.99, 1.0]


@query("quantiles", _union([f"""SELECT '{c}' AS "column", p AS prob, v AS value FROM (SELECT unnest({PROBS}) AS p, unnest(quantile_cont({c}, {PROBS})) AS v FROM lineitem)""" for c in MEASURES]),
       doubles="value prob")
def _(spark, d):
    return profile.quantile_table(table(spark, d, "lineitem"), MEASURES, PROBS)


@query("skewness", _union([f"""SELECT '{c}' AS "column", skewness({c}) AS skewness, abs(skewness({c})) < 0.5 AS is_symmetric FROM {t}""" for c, t in
       (("value", "events"), ("l_quantity", "(SELECT l_quantity FROM lineitem)"))][:1]), doubles="skewness")
def _(spark, d):
    return profile.skewness(table(spark, d, "events"), ["value"])


@query("skewness_many", _union([f"""SELECT '{c}' AS "column", skewness({c}) AS skewness, abs(skewness({c})) < 0.5 AS is_symmetric FROM lineitem""" for c in MEASURES]), doubles="skewness")
def _(spark, d):
    return profile.skewness(table(spark, d, "lineitem"), MEASURES)


@query("distinct_counts", _union([f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_unique FROM ({I})""" for c in ("l_partkey", "quantity", "flag", "empty", "same")]))
def _(spark, d):
    return profile.nunique(dirty.items(spark, d), ["l_partkey", "quantity", "flag", "empty", "same"])


@query("value_counts", f"SELECT flag AS value, count(*) AS n, 100.0 * count(*) / (SELECT count(*) FROM lineitem) AS pct FROM ({I}) GROUP BY 1", doubles="pct")
def _(spark, d):
    return profile.value_counts(dirty.items(spark, d), "flag")


@query("modes_per_group", """SELECT n_name, "column", value AS top, n AS freq, k AS n_unique FROM (
       SELECT n_name, "column", value, n, count(*) OVER (PARTITION BY n_name, "column") AS k,
         row_number() OVER (PARTITION BY n_name, "column" ORDER BY n DESC, value) AS rn FROM (
         SELECT n_name, 'c_mktsegment' AS "column", c_mktsegment AS value, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3)) WHERE rn = 1""")
def _(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return profile.modes(rows, ["c_mktsegment"], ["n_name"])


@query("group_mean", f"SELECT flag, status, avg(price) AS mean_price, avg(quantity) AS mean_quantity FROM ({I}) WHERE flag IS NOT NULL GROUP BY 1, 2", doubles="mean_price mean_quantity", scale=4)
def _(spark, d):
    return profile.group_mean(dirty.items(spark, d), ["flag", "status"], ["price", "quantity"])


@query("error_by_group", """SELECT o_orderpriority, count(*) AS n, CAST(sum(e) AS BIGINT) AS errors, 100.0 * sum(e) / count(*) AS error_pct
       FROM (SELECT o_orderpriority, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS e FROM orders) GROUP BY 1""", doubles="error_pct")
def _(spark, d):
    rows = table(spark, d, "orders").withColumn("e", (F.col("o_totalprice") > 250000).cast("int"))
    return profile.error_by_group(rows, "o_orderpriority", "e")


@query("pivot_mean", f"""SELECT l_linenumber, avg(price) FILTER (flag = 'A') AS "A", avg(price) FILTER (flag = 'N') AS "N", avg(price) FILTER (flag = 'R') AS "R" FROM ({I}) WHERE flag IS NOT NULL GROUP BY 1""",
       doubles="A N R", scale=4)
def _(spark, d):
    return profile.pivot(dirty.items(spark, d), ["l_linenumber"], "flag", "price")


@query("pivot_sum", """SELECT l_returnflag, sum(l_quantity) FILTER (l_linestatus = 'F') AS "F", sum(l_quantity) FILTER (l_linestatus = 'O') AS "O" FROM lineitem GROUP BY 1""", doubles="F O", scale=2)
def _(spark, d):
    return profile.pivot(table(spark, d, "lineitem"), ["l_returnflag"], "l_linestatus", "l_quantity", "sum")


@query("crosstab_counts", """SELECT c_mktsegment, count(*) FILTER (b = 'low') AS low, count(*) FILTER (b = 'high') AS high FROM
       (SELECT c_mktsegment, CASE WHEN c_acctbal < 4500 THEN 'low' ELSE 'high' END AS b FROM customer) GROUP BY 1""")
def _(spark, d):
    rows = table(spark, d, "customer").withColumn("b", F.when(F.col("c_acctbal") < 4500, "low").otherwise("high"))
    return profile.crosstab(rows, "c_mktsegment", "b")


@query("crosstab_shares", f"""SELECT status, count(*) FILTER (flag = 'A') / count(*) AS "A", count(*) FILTER (flag = 'N') / count(*) AS "N", count(*) FILTER (flag = 'R') / count(*) AS "R"
       FROM ({I}) WHERE flag IS NOT NULL GROUP BY 1""", doubles="A N R")
def _(spark, d):
    return profile.crosstab(dirty.items(spark, d), "status", "flag", normalize=True)


@query("melt", """SELECT l_orderkey, l_linenumber, 'l_quantity' AS variable, l_quantity AS value FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax + 0.0 FROM lineitem""")
def _(spark, d):
    rows = table(spark, d, "lineitem").withColumn("l_tax", F.col("l_tax") + 0.0)
    return profile.melt(rows.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax"])


def _hist_sql(column, source, bins, by=None):
    keys = f"{by}, " if by else ""
    grid = f"(SELECT DISTINCT {by} FROM {source}) CROSS JOIN range({bins}) t(bin)" if by else f"range({bins}) t(bin)"
    on = f"g.bin = c.bin AND g.{by} = c.{by}" if by else "g.bin = c.bin"
    return f"""WITH m AS (SELECT min({column}) AS lo, (max({column}) - min({column})) / {bins} AS w FROM {source}),
      c AS (SELECT {keys}least(CAST(floor(({column} - lo) / w) AS INTEGER), {bins - 1}) AS bin, count(*) AS n FROM {source}, m GROUP BY ALL),
      g AS (SELECT {keys}CAST(bin AS INTEGER) AS bin FROM {grid})
      SELECT {"g." + by + ", " if by else ""}g.bin, lo + g.bin * w AS left_edge, lo + (g.bin + 1) * w AS right_edge, coalesce(n, 0) AS n FROM g CROSS JOIN m LEFT JOIN c ON {on}"""


@query("histogram", _hist_sql("o_totalprice", "orders", 30), doubles="left_edge right_edge")
def _(spark, d):
    return profile.histogram(table(spark, d, "orders"), "o_totalprice", 30)


@query("histogram_by_class", _hist_sql("value", "events", 20, "event_type"), doubles="left_edge right_edge")
def _(spark, d):
    return profile.histogram(table(spark, d, "events"), "value", 20, "event_type")


def _box_sql(cols, source, by=None):
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    join = f"JOIN b ON t.{by} = b.{by}" if by else "CROSS JOIN b"
    return _union([f"""SELECT {"t." + by + "," if by else ""} '{c}' AS "column", any_value(q1) AS q1, any_value(q2) AS median, any_value(q3) AS q3, any_value(q1 - 1.5 * (q3 - q1)) AS lower,
       any_value(q3 + 1.5 * (q3 - q1)) AS upper, count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers,
       100.0 * count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) / count({c}) AS pct_outliers
       FROM {source} t {join.replace("JOIN b", f"JOIN (SELECT {key}quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM {source} {group}) b")}
       {"GROUP BY t." + by if by else ""}""" for c in cols])


@query("boxplot_table", _box_sql(MEASURES, "lineitem"), doubles="q1 median q3 lower upper pct_outliers")
def _(spark, d):
    return profile.boxplot_stats(table(spark, d, "lineitem"), MEASURES)


@query("boxplot_by_class", _box_sql(["value"], "events", "event_type"), doubles="q1 median q3 lower upper pct_outliers")
def _(spark, d):
    return profile.boxplot_stats(table(spark, d, "events"), ["value"], "event_type")


@query("class_balance", """SELECT lang AS label, count(*) AS n, 100.0 * count(*) / sum(count(*)) OVER () AS pct, max(count(*)) OVER () / min(count(*)) OVER () AS max_min_ratio,
       max(count(*)) OVER () / min(count(*)) OVER () > 1.5 AS imbalanced FROM documents GROUP BY 1""", doubles="pct max_min_ratio")
def _(spark, d):
    return profile.class_balance(table(spark, d, "documents"), "lang")


@query("class_weights", "SELECT quality AS label, count(*) AS n, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight FROM labels GROUP BY 1", doubles="weight")
def _(spark, d):
    return profile.class_weights(table(spark, d, "labels"), "quality")


@query("prevalence_by_period", """SELECT CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS prevalence, count(*) AS n FROM orders GROUP BY 1""", doubles="prevalence")
def _(spark, d):
    rows = table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    return profile.prevalence(rows, ["year"], "label")


@query("prevalence_by_unit_and_period", """SELECT c_nationkey, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS prevalence, count(*) AS n
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""", doubles="prevalence")
def _(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.select("c_nationkey", F.year("o_orderdate").alias("year"), (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    return profile.prevalence(rows, ["c_nationkey", "year"], "label")


@query("cluster_profile", """SELECT cluster, count(*) AS n, avg(l_quantity) AS mean_l_quantity, avg(l_discount) AS mean_l_discount
       FROM (SELECT *, CAST(CASE WHEN l_tax < 0.02 THEN -1 WHEN l_tax < 0.05 THEN 0 ELSE 1 END AS INTEGER) AS cluster FROM lineitem) WHERE cluster <> -1 GROUP BY 1""", doubles="mean_l_quantity mean_l_discount")
def _(spark, d):
    rows = table(spark, d, "lineitem").withColumn("cluster", F.expr("CASE WHEN l_tax < 0.02 THEN -1 WHEN l_tax < 0.05 THEN 0 ELSE 1 END"))
    return profile.cluster_profile(rows, "cluster", ["l_quantity", "l_discount"])


@query("run_summary", f"""SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS n_cols, avg(label) AS prevalence, CAST(sum((status IS NULL)::INT) AS BIGINT) AS n_missing,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {D})) AS n_duplicates FROM (SELECT *, CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 0 END AS label FROM {D})""", doubles="prevalence")
def _(spark, d):
    rows = dirty.doubled(spark, d).withColumn("label", (F.col("o_custkey") % 3 == 0).cast("int"))
    return profile.run_summary(rows, "label")


# outliers -------------------------------------------------------------------------------

def _iqr_sql(cols, source):
    return _union([f"""SELECT '{c}' AS "column", q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper,
       count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers,
       100.0 * count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) / count({c}) AS pct_outliers
       FROM {source}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {source}) GROUP BY q1, q3""" for c in cols])


@query("iqr_report", _iqr_sql(MEASURES, "lineitem"), doubles="q1 q3 iqr lower upper pct_outliers")
def _(spark, d):
    return outliers.iqr_report(table(spark, d, "lineitem"), MEASURES)


@query("iqr_report_with_nulls", _iqr_sql(["reading"], f"({E})"), doubles="q1 q3 iqr lower upper pct_outliers")
def _(spark, d):
    rows = dirty.events(spark, d).withColumn("empty", F.lit(None).cast("double"))
    return outliers.iqr_report(rows, ["reading", "empty"])


@query("iqr_filter_sequential", f"""WITH a AS (SELECT event_id, reading, event_id * value AS load FROM ({E})),
       q AS (SELECT quantile_cont(reading, 0.25) AS q1, quantile_cont(reading, 0.75) AS q3 FROM a),
       b AS (SELECT a.* FROM a, q WHERE reading IS NULL OR reading BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)),
       r AS (SELECT quantile_cont(load, 0.25) AS q1, quantile_cont(load, 0.75) AS q3 FROM b)
       SELECT b.* FROM b, r WHERE load IS NULL OR load BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""", doubles="load", scale=3)
def _(spark, d):
    rows = dirty.events(spark, d).select("event_id", "reading", (F.col("event_id") * F.col("value")).alias("load"))
    return outliers.iqr_filter(rows, ["reading", "load"])


@query("outlier_impact", f"""WITH q AS (SELECT quantile_cont(reading, 0.25) AS q1, quantile_cont(reading, 0.75) AS q3 FROM ({E})),
       x AS (SELECT reading AS b, CASE WHEN reading BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN reading END AS a FROM ({E}), q),
       s AS (SELECT 'mean' AS stat, avg(b) AS before, avg(a) AS after FROM x UNION ALL SELECT 'median', quantile_cont(b, 0.5), quantile_cont(a, 0.5) FROM x
         UNION ALL SELECT 'std', stddev_samp(b), stddev_samp(a) FROM x UNION ALL SELECT 'variance', var_samp(b), var_samp(a) FROM x
         UNION ALL SELECT 'min', min(b), min(a) FROM x UNION ALL SELECT 'max', max(b), max(a) FROM x)
       SELECT 'reading' AS "column", stat, before, after, after - before AS change, 100.0 * (after - before) / abs(before) AS pct_change FROM s""", doubles="before after change pct_change")
def _(spark, d):
    return outliers.outlier_impact(dirty.events(spark, d), ["reading"])


@query("zscore_outliers", f"""SELECT event_id, reading FROM ({E}), (SELECT avg(reading) AS m, stddev_pop(reading) AS s FROM ({E})) WHERE abs((reading - m) / s) > 3""")
def _(spark, d):
    return outliers.zscore_outliers(dirty.events(spark, d), ["reading"]).select("event_id", "reading")


@query("winsorize", f"""SELECT event_id, CASE WHEN reading < lo THEN lo WHEN reading > hi THEN hi ELSE reading END AS reading
       FROM ({E}), (SELECT quantile_cont(reading, 0.01) AS lo, quantile_cont(reading, 0.99) AS hi FROM ({E}))""", doubles="reading")
def _(spark, d):
    return outliers.winsorize(dirty.events(spark, d), ["reading"]).select("event_id", "reading")


@query("iqr_cap_from_train", f"""SELECT o_orderkey, CASE WHEN price < q1 - 0.2 * (q3 - q1) THEN q1 - 0.2 * (q3 - q1) WHEN price > q3 + 0.2 * (q3 - q1) THEN q3 + 0.2 * (q3 - q1) ELSE price END AS price
       FROM ({O}), (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM ({O}) WHERE o_orderdate < TIMESTAMP '1999-01-01')""", doubles="price")
def _(spark, d):
    rows = dirty.orders(spark, d)
    caps = outliers.fit_iqr_cap(rows.where("o_orderdate < timestamp'1999-01-01'"), ["price"], 0.2)
    return outliers.apply_iqr_cap(rows.select("o_orderkey", "price"), caps)


@query("iqr_cap_skip_flat", f"""SELECT event_id, CASE WHEN value < q1 - 1.5 * (q3 - q1) THEN q1 - 1.5 * (q3 - q1) WHEN value > q3 + 1.5 * (q3 - q1) THEN q3 + 1.5 * (q3 - q1) ELSE value END AS value,
       CAST(CASE WHEN event_id % 10 = 0 THEN 5 ELSE 1 END AS DOUBLE) AS flat FROM events, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)""", doubles="value")
def _(spark, d):
    rows = table(spark, d, "events").select("event_id", "value", F.when(F.col("event_id") % 10 == 0, 5.0).otherwise(1.0).alias("flat"))
    return outliers.apply_iqr_cap(rows, outliers.fit_iqr_cap(rows, ["value", "flat"], skip_flat=True))


# correlation ----------------------------------------------------------------------------

PAIRS = [("quantity", "price"), ("quantity", "tax"), ("price", "tax")]


@query("corr_pearson", _union([f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM ({I})" for a, b in PAIRS]
       + [f"SELECT '{c}', 'same', NULL" for c in ("quantity", "price", "tax")]), doubles="r")
def _(spark, d):
    return correlate.corr_matrix(dirty.items(spark, d), ["quantity", "price", "tax", "same"])


@query("corr_pearson_full", _union([f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM ({I}) UNION ALL SELECT '{b}', '{a}', corr({a}, {b}) FROM ({I})" for a, b in PAIRS]
       + [f"SELECT '{c}', '{c}', 1.0" for c in ("quantity", "price", "tax")]), doubles="r", scale=4)
def _(spark, d):
    return correlate.corr_matrix(dirty.items(spark, d), ["quantity", "price", "tax"], full=True)


_COMPLETE = f"(SELECT quantity, price, tax FROM ({I}) WHERE quantity IS NOT NULL AND price IS NOT NULL)"


@query("corr_complete_cases", _union([f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM {_COMPLETE}" for a, b in PAIRS]), doubles="r")
def _(spark, d):
    return correlate.corr_matrix(dirty.items(spark, d), ["quantity", "price", "tax"], nulls="complete")


def _spearman_sql(a, b, source):
    rank = lambda c: f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"
    return f"SELECT '{a}' AS a, '{b}' AS b, corr(x, y) AS r FROM (SELECT {rank(a)} AS x, {rank(b)} AS y FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"


@query("corr_spearman", _union([_spearman_sql(a, b, f"({I})") for a, b in PAIRS]), doubles="r")
def _(spark, d):
    return correlate.corr_matrix(dirty.items(spark, d), ["quantity", "price", "tax"], "spearman")


@query("corr_spearman_complete_cases", _union([_spearman_sql(a, b, _COMPLETE) for a, b in PAIRS]), doubles="r")
def _(spark, d):
    return correlate.corr_matrix(dirty.items(spark, d), ["quantity", "price", "tax"], "spearman", nulls="complete")


_WIDE = """(SELECT l_quantity AS q, l_quantity * 2 + l_tax * 300 AS near, l_quantity + 30 * l_discount * 10 AS mid, l_tax AS far FROM lineitem)"""
_WIDE_COLS = ["far", "mid", "near", "q"]


def _wide(spark, d):
    return table(spark, d, "lineitem").selectExpr("l_quantity AS q", "l_quantity * 2 + l_tax * 300 AS near", "l_quantity + 30 * l_discount * 10 AS mid", "l_tax AS far")


_WIDE_CORR = _union([f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM {_WIDE}" for i, a in enumerate(_WIDE_COLS) for b in _WIDE_COLS[i + 1:]])


@query("corr_high_pairs", f"SELECT a, b, r, 'strong' AS level FROM ({_WIDE_CORR}) WHERE abs(r) >= 0.7", doubles="r")
def _(spark, d):
    return correlate.corr_pairs(_wide(spark, d), _WIDE_COLS)


@query("corr_moderate_pairs", f"SELECT a, b, r, CASE WHEN abs(r) >= 0.7 THEN 'strong' ELSE 'moderate' END AS level FROM ({_WIDE_CORR}) WHERE abs(r) >= 0.5", doubles="r")
def _(spark, d):
    return correlate.corr_pairs(_wide(spark, d), _WIDE_COLS, correlate.MODERATE)


@query("corr_named_pairs", f"""SELECT p.a, p.b, p.r AS pearson, s.r AS spearman FROM (SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, corr(l_quantity, l_extendedprice) AS r FROM lineitem) p,
       ({_spearman_sql("l_quantity", "l_extendedprice", "lineitem")}) s""", doubles="pearson spearman")
def _(spark, d):
    return correlate.corr_named(table(spark, d, "lineitem"), [("l_quantity", "l_extendedprice"), ("l_quantity", "l_returnflag"), ("l_tax", "gone")])


@query("corr_with_target", _union([f"""SELECT '{c}' AS "column", corr({c}, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r FROM lineitem""" for c in MEASURES]), doubles="r")
def _(spark, d):
    rows = table(spark, d, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    return correlate.corr_with(rows, "label", MEASURES)


@query("corr_top", f"SELECT * FROM ({_WIDE_CORR}) WHERE abs(r) <> 1 AND r <> 0 ORDER BY abs(r) DESC LIMIT 5", doubles="r")
def _(spark, d):
    return correlate.corr_top(_wide(spark, d), _WIDE_COLS)


@query("trend_line", f"""SELECT regr_slope(price, quantity) AS slope, regr_intercept(price, quantity) AS intercept, corr(price, quantity) AS r, CAST(regr_count(price, quantity) AS BIGINT) AS n FROM ({I})""",
       doubles="slope intercept r", scale=4)
def _(spark, d):
    return correlate.trend(dirty.items(spark, d), "quantity", "price")
