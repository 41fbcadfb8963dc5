"""Queries: joins, set operations, windows, encoders, scalers, features, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import combine, encode, features, profile, scale, split
from . import dirty
from .explore import MEASURES
from .registry import query, table

I, O, E, D = dirty.ITEMS_SQL, dirty.ORDERS_SQL, dirty.EVENTS_SQL, dirty.DOUBLED_SQL


# joins and sets -------------------------------------------------------------------------

@query("left_join_on_id", "SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _(spark, d):
    return combine.join_by_key(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), ["doc_id"])


def _error_sql(flag):
    return f"SELECT o_orderpriority, count(*) AS n, CAST(sum(e) AS BIGINT) AS errors, 100.0 * sum(e) / count(*) AS error_pct FROM (SELECT *, CASE WHEN {flag} THEN 1 ELSE 0 END AS e FROM orders) GROUP BY 1"


@query("consensus_errors", f"""SELECT a.o_orderpriority, a.n, a.errors AS errors_a, a.error_pct AS error_pct_a, b.errors AS errors_b, b.error_pct AS error_pct_b,
       (a.error_pct + b.error_pct) / 2 AS error_pct_mean FROM ({_error_sql("o_totalprice > 250000")}) a JOIN ({_error_sql("o_orderstatus = 'P'")}) b ON a.o_orderpriority = b.o_orderpriority""",
       doubles="error_pct_a error_pct_b error_pct_mean")
def _(spark, d):
    rows = table(spark, d, "orders").withColumns({"x": (F.col("o_totalprice") > 250000).cast("int"), "y": (F.col("o_orderstatus") == "P").cast("int")})
    return combine.consensus(profile.error_by_group(rows, "o_orderpriority", "x"), profile.error_by_group(rows, "o_orderpriority", "y"), "o_orderpriority")


@query("bind_columns", "SELECT d.doc_id, lang, n_chars, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def _(spark, d):
    left = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return combine.bind_columns(left, table(spark, d, "labels").select("doc_id", "quality"), ["doc_id"])


@query("union_of_classes", "SELECT c_custkey, c_mktsegment FROM customer")
def _(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return combine.union_all([rows.where(F.col("c_mktsegment") == v) for v in profile.levels(rows, "c_mktsegment")])


@query("map_values", f"""SELECT o_orderkey, CASE status WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' END AS mapped,
       coalesce(CASE status WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' END, o_orderpriority) AS with_default FROM ({O})""")
def _(spark, d):
    rows = dirty.orders(spark, d).select("o_orderkey", "status", "o_orderpriority")
    names = {"F": "done", "O": "open"}
    out = combine.map_values(combine.map_values(rows, "status", names, "mapped"), "status", names, "with_default", "o_orderpriority")
    return out.select("o_orderkey", "mapped", "with_default")


@query("set_difference", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000")
def _(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return combine.set_diff(table(spark, d, "customer"), big, "c_custkey")


# windows --------------------------------------------------------------------------------

@query("returns_per_entity", """SELECT event_id, CASE WHEN rn = 1 THEN 0 WHEN p <> 0 THEN value / p - 1 END AS ret, CASE WHEN rn = 1 THEN 0 WHEN p <> 0 THEN ln(1 + (value / p - 1)) END AS log_ret
       FROM (SELECT *, lag(value) OVER w AS p, row_number() OVER w AS rn FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""", doubles="ret log_ret")
def _(spark, d):
    rows = table(spark, d, "events")
    out = combine.returns(rows, ["user_id"], ["ts", "event_id"], "value")
    return combine.returns(out, ["user_id"], ["ts", "event_id"], "value", "log_ret", log=True).select("event_id", "ret", "log_ret")


@query("returns_after_gaps", """SELECT event_id, CASE WHEN rn = 1 THEN 0 WHEN p <> 0 THEN v / p - 1 END AS ret FROM (SELECT *, lag(v) OVER w AS p, row_number() OVER w AS rn
       FROM (SELECT *, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 0.0 ELSE value END AS v FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""", doubles="ret")
def _(spark, d):
    rows = table(spark, d, "events").withColumn("v", F.expr("CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 0.0D ELSE value END"))
    return combine.returns(rows, ["user_id"], ["ts", "event_id"], "v").select("event_id", "ret")


@query("delta_per_entity", "SELECT event_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS delta_value FROM events", doubles="delta_value")
def _(spark, d):
    return combine.delta(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value").select("event_id", "delta_value")


@query("group_shares", f"SELECT status, flag, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY status) AS share FROM ({I}) GROUP BY 1, 2", doubles="share")
def _(spark, d):
    return combine.share(dirty.items(spark, d), ["flag"], ["status"])


@query("total_shares", f"SELECT flag, count(*) AS n, count(*) / (SELECT count(*) FROM lineitem) AS share FROM ({I}) GROUP BY 1", doubles="share")
def _(spark, d):
    return combine.share(dirty.items(spark, d), ["flag"], [])


@query("ranks_and_positions", """SELECT event_id, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS avg_rank,
       row_number() OVER (ORDER BY ts, event_id) AS position FROM events""", doubles="avg_rank")
def _(spark, d):
    return combine.ranks(table(spark, d, "events"), "value", ["ts", "event_id"]).select("event_id", "avg_rank", "position")


# encoders -------------------------------------------------------------------------------

@query("one_hot", f"""SELECT o_orderkey, {", ".join(f"CAST(coalesce(status = '{v}', false) AS INTEGER) AS status_{v}" for v in "FOP")} FROM ({O})""")
def _(spark, d):
    rows = dirty.orders(spark, d).select("o_orderkey", "status")
    return encode.apply_onehot(rows, encode.fit_onehot(rows, ["status"]))


@query("one_hot_drop_first", f"""SELECT o_orderkey, {", ".join(f"CAST(coalesce(status = '{v}', false) AS INTEGER) AS status_{v}" for v in "OP")} FROM ({O})""")
def _(spark, d):
    rows = dirty.orders(spark, d).select("o_orderkey", "status")
    return encode.apply_onehot(rows, encode.fit_onehot(rows, ["status"]), drop_first=True)


@query("one_hot_from_train", f"""SELECT o_orderkey, {", ".join(f"CAST(coalesce(status = '{v}', false) AS INTEGER) AS status_{v}" for v in "FO")} FROM ({O})""")
def _(spark, d):
    rows = dirty.orders(spark, d).select("o_orderkey", "status")
    return encode.apply_onehot(rows, encode.fit_onehot(rows.where("status <> 'P'"), ["status"]))


@query("label_encode", f"""SELECT o_orderkey, CAST(CASE WHEN status IS NULL THEN NULL ELSE dense_rank() OVER (ORDER BY status NULLS LAST) - 1 END AS BIGINT) AS status FROM ({O})""")
def _(spark, d):
    rows = dirty.orders(spark, d).select("o_orderkey", "status")
    return encode.apply_label(rows, "status", encode.fit_label(rows, "status"))


@query("label_encode_null_as_text", f"SELECT o_orderkey, dense_rank() OVER (ORDER BY coalesce(status, 'nan')) - 1 AS status FROM ({O})")
def _(spark, d):
    rows = dirty.orders(spark, d).select("o_orderkey", "status")
    return encode.apply_label(rows, "status", encode.fit_label(rows, "status", "nan"), null_label="nan")


@query("label_codes_high_cardinality", "SELECT DISTINCT c_name AS value, row_number() OVER (ORDER BY c_name) - 1 AS code FROM (SELECT DISTINCT c_name FROM customer)")
def _(spark, d):
    return encode.fit_label(table(spark, d, "customer"), "c_name")


@query("ordinal_unknown", f"SELECT o_orderkey, CAST(CASE status WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE -1 END AS BIGINT) AS status FROM ({O})")
def _(spark, d):
    rows = dirty.orders(spark, d).select("o_orderkey", "status")
    return encode.apply_label(rows, "status", encode.fit_label(rows.where("status <> 'P'"), "status"), unknown=-1)


@query("ordinal_given_order", """SELECT event_id, CAST(CASE WHEN value < 10 THEN 0 WHEN value < 100 THEN 1 ELSE 2 END AS BIGINT) AS level_code FROM events""")
def _(spark, d):
    rows = table(spark, d, "events").select("event_id", F.expr("CASE WHEN value < 10 THEN 'Low' WHEN value < 100 THEN 'Moderate' ELSE 'High' END").alias("level"))
    return encode.encode_ordinal(rows, "level").drop("level")


@query("ordinal_fallback", "SELECT c_custkey, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS c_mktsegment_code FROM customer")
def _(spark, d):
    return encode.encode_ordinal(table(spark, d, "customer"), "c_mktsegment").select("c_custkey", "c_mktsegment_code")


@query("binary_encode", """SELECT p_partkey, CAST((k >> 4) & 1 AS INTEGER) AS p_brand_0, CAST((k >> 3) & 1 AS INTEGER) AS p_brand_1, CAST((k >> 2) & 1 AS INTEGER) AS p_brand_2,
       CAST((k >> 1) & 1 AS INTEGER) AS p_brand_3, CAST(k & 1 AS INTEGER) AS p_brand_4 FROM (SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) AS k FROM part)""")
def _(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_brand")
    return encode.apply_binary(rows, "p_brand", encode.fit_binary(rows, "p_brand"))


@query("factorize", f"""SELECT event_id, CASE WHEN event_type = 'error' THEN -1 ELSE (SELECT c FROM (SELECT event_type AS t, row_number() OVER (ORDER BY min(event_id)) - 1 AS c
       FROM events WHERE event_type <> 'error' GROUP BY 1) WHERE t = e.event_type) END AS kind_code FROM events e""")
def _(spark, d):
    rows = table(spark, d, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"))
    return encode.factorize(rows, "kind", ["event_id"]).select("event_id", "kind_code")


# scaling and features -------------------------------------------------------------------

def _scaled(expr):
    return f"SELECT l_orderkey, l_linenumber, {', '.join(expr(c) + ' AS ' + c for c in MEASURES)} FROM lineitem"


@query("standard_scale", _scaled(lambda c: f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()"), doubles=" ".join(MEASURES))
def _(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)
    return scale.apply_scaler(rows, scale.fit_scaler(rows, MEASURES))


@query("minmax_scale", _scaled(lambda c: f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())"), doubles=" ".join(MEASURES))
def _(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)
    return scale.apply_scaler(rows, scale.fit_scaler(rows, MEASURES, "minmax"))


@query("robust_scale", _scaled(lambda c: f"({c} - (SELECT quantile_cont({c}, 0.5) FROM lineitem)) / (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM lineitem)"), doubles=" ".join(MEASURES))
def _(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)
    return scale.apply_scaler(rows, scale.fit_scaler(rows, MEASURES, "robust"))


@query("scale_from_train", """SELECT o_orderkey, (o_totalprice - m) / s AS o_totalprice FROM orders, (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders
       WHERE o_orderdate < TIMESTAMP '1999-01-01')""", doubles="o_totalprice")
def _(spark, d):
    rows = table(spark, d, "orders")
    train = rows.where("o_orderdate < timestamp'1999-01-01'")
    return scale.apply_scaler(rows.select("o_orderkey", "o_totalprice"), scale.fit_scaler(train, ["o_totalprice"]))


@query("scale_constant_column", "SELECT event_id, CAST(0 AS DOUBLE) AS same FROM events")
def _(spark, d):
    rows = table(spark, d, "events").select("event_id", F.lit(3.0).alias("same"))
    return scale.apply_scaler(rows, scale.fit_scaler(rows, ["same"], "minmax"))


_TRAIN = f"(SELECT * FROM ({O}) WHERE o_orderdate < TIMESTAMP '1999-01-01')"


@query("preprocess_columns", f"""WITH t AS (SELECT * FROM {_TRAIN}), med AS (SELECT quantile_cont(price, 0.5) AS m FROM t),
       q AS (SELECT quantile_cont(coalesce(price, m), 0.25) AS q1, quantile_cont(coalesce(price, m), 0.5) AS q2, quantile_cont(coalesce(price, m), 0.75) AS q3 FROM t, med),
       top AS (SELECT status AS s FROM t WHERE status IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
       SELECT o_orderkey, (coalesce(price, m) - q2) / (q3 - q1) AS price, {", ".join(f"CAST(coalesce(status, s) = '{v}' AS INTEGER) AS status_{v}" for v in "FOP")} FROM ({O}), med, q, top""", doubles="price")
def _(spark, d):
    rows = dirty.orders(spark, d)
    fitted = scale.fit_preprocessor(rows.where("o_orderdate < timestamp'1999-01-01'"), ["price"], ["status"], ["o_orderkey"])
    return fitted.transform(rows)


@query("log_of_skewed", """SELECT event_id, value, event_id AS even, log10(value + 1) AS value_log10 FROM events""", doubles="value_log10")
def _(spark, d):
    rows = table(spark, d, "events").select("event_id", "value", F.col("event_id").alias("even"))
    return features.log_skewed(rows, ["value", "even"])[0]


@query("skew_report", """SELECT 'value' AS "column", skewness(value) AS skew_before, skewness(log10(value + 1)) AS skew_after, true AS transformed FROM events
       UNION ALL SELECT 'signed', skewness(value - 100), NULL, false FROM events""", doubles="skew_before skew_after", scale=5)
def _(spark, d):
    rows = table(spark, d, "events").select("value", (F.col("value") - 100).alias("signed"))
    return features.log_skewed(rows, ["value", "signed"])[1]


@query("family_features", "SELECT l_orderkey, l_linenumber, l_linenumber + l_suppkey % 3 + 1 AS FamilySize, CAST(l_linenumber + l_suppkey % 3 + 1 = 1 AS INTEGER) AS IsAlone FROM lineitem")
def _(spark, d):
    rows = table(spark, d, "lineitem").withColumn("other", F.col("l_suppkey") % 3)
    return features.family_features(rows, "l_linenumber", "other").select("l_orderkey", "l_linenumber", "FamilySize", "IsAlone")


# a panel of nations by year in the column names of the finance table
_PANEL = """SELECT CAST(c_nationkey AS VARCHAR(10)) AS unidad, CAST(extract(year FROM o_orderdate) AS INTEGER) AS anio, sum(o_totalprice) AS ingresos_totales,
       sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS gastos_personal, avg(o_totalprice) AS liquidez, avg(c_acctbal) AS endeudamiento,
       CAST(count(*) AS DOUBLE) AS dias_efectivo, sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) * 1.0 / count(*) AS hhi_fuentes,
       sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) / sum(o_totalprice) AS gp_ratio
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""


def panel(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    done = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0)
    return (o.join(c, o["o_custkey"] == c["c_custkey"])
            .groupBy(F.col("c_nationkey").cast("string").alias("unidad"), F.year("o_orderdate").alias("anio"))
            .agg(F.sum("o_totalprice").alias("ingresos_totales"), F.sum(done).alias("gastos_personal"), F.avg("o_totalprice").alias("liquidez"),
                 F.avg("c_acctbal").alias("endeudamiento"), F.count(F.lit(1)).cast("double").alias("dias_efectivo"),
                 (F.count_if(F.col("o_orderstatus") == "P") / F.count(F.lit(1))).alias("hhi_fuentes"),
                 (F.sum(done) / F.sum("o_totalprice")).alias("gp_ratio")))


@query("panel_features", f"""SELECT unidad, anio, gastos_personal / (ingresos_totales + 1e-8) AS ratio_gastos_personal_ingresos, liquidez / (endeudamiento + 1e-8) AS ratio_liquidez_endeudamiento,
       1.0 - hhi_fuentes AS diversificacion_fuentes, dias_efectivo / 365.0 AS anios_cobertura_efectivo,
       gp_ratio - lag(gp_ratio) OVER w AS delta_gp_ratio_anual, liquidez - lag(liquidez) OVER w AS delta_liquidez_anual
       FROM ({_PANEL}) WINDOW w AS (PARTITION BY unidad ORDER BY anio)""",
       doubles="ratio_gastos_personal_ingresos ratio_liquidez_endeudamiento diversificacion_fuentes anios_cobertura_efectivo delta_gp_ratio_anual delta_liquidez_anual")
def _(spark, d):
    out = features.panel_features(panel(spark, d))
    return out.select("unidad", "anio", "ratio_gastos_personal_ingresos", "ratio_liquidez_endeudamiento", "diversificacion_fuentes",
                      "anios_cobertura_efectivo", "delta_gp_ratio_anual", "delta_liquidez_anual")


@query("polynomial_terms", """SELECT l_orderkey, l_linenumber, l_quantity, l_tax, l_quantity * l_quantity AS "l_quantity*l_quantity", l_quantity * l_tax AS "l_quantity*l_tax", l_tax * l_tax AS "l_tax*l_tax" FROM
       (SELECT l_orderkey, l_linenumber, l_quantity, l_tax + 0.0 AS l_tax FROM lineitem)""")
def _(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", (F.col("l_tax") + 0.0).alias("l_tax"))
    return features.polynomial(rows, ["l_quantity", "l_tax"], 2)[0]


@query("dataset_variants", """SELECT 'base' AS variant, CAST(4 AS BIGINT) AS n_cols, count(*) AS n, sum(event_id) AS check_sum FROM events
       UNION ALL SELECT 'onehot', 8, count(*), sum(CASE WHEN event_type = 'click' THEN event_id ELSE 0 END) FROM events
       UNION ALL SELECT 'label', 4, count(*), sum(event_id * k) FROM (SELECT event_id, dense_rank() OVER (ORDER BY event_type) - 1 AS k FROM events)
       UNION ALL SELECT 'binary', 6, count(*), sum(event_id * (k & 1)) FROM (SELECT event_id, dense_rank() OVER (ORDER BY event_type) AS k FROM events)""", doubles="check_sum", scale=1)
def _(spark, d):
    made = features.transform_all(table(spark, d, "events").select("event_id", "event_type", "value"), ["value"], ["event_type"])
    of = {"base": F.col("event_id"), "onehot": F.col("event_id") * F.col("event_type_click"), "label": F.col("event_id") * F.col("event_type"),
          "binary": F.col("event_id") * F.col("event_type_2")}
    parts = [made[v].agg(F.lit(v).alias("variant"), F.lit(len(made[v].columns)).cast("long").alias("n_cols"), F.count(F.lit(1)).alias("n"),
                         F.sum(e).alias("check_sum")) for v, e in of.items()]
    return combine.union_all(parts)


# splits ---------------------------------------------------------------------------------

def _unit(key, seed):
    return f"CAST(('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 13)) AS BIGINT)"


@query("random_split", f"SELECT o_orderkey, CASE WHEN {_unit('o_orderkey', 7)} < 0.2 * 4503599627370496 THEN 'test' ELSE 'train' END AS split FROM orders")
def _(spark, d):
    return split.random_split(table(spark, d, "orders"), ["o_orderkey"], 0.2, 7).select("o_orderkey", "split")


@query("stratified_split", f"""SELECT o_orderkey, o_orderpriority, CASE WHEN rn <= floor(0.2 * n + 0.5) THEN 'test' ELSE 'train' END AS split FROM (SELECT *,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_unit('o_orderkey', 3)}) AS rn, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)""")
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return split.stratified_split(rows, ["o_orderkey"], "o_orderpriority", 0.2, 3)


_BY_CUSTOMER = f"""(SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {_unit('o_orderkey', 3)}, o_orderkey) AS rn, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)"""


@query("stratified_split_many_classes", f"""SELECT o_orderkey, o_custkey, CASE WHEN rn <= floor(0.2 * n + 0.5) THEN 'test' ELSE 'train' END AS split FROM {_BY_CUSTOMER}""")
def _(spark, d):
    return split.stratified_split(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], "o_custkey", 0.2, 3)


@query("stratified_folds_many_classes", f"""SELECT o_orderkey, CAST((CASE WHEN rn > n // 3 THEN 1 ELSE 0 END) + (CASE WHEN rn > 2 * n // 3 THEN 1 ELSE 0 END) AS INTEGER) AS fold FROM {_BY_CUSTOMER}""")
def _(spark, d):
    return split.kfold(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], "o_custkey", 3, 3).select("o_orderkey", "fold")


@query("undersample_many_classes", f"""SELECT o_orderkey FROM {_BY_CUSTOMER} WHERE rn <= (SELECT min(n) FROM {_BY_CUSTOMER})""")
def _(spark, d):
    return split.undersample(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], "o_custkey", 3).select("o_orderkey")


@query("three_way_split", f"""SELECT o_orderkey, o_orderpriority, CASE WHEN rn <= floor(0.2 * n + 0.5) THEN 'test' WHEN rn <= floor(0.4 * n + 0.5) THEN 'valid' ELSE 'train' END AS split FROM (SELECT *,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_unit('o_orderkey', 3)}) AS rn, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)""")
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return split.three_way_split(rows, ["o_orderkey"], "o_orderpriority", seed=3)


@query("time_split", f"""SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train' ELSE 'test' END AS split FROM orders WHERE o_orderkey % 9 <> 0""")
def _(spark, d):
    import datetime
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate")).alias("day"))
    return split.time_split(rows, "day", datetime.datetime(1999, 1, 1)).select("o_orderkey", "split")


@query("period_split", """SELECT o_orderkey, CASE dense_rank() OVER (ORDER BY extract(year FROM o_orderdate) DESC) WHEN 1 THEN 'holdout' WHEN 2 THEN 'test' WHEN 3 THEN 'valid' ELSE 'train' END AS split FROM orders""")
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return split.period_split(rows, "year").select("o_orderkey", "split")


@query("shared_split", f"""SELECT doc_id, toxic, CASE WHEN rn <= floor(0.25 * n + 0.5) THEN 'test' ELSE 'train' END AS split FROM (SELECT *,
       row_number() OVER (PARTITION BY quality ORDER BY {_unit('doc_id', 0)}) AS rn, count(*) OVER (PARTITION BY quality) AS n FROM labels)""")
def _(spark, d):
    rows = table(spark, d, "labels")
    first = split.stratified_split(rows.select("doc_id", "quality"), ["doc_id"], "quality", 0.25)
    return split.shared_split(rows.select("doc_id", "toxic"), first, ["doc_id"])


@query("stratified_folds", f"""SELECT o_orderkey, CAST((rn > n * 1 // 5)::INT + (rn > n * 2 // 5)::INT + (rn > n * 3 // 5)::INT + (rn > n * 4 // 5)::INT AS INTEGER) AS fold FROM (SELECT *,
       row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_unit('o_orderkey', 11)}) AS rn, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)""")
def _(spark, d):
    return split.kfold(table(spark, d, "orders"), ["o_orderkey"], "o_orderstatus", 5, 11).select("o_orderkey", "fold")


@query("undersample", f"""SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_unit('doc_id', 5)}) AS rn FROM documents)
       WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM documents GROUP BY lang))""")
def _(spark, d):
    return split.undersample(table(spark, d, "documents").select("doc_id", "lang"), ["doc_id"], "lang", 5)


@query("bootstrap", f"""WITH p AS (SELECT i, sum(exp(-1.0) / factorial(CAST(j AS INTEGER))) AS c FROM range(19) a(i), range(19) b(j) WHERE j <= i GROUP BY i),
       r AS (SELECT vec_id, CAST(s AS INTEGER) AS sample, CAST(('0x' || substr(md5('1|' || CAST(vec_id AS VARCHAR) || '|' || CAST(s AS VARCHAR)), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u FROM embeddings, range(4) t(s)),
       k AS (SELECT vec_id, sample, CAST(count(*) AS INTEGER) AS t FROM r JOIN p ON u >= c GROUP BY ALL)
       SELECT vec_id, sample, CAST(unnest(range(1, t + 1)) AS INTEGER) AS copy FROM k""")
def _(spark, d):
    return split.bootstrap(table(spark, d, "embeddings").select("vec_id"), ["vec_id"], 4, 1)
