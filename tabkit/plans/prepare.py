"""Queries: projections, filters, type coercion, text, nulls, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import clean, dedup, impute, project
from . import dirty
from .registry import query, table

I, O, E, D = dirty.ITEMS_SQL, dirty.ORDERS_SQL, dirty.EVENTS_SQL, dirty.DOUBLED_SQL


# projections and filters ----------------------------------------------------------------

@query("drop_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, d):
    return project.drop_columns(table(spark, d, "customer"), ["c_nationkey", "c_acctbal", "not_there"])


@query("select_features", "SELECT c_acctbal, c_custkey, c_mktsegment, c_nationkey FROM customer")
def _(spark, d):
    return project.select_features(table(spark, d, "customer"), drop=["c_name"])


@query("rename_columns", "SELECT s_suppkey AS supplier, s_name AS title, s_nationkey AS nation, s_acctbal AS balance FROM supplier")
def _(spark, d):
    one = project.rename(table(spark, d, "supplier"), {"s_suppkey": "supplier"})
    return project.rename_all(one, ["supplier", "title", "nation", "balance"])


@query("normalize_names", "SELECT p_partkey, p_name, p_size FROM part")
def _(spark, d):
    odd = table(spark, d, "part").select(F.col("p_partkey").alias(" P_PARTKEY"), F.col("p_name").alias("P_Name "), F.col("p_size").alias(" p_size "))
    return project.normalize_names(odd, lower=True)


@query("derived_column", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem", doubles="net", scale=4)
def _(spark, d):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return project.with_expr(table(spark, d, "lineitem"), "net", net).select("l_orderkey", "l_linenumber", "net")


@query("filter_rows", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 100000 AND o_orderstatus = 'F'")
def _(spark, d):
    rows = project.where(table(spark, d, "orders"), F.col("o_totalprice") >= 100000, F.col("o_orderstatus") == "F")
    return rows.select("o_orderkey", "o_totalprice")


@query("filter_range_keep_null", f"SELECT l_orderkey, l_linenumber, quantity FROM ({I}) WHERE quantity IS NULL OR quantity BETWEEN 10 AND 20")
def _(spark, d):
    return project.filter_range(dirty.items(spark, d), "quantity", 10, 20).select("l_orderkey", "l_linenumber", "quantity")


@query("filter_in", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('MACHINERY', 'HOUSEHOLD')")
def _(spark, d):
    return project.where_in(table(spark, d, "customer"), "c_mktsegment", ["MACHINERY", "HOUSEHOLD"]).select("c_custkey", "c_mktsegment")


@query("exclude_contains", f"SELECT o_orderkey, dirty_text FROM ({O}) WHERE NOT coalesce(contains(lower(dirty_text), 'high'), false)")
def _(spark, d):
    return project.exclude_contains(dirty.orders(spark, d), "dirty_text", "HIGH").select("o_orderkey", "dirty_text")


@query("delete_where", f"SELECT o_orderkey, price FROM ({O}) WHERE NOT coalesce(price > 200000, false)")
def _(spark, d):
    return project.delete_where(dirty.orders(spark, d), F.col("price") > 200000).select("o_orderkey", "price")


@query("drop_positions", """SELECT event_id, value FROM (SELECT *, row_number() OVER (ORDER BY value DESC, event_id) AS rn,
       row_number() OVER (ORDER BY ts, event_id) AS pos FROM events) WHERE pos - 1 NOT IN (0, 3, 17)""")
def _(spark, d):
    return project.drop_positions(table(spark, d, "events"), ["ts", "event_id"], [0, 3, 17]).select("event_id", "value")


@query("drop_constant", f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, quantity, price, discount, tax, flag, status FROM ({I})")
def _(spark, d):
    return project.drop_constant(dirty.items(spark, d))


@query("head_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def _(spark, d):
    return project.head(table(spark, d, "orders"), ["o_orderkey"], 5).select("o_orderkey", "o_totalprice")


@query("tail_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def _(spark, d):
    return project.tail(table(spark, d, "orders"), ["o_orderkey"], 5).select("o_orderkey", "o_totalprice")


@query("shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM lineitem")
def _(spark, d):
    return project.shape(table(spark, d, "lineitem"))


@query("columns_of_kind", "SELECT c_custkey, c_nationkey, c_acctbal, c_name, c_mktsegment FROM customer")
def _(spark, d):
    df = table(spark, d, "customer")
    return df.select(*project.columns_of(df, "numeric"), *project.columns_of(df, "categorical"))


@query("bucket_case", f"""SELECT l_orderkey, l_linenumber, CAST(CASE WHEN quantity <= 5 THEN 1 WHEN quantity <= 25 THEN 2 ELSE 3 END AS INTEGER) AS class
       FROM ({I})""")
def _(spark, d):
    rows = dirty.items(spark, d)
    return rows.select("l_orderkey", "l_linenumber", S.bucket_case(F.col("quantity"), [(5, 1), (25, 2)], 3).alias("class"))


@query("split_features_label", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus AS label FROM orders")
def _(spark, d):
    df = table(spark, d, "orders").drop("o_orderpriority")
    x, y = project.split_xy(df, "o_orderstatus", ["o_orderdate"], ["o_orderkey"])
    return x.join(y.withColumnRenamed("o_orderstatus", "label"), "o_orderkey")


@query("sort_mixed", """SELECT event_id, event_type, value, rn FROM (SELECT *, CAST(row_number() OVER (
       ORDER BY event_type ASC, value DESC, event_id ASC) AS BIGINT) AS rn FROM events) WHERE rn <= 100""")
def _(spark, d):
    from pyspark.sql import Window
    top = project.top_k(table(spark, d, "events"), [("event_type", True), ("value", False), ("event_id", True)], 100)
    rn = F.row_number().over(Window.orderBy("event_type", F.desc("value"), "event_id")).cast("long")
    return top.select("event_id", "event_type", "value", rn.alias("rn"))


@query("sorted_table", "SELECT event_id, event_type, value FROM events")
def _(spark, d):
    return project.sort(table(spark, d, "events"), [("event_type", True), ("value", False)]).select("event_id", "event_type", "value")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(spark, d):
    return project.top_k(table(spark, d, "orders"), [("o_totalprice", False), ("o_orderkey", True)], 20).select("o_orderkey", "o_totalprice")


@query("argmax_per_group", """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1""")
def _(spark, d):
    return project.argmax(table(spark, d, "orders"), ["o_custkey"], "o_totalprice", "o_orderkey", ["o_orderkey", "o_totalprice"])


# types, text, dates, maths --------------------------------------------------------------

@query("coerce_numeric", f"SELECT o_orderkey, TRY_CAST(text80 AS DOUBLE) AS text80, TRY_CAST(text_gaps AS DOUBLE) AS text_gaps FROM ({O})")
def _(spark, d):
    return clean.coerce_numeric(dirty.orders(spark, d).select("o_orderkey", "text80", "text_gaps"), ["text80", "text_gaps"])


@query("parse_thousands", f"SELECT o_orderkey, TRY_CAST(replace(thousands, ',', '') AS DOUBLE) AS thousands FROM ({O})")
def _(spark, d):
    return clean.parse_numbers(dirty.orders(spark, d).select("o_orderkey", "thousands"), ["thousands"])


@query("coerce_if_all_parse", f"SELECT o_orderkey, text80, TRY_CAST(text_gaps AS DOUBLE) AS text_gaps FROM ({O})")
def _(spark, d):
    rows = dirty.orders(spark, d).select("o_orderkey", "text80", "text_gaps")
    return clean.coerce_if(rows, ["text80", "text_gaps"], min_ratio=1.0, of_filled=True)


@query("coerce_if_80_percent", f"SELECT o_orderkey, TRY_CAST(text80 AS DOUBLE) AS text80, text70, text_gaps FROM ({O})")
def _(spark, d):
    rows = dirty.orders(spark, d).select("o_orderkey", "text80", "text70", "text_gaps")
    return clean.coerce_if(rows, min_ratio=0.8)


@query("coerce_if_any_parses", f"SELECT o_orderkey, TRY_CAST(text70 AS DOUBLE) AS text70, o_orderpriority FROM ({O})")
def _(spark, d):
    return clean.coerce_if(dirty.orders(spark, d).select("o_orderkey", "text70", "o_orderpriority"))


@query("parse_ratio", f"""SELECT 'text80' AS "column", count(*) AS n_rows, count(text80) AS n_filled, count(TRY_CAST(text80 AS DOUBLE)) AS n_numeric FROM ({O})
       UNION ALL SELECT 'text_gaps', count(*), count(text_gaps), count(TRY_CAST(text_gaps AS DOUBLE)) FROM ({O})""")
def _(spark, d):
    return clean.parse_ratio(dirty.orders(spark, d), ["text80", "text_gaps"])


@query("parse_dates", f"""SELECT o_orderkey, CAST(coalesce(try_strptime(date_text, '%Y-%m-%d'), try_strptime(date_text, '%Y-%m'),
       try_strptime(date_text, '%d/%m/%Y')) AS DATE) AS date_text FROM ({O})""")
def _(spark, d):
    return clean.parse_dates(dirty.orders(spark, d).select("o_orderkey", "date_text"), ["date_text"])


@query("serial_day_to_date", "SELECT event_id, DATE '1899-12-31' + CAST(event_id AS INTEGER) AS day FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", S.from_serial_day(F.col("event_id")).alias("day"))


@query("float_to_int", """SELECT event_id, CAST(trunc(value) AS BIGINT) AS cut, CAST(round_even(value * 2 / 4, 0) AS BIGINT) AS nearest,
       CAST(round_even(event_id / 2, 0) AS BIGINT) AS halves FROM events""")
def _(spark, d):
    rows = table(spark, d, "events").select("event_id", F.col("value").alias("cut"), (F.col("value") * 2 / 4).alias("nearest"),
                                            (F.col("event_id") / 2).alias("halves"))
    return clean.to_int(clean.to_int(rows, ["cut"]), ["nearest", "halves"], "round")


@query("clean_text", f"SELECT o_orderkey, trim(lower(dirty_text)) AS dirty_text FROM ({O})")
def _(spark, d):
    return clean.clean_text(dirty.orders(spark, d).select("o_orderkey", "dirty_text"))


@query("replace_values", """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'TOP' WHEN '2-HIGH' THEN 'TOP' ELSE o_orderpriority END AS o_orderpriority
       FROM orders""")
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return clean.replace_values(rows, "o_orderpriority", {"1-URGENT": "TOP", "2-HIGH": "TOP"})


@query("tokens_to_null", f"""SELECT o_orderkey, CASE WHEN lower(trim(dirty_text)) IN ('', 'na', 'n/a', 'null', 'none', 'nan', '?', '-999')
       THEN NULL ELSE trim(dirty_text) END AS dirty_text FROM ({O})""")
def _(spark, d):
    return clean.tokens_to_null(dirty.orders(spark, d).select("o_orderkey", "dirty_text"))


@query("clip_values", f"SELECT o_orderkey, CASE WHEN price < 50000 THEN 50000 WHEN price > 300000 THEN 300000 ELSE price END AS price FROM ({O})")
def _(spark, d):
    return clean.clip(dirty.orders(spark, d).select("o_orderkey", "price"), "price", 50000.0, 300000.0)


@query("log_transforms", f"""SELECT l_orderkey, l_linenumber, log10(price) AS a, log10(quantity + 1) AS b,
       log10(CASE WHEN discount = 0 THEN 0.01 ELSE discount END) AS c, ln(1 + tax) AS d FROM ({I})""", doubles="a b c d")
def _(spark, d):
    rows = dirty.items(spark, d)
    return rows.select("l_orderkey", "l_linenumber", S.log_of(F.col("price")).alias("a"), S.log_of(F.col("quantity"), "log10p1").alias("b"),
                       S.log_of(F.col("discount"), "log10floor").alias("c"), S.log_of(F.col("tax"), "log1p").alias("d"))


@query("safe_ratio", f"SELECT l_orderkey, l_linenumber, price / (tax + 1e-8) AS ratio, quantity / (discount + 1e-8) AS other FROM ({I})", doubles="ratio other", scale=2)
def _(spark, d):
    rows = dirty.items(spark, d)
    return rows.select("l_orderkey", "l_linenumber", S.safe_divide(F.col("price"), F.col("tax")).alias("ratio"),
                       S.safe_divide(F.col("quantity"), F.col("discount")).alias("other"))


@query("column_norm", "SELECT l_orderkey, l_linenumber, sqrt(l_quantity * l_quantity + l_extendedprice * l_extendedprice) AS norm FROM lineitem", doubles="norm", scale=4)
def _(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", S.norm([F.col("l_quantity"), F.col("l_extendedprice")]).alias("norm"))


@query("infinite_to_null", """SELECT event_id, CASE WHEN event_id % 4 IN (0, 1, 2) THEN NULL ELSE value END AS v FROM events""")
def _(spark, d):
    bad = F.expr("CASE event_id % 4 WHEN 0 THEN double('inf') WHEN 1 THEN double('-inf') WHEN 2 THEN double('nan') ELSE value END")
    return clean.inf_to_null(table(spark, d, "events").select("event_id", bad.alias("v")), ["v"])


@query("round_and_class", """SELECT event_id, round_even(value / 7, 4) AS rounded,
       CAST(greatest(0, least(2, round_even(value / 30, 0))) AS INTEGER) AS class FROM events""", doubles="rounded", scale=4)
def _(spark, d):
    rows = table(spark, d, "events").select("event_id", (F.col("value") / 7).alias("rounded"), S.to_class(F.col("value") / 30, 0, 2).alias("class"))
    return clean.round_cols(rows, ["rounded"], 4)


# nulls ----------------------------------------------------------------------------------

@query("drop_null_rows", f"""SELECT 'any' AS how, count(*) AS n FROM ({I}) WHERE quantity IS NOT NULL AND price IS NOT NULL AND flag IS NOT NULL
       UNION ALL SELECT 'all', count(*) FROM ({I}) WHERE NOT (quantity IS NULL AND price IS NULL AND flag IS NULL)
       UNION ALL SELECT 'two', count(*) FROM ({I}) WHERE (quantity IS NOT NULL)::INT + (price IS NOT NULL)::INT + (flag IS NOT NULL)::INT >= 2""")
def _(spark, d):
    rows, cols = dirty.items(spark, d), ["quantity", "price", "flag"]
    count = lambda name, df: df.agg(F.lit(name).alias("how"), F.count(F.lit(1)).alias("n"))
    return (count("any", impute.drop_null_rows(rows, subset=cols))
            .unionByName(count("all", impute.drop_null_rows(rows, "all", subset=cols)))
            .unionByName(count("two", impute.drop_null_rows(rows, thresh=2, subset=cols))))


@query("drop_null_columns", f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, discount, tax, status, same FROM ({I})")
def _(spark, d):
    return impute.drop_null_columns(dirty.items(spark, d))


@query("fill_constant", f"SELECT l_orderkey, l_linenumber, coalesce(quantity, 0) AS quantity, coalesce(price, -1) AS price, coalesce(flag, 'MISSING') AS flag FROM ({I})")
def _(spark, d):
    rows = dirty.items(spark, d).select("l_orderkey", "l_linenumber", "quantity", "price", "flag")
    return impute.fill_const(impute.fill_const(rows, "MISSING"), {"quantity": 0.0, "price": -1.0})


@query("fill_mean", f"SELECT l_orderkey, l_linenumber, coalesce(quantity, avg(quantity) OVER ()) AS quantity, coalesce(price, avg(price) OVER ()) AS price FROM ({I})",
       doubles="quantity price", scale=4)
def _(spark, d):
    rows = dirty.items(spark, d).select("l_orderkey", "l_linenumber", "quantity", "price")
    return impute.apply_impute(rows, impute.fit_impute(rows, ["quantity", "price"], "mean"))


@query("fill_median", f"""SELECT l_orderkey, l_linenumber, coalesce(quantity, (SELECT quantile_cont(quantity, 0.5) FROM ({I}))) AS quantity,
       coalesce(price, (SELECT quantile_cont(price, 0.5) FROM ({I}))) AS price FROM ({I})""", doubles="quantity price")
def _(spark, d):
    rows = dirty.items(spark, d).select("l_orderkey", "l_linenumber", "quantity", "price")
    return impute.apply_impute(rows, impute.fit_impute(rows, ["quantity", "price"], "median"))


@query("fill_median_from_train", f"""SELECT o_orderkey, coalesce(price, (SELECT quantile_cont(price, 0.5) FROM ({O}) WHERE o_orderdate < TIMESTAMP '1999-01-01')) AS price
       FROM ({O})""", doubles="price")
def _(spark, d):
    rows = dirty.orders(spark, d)
    train = rows.where("o_orderdate < timestamp'1999-01-01'")
    return impute.apply_impute(rows.select("o_orderkey", "price"), impute.fit_impute(train, ["price"], "median"))


def _mode_sql(column, source):
    return f"(SELECT {column} FROM ({source}) WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {column} LIMIT 1)"


@query("fill_mode", f"SELECT l_orderkey, l_linenumber, coalesce(flag, {_mode_sql('flag', I)}) AS flag, coalesce(quantity, {_mode_sql('quantity', I)}) AS quantity FROM ({I})")
def _(spark, d):
    rows = dirty.items(spark, d).select("l_orderkey", "l_linenumber", "flag", "quantity")
    return impute.apply_impute(rows, impute.fit_impute(rows, ["flag", "quantity"], "mode"))


@query("forward_fill", f"""SELECT event_id, last_value(reading IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS whole,
       last_value(reading IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS per_user FROM ({E})""")
def _(spark, d):
    rows = dirty.events(spark, d).withColumns({"whole": F.col("reading"), "per_user": F.col("reading")})
    filled = impute.ffill(rows, "whole", ["ts", "event_id"])
    return impute.ffill(filled, "per_user", ["ts", "event_id"], ["user_id"]).select("event_id", "whole", "per_user")


@query("backward_fill", f"""SELECT event_id, first_value(reading IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS whole,
       first_value(reading IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS per_user FROM ({E})""")
def _(spark, d):
    rows = dirty.events(spark, d).withColumns({"whole": F.col("reading"), "per_user": F.col("reading")})
    filled = impute.bfill(rows, "whole", ["ts", "event_id"])
    return impute.bfill(filled, "per_user", ["ts", "event_id"], ["user_id"]).select("event_id", "whole", "per_user")


@query("interpolate", f"""WITH p AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS pos FROM ({E})),
       a AS (SELECT *, last_value(CASE WHEN reading IS NOT NULL THEN pos END IGNORE NULLS) OVER w AS p0, last_value(reading IGNORE NULLS) OVER w AS v0,
         first_value(CASE WHEN reading IS NOT NULL THEN pos END IGNORE NULLS) OVER x AS p1, first_value(reading IGNORE NULLS) OVER x AS v1 FROM p
         WINDOW w AS (ORDER BY pos ROWS UNBOUNDED PRECEDING), x AS (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
       SELECT event_id, CASE WHEN reading IS NOT NULL THEN reading WHEN v0 IS NOT NULL AND v1 IS NOT NULL
         THEN v0 + (v1 - v0) / (p1 - p0) * (pos - p0) ELSE v0 END AS reading FROM a""", doubles="reading")
def _(spark, d):
    return impute.interpolate(dirty.events(spark, d), "reading", ["ts", "event_id"]).select("event_id", "reading")


@query("interpolate_per_user", f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM ({E})),
       a AS (SELECT *, last_value(CASE WHEN reading IS NOT NULL THEN pos END IGNORE NULLS) OVER w AS p0, last_value(reading IGNORE NULLS) OVER w AS v0,
         first_value(CASE WHEN reading IS NOT NULL THEN pos END IGNORE NULLS) OVER x AS p1, first_value(reading IGNORE NULLS) OVER x AS v1 FROM p
         WINDOW w AS (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING),
                x AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
       SELECT event_id, CASE WHEN reading IS NOT NULL THEN reading WHEN v0 IS NOT NULL AND v1 IS NOT NULL
         THEN v0 + (v1 - v0) / (p1 - p0) * (pos - p0) ELSE v0 END AS reading FROM a""", doubles="reading")
def _(spark, d):
    return impute.interpolate(dirty.events(spark, d), "reading", ["ts", "event_id"], ["user_id"]).select("event_id", "reading")


@query("complete_cases", f"SELECT l_orderkey, l_linenumber, quantity, price, flag FROM ({I}) WHERE quantity IS NOT NULL AND price IS NOT NULL AND flag IS NOT NULL")
def _(spark, d):
    return impute.complete_cases(dirty.items(spark, d), ["quantity", "price", "flag"]).select("l_orderkey", "l_linenumber", "quantity", "price", "flag")


@query("require_label", f"SELECT count(status) AS n_kept, count(*) - count(status) AS n_dropped FROM ({O})")
def _(spark, d):
    return impute.require_label(dirty.orders(spark, d), "status")[1]


@query("ensure_numeric", f"""SELECT o_orderkey, coalesce(TRY_CAST(text80 AS DOUBLE), (SELECT quantile_cont(TRY_CAST(text80 AS DOUBLE), 0.5) FROM ({O}))) AS text80,
       coalesce(price, (SELECT quantile_cont(price, 0.5) FROM ({O}))) AS price FROM ({O})""", doubles="text80 price")
def _(spark, d):
    return impute.ensure_numeric(dirty.orders(spark, d).select("o_orderkey", "text80", "price"), ["text80", "price"])


# duplicates -----------------------------------------------------------------------------

@query("flag_duplicates", """SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) > 1 AS is_duplicate FROM orders""")
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return dedup.flag_duplicates(rows, ["o_custkey", "o_orderstatus"], ["o_orderkey"]).select("o_orderkey", "is_duplicate")


@query("count_duplicates", f"SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM {D} GROUP BY o_orderkey, o_custkey, status)")
def _(spark, d):
    return dedup.count_duplicates(dirty.doubled(spark, d))


@query("drop_exact_duplicates", f"SELECT DISTINCT * FROM {D}")
def _(spark, d):
    return dedup.drop_duplicates(dirty.doubled(spark, d))


@query("drop_duplicates_keep_first", """SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) = 1""")
def _(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")
    return dedup.drop_duplicates(rows, ["o_custkey", "o_orderstatus"], "first", ["o_orderkey"])


@query("drop_duplicates_keep_last", """SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey DESC) = 1""")
def _(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")
    return dedup.drop_duplicates(rows, ["o_custkey", "o_orderstatus"], "last", ["o_orderkey"])
