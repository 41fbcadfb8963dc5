"""Tables with deterministic defects: nulls, duplicates, dirty text, gaps.

The given tables are clean, so queries about defects read them through these expressions. The
texts are valid in Spark and in the SQL the checks run on.
"""

from __future__ import annotations

from .registry import select_sql, table

ITEMS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS quantity",
    "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_extendedprice END AS price",
    "l_discount + 0.0 AS discount",
    "l_tax + 0.0 AS tax",
    "CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_returnflag END AS flag",
    "l_linestatus AS status",
    "CAST(NULL AS DOUBLE) AS empty",
    "1.5 * 2 AS same",
]
ORDERS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate",
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price",
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status",
    "CASE WHEN o_orderkey % 9 = 0 THEN '  ' || lower(o_orderpriority) || ' ' WHEN o_orderkey % 9 = 1 THEN ' N/A' "
    "WHEN o_orderkey % 9 = 2 THEN '' WHEN o_orderkey % 9 = 3 THEN '?' WHEN o_orderkey % 9 = 4 THEN '-999 ' "
    "WHEN o_orderkey % 9 = 5 THEN NULL ELSE o_orderpriority END AS dirty_text",
    "CASE WHEN o_orderkey % 10 = 0 THEN 'abc' WHEN o_orderkey % 10 = 1 THEN ' ' ELSE CAST(o_custkey AS VARCHAR(20)) END AS text80",
    "CASE WHEN o_orderkey % 10 <= 2 THEN 'abc' ELSE CAST(o_custkey AS VARCHAR(20)) END AS text70",
    "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR(20)) END AS text_gaps",
    "CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR(20)) || ',234.5' ELSE '12' END AS thousands",
    "CASE WHEN o_orderkey % 4 = 0 THEN '2024-05' WHEN o_orderkey % 4 = 1 THEN '15/05/2024' "
    "WHEN o_orderkey % 4 = 2 THEN '2024-02-29' ELSE 'soon' END AS date_text",
]
EVENTS = [
    "event_id", "ts", "user_id", "event_type", "value",
    "CASE WHEN event_id % 5 = 0 OR event_id < 4 THEN NULL ELSE value END AS reading",
]
# every order of one status occurs twice, once more with another price for some keys
DOUBLED = ["o_orderkey", "o_custkey", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status"]

ITEMS_SQL = select_sql(ITEMS, "lineitem")
ORDERS_SQL = select_sql(ORDERS, "orders")
EVENTS_SQL = select_sql(EVENTS, "events")
DOUBLED_SQL = (f"({select_sql(DOUBLED, 'orders')} UNION ALL {select_sql(DOUBLED, 'orders')} WHERE o_orderstatus = 'F')")


def items(spark, folder):
    return table(spark, folder, "lineitem").selectExpr(*ITEMS)


def orders(spark, folder):
    return table(spark, folder, "orders").selectExpr(*ORDERS)


def events(spark, folder):
    return table(spark, folder, "events").selectExpr(*EVENTS)


def doubled(spark, folder):
    o = table(spark, folder, "orders")
    return o.selectExpr(*DOUBLED).unionAll(o.where("o_orderstatus = 'F'").selectExpr(*DOUBLED))
