"""Queries: every source and sink, as a round trip of a given table through the shared folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.runtime import scratch_path
from ..operators import cluster, outliers, scale, split
from ..operators.params import Params
from .. import sources
from .explore import MEASURES, _iqr_sql
from .registry import query, table

CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@query("csv_scan", "SELECT * FROM customer")
def _(spark, d):
    path = scratch_path(spark, "csv")
    sources.write_csv(table(spark, d, "customer"), path)
    return sources.read_csv(spark, path, schema=CUSTOMER)


@query("csv_semicolon_inferred", "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def _(spark, d):
    path = scratch_path(spark, "csv")
    sources.write_csv(table(spark, d, "part"), path, sep=";")
    return sources.read_csv(spark, path)


@query("csv_missing_tokens", """SELECT CAST(p_partkey AS INTEGER) AS p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN p_name END AS p_name,
       CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 THEN p_retailprice END AS price, CASE WHEN p_partkey % 3 <> 0 THEN p_size END AS size FROM part""")
def _(spark, d):
    path = scratch_path(spark, "csv")
    rows = table(spark, d, "part").selectExpr(
        "p_partkey", "CASE WHEN p_partkey % 11 = 0 THEN 'None' ELSE p_name END AS p_name",
        "CASE WHEN p_partkey % 5 = 0 THEN 'NaN' WHEN p_partkey % 7 = 0 THEN 'N/A' ELSE CAST(p_retailprice AS STRING) END AS price",
        "CASE WHEN p_partkey % 3 = 0 THEN 'NA' ELSE CAST(p_size AS STRING) END AS size")
    sources.write_csv(rows, path)
    return sources.read_csv(spark, path, encoding="UTF-8")


@query("csv_quoted_separator", """SELECT CAST(p_partkey AS INTEGER) AS "key, part", p_retailprice AS "price, usd", p_name || '; ' || p_brand AS "name" FROM part""")
def _(spark, d):
    path = scratch_path(spark, "csv")
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("key, part"), F.col("p_retailprice").alias("price, usd"), F.concat_ws("; ", "p_name", "p_brand").alias("name"))
    rows.write.option("header", True).option("sep", ";").option("quoteAll", True).option("escape", "\"").csv(path)
    return sources.read_csv(spark, path)


@query("csv_line_breaks", """SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name || chr(10) || 'said "' || p_brand || '", twice' AS note FROM part""")
def _(spark, d):
    path = scratch_path(spark, "csv")
    rows = table(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit("\nsaid \""), "p_brand", F.lit("\", twice")).alias("note"))
    sources.write_csv(rows, path)
    return sources.read_csv(spark, path, multiline=True)


@query("csv_latin1", "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, 'Señor ' || s_name || ' é' AS s_name FROM supplier")
def _(spark, d):
    path = scratch_path(spark, "csv")
    rows = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("Señor "), "s_name", F.lit(" é")).alias("s_name"))
    rows.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return sources.read_csv(spark, path)


@query("csv_first_of_folder", "SELECT * FROM customer")
def _(spark, d):
    # one folder per segment and one file in each, so the first file is all of it
    path = scratch_path(spark, "csv")
    rows = table(spark, d, "customer").withColumn("seg", F.col("c_mktsegment")).repartition("seg")
    rows.write.partitionBy("seg").option("header", True).csv(path)
    names = [r[0] for r in rows.select("c_mktsegment").distinct().orderBy("c_mktsegment").collect()]
    return reduce(lambda a, b: a.unionByName(b), [sources.first_csv(spark, f"{path}/seg={n}", schema=CUSTOMER) for n in names])


@query("json_dictionary", """SELECT 'brands' AS description, '2024' AS period, p_brand AS "column", CAST(count(*) AS VARCHAR) || ' parts' AS meaning FROM part GROUP BY p_brand""")
def _(spark, d):
    path = scratch_path(spark, "dictionary")
    counts = table(spark, d, "part").groupBy("p_brand").agg(F.concat(F.count(F.lit(1)).cast("string"), F.lit(" parts")).alias("v"))
    doc = counts.agg(F.map_from_entries(F.collect_list(F.struct("p_brand", "v"))).alias("columns"))
    sources.write_report_json(doc.select(F.lit("brands").alias("description"), F.lit("2024").alias("period"), "columns"), path)
    return sources.read_dictionary(spark, path)


@query("literal_table", """SELECT o_orderstatus, meaning, count(*) AS n FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) AS t(code, meaning)
       ON o_orderstatus = code GROUP BY 1, 2""")
def _(spark, d):
    names = sources.read_rows(spark, [("F", "finished"), ("O", "open"), ("P", "partial")], "code string, meaning string")
    orders = table(spark, d, "orders")
    return (orders.join(F.broadcast(names), orders["o_orderstatus"] == names["code"])  # three literal rows
            .groupBy("o_orderstatus", "meaning").agg(F.count(F.lit(1)).alias("n")))


@query("parquet_partitioned", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def _(spark, d):
    path = scratch_path(spark, "parquet")
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    sources.write_parquet(rows, path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path)


@query("report_json", f"""SELECT "column", q1, q3, n_outliers FROM ({_iqr_sql(MEASURES, "lineitem")})""", doubles="q1 q3")
def _(spark, d):
    path = scratch_path(spark, "report")
    sources.write_report_json(outliers.iqr_report(table(spark, d, "lineitem"), MEASURES), path)
    return spark.read.schema("column string, q1 double, q3 double, n_outliers bigint").json(path)


@query("report_text", """SELECT c_mktsegment || ': ' || CAST(count(*) AS VARCHAR) || ' customers' AS value FROM customer GROUP BY c_mktsegment""")
def _(spark, d):
    path = scratch_path(spark, "report")
    counts = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    sources.write_report_text(counts, path, "%s: %d customers", ["c_mktsegment", "n"])
    return spark.read.text(path)


@query("saved_scaler", "SELECT event_id, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS value FROM events", doubles="value")
def _(spark, d):
    path = scratch_path(spark, "scaler")
    rows = table(spark, d, "events").select("event_id", "value")
    sources.save_params(scale.fit_scaler(rows, ["value"]).to_frame(spark), path)
    return scale.apply_scaler(rows, Params.from_frame(sources.load_params(spark, path)))


@query("saved_selection", """SELECT CASE WHEN (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') > 0 THEN 'kmeans' END AS name, 'cluster_kmeans' AS label_column""")
def _(spark, d):
    # two candidate groupings scored by their balance; the winner's name is saved and looked up again
    from ..operators.agreement import cluster_balance
    rows = table(spark, d, "lineitem").withColumns({
        "a": F.when(F.col("l_returnflag") == "R", 1).otherwise(0), "b": F.when(F.col("l_tax") == 0, 1).otherwise(0)})
    one = rows.agg(F.count(F.lit(1)).alias("n")).withColumns({"silhouette": F.lit(0.5), "n_noise": F.lit(0)})
    metrics = one.withColumn("algorithm", F.lit("KMeans")).withColumn("balance", cluster_balance(rows, "a").scalar()).unionByName(
        one.withColumn("algorithm", F.lit("DBSCAN")).withColumn("balance", cluster_balance(rows, "b").scalar()))
    path = scratch_path(spark, "selection")
    sources.write_report_text(cluster.select_clustering(metrics).limit(1), path, "Selected: %s", ["algorithm"])
    return spark.createDataFrame([sources.selected_model(spark, path)], "name string, label_column string")


_YEAR = "CAST(extract(year FROM o_orderdate) AS INTEGER)"
_PERIOD_SPLIT = f"""SELECT o_orderkey, {_YEAR} AS year, CASE dense_rank() OVER (ORDER BY {_YEAR} DESC) WHEN 1 THEN 'holdout' WHEN 2 THEN 'test' WHEN 3 THEN 'valid' ELSE 'train' END AS split FROM orders"""


@query("split_export", _PERIOD_SPLIT)
def _(spark, d):
    path = scratch_path(spark, "splits")
    rows = split.period_split(table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year")), "year")
    names = ["train", "valid", "test", "holdout"]
    sources.write_splits({n: rows.where(F.col("split") == n).drop("split") for n in names}, path)
    return spark.read.parquet(path)


@query("run_metadata", f"SELECT split, count(*) AS n FROM ({_PERIOD_SPLIT}) GROUP BY 1")
def _(spark, d):
    path = scratch_path(spark, "metadata")
    rows = split.period_split(table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year")), "year")
    sizes = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}  # four rows
    sources.write_metadata(spark, {"label": "none", "split_rows": sizes}, path)
    back = spark.read.schema("label string, split_rows map<string,bigint>").json(path)
    return back.select(F.explode("split_rows").alias("split", "n"))
