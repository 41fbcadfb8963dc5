"""Cluster-driven relabelling: mapping, corrected labels, change reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import col, cut_lineage
from .agreement import contingency
from .combine import map_values
from .encode import STRESS_CODES

CLUSTER_CAP = 100_000

# Change shares up to which the relabelling is fine or merely high; text of an unchanged class.
CHANGE_OK, CHANGE_HIGH = 30.0, 50.0
NO_CHANGES = "Sin cambios"


def cluster_shares(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """(cluster, label, share): label distribution inside each cluster."""
    cells = contingency(df, label, cluster, noise=None).select(F.col("b").alias("cluster"), F.col("a").alias("label"), "n")
    totals = cells.groupBy(F.col("cluster").alias("__c")).agg(F.sum("n").alias("__t"))
    return cells.join(totals, cells["cluster"] == totals["__c"]).select("cluster", "label", "n", (F.col("n") / F.col("__t")).alias("share"))


def map_clusters_to_labels(df: DataFrame, cluster: str, label: str, classes: list | None = None) -> dict:
    """Dominant label per cluster. When that leaves a class without any cluster, classes are first
    handed out one to one by descending share (larger cluster number, then larger class name,
    first); clusters left over keep their dominant label."""
    rows = cluster_shares(df, cluster, label).limit(CLUSTER_CAP + 1).collect()  # clusters x classes
    if len(rows) > CLUSTER_CAP:
        raise ValueError(f"more than {CLUSTER_CAP} cluster and label pairs")
    share = {(r["cluster"], r["label"]): r["share"] for r in rows}
    clusters = sorted({c for c, _ in share})
    seen = sorted({l for _, l in share})
    classes = sorted(classes) if classes else seen
    dominant = {c: min(seen, key=lambda l: (-share.get((c, l), 0.0), l)) for c in clusters}
    if set(classes) <= set(dominant.values()):
        return dominant
    ranked = sorted(((share.get((c, l), 0.0), c, l) for c in clusters for l in classes), reverse=True)
    taken: dict = {}
    for _, c, l in ranked:
        if c not in taken and l not in taken.values():
            taken[c] = l
    return {c: taken.get(c, dominant[c]) for c in clusters}


def relabel(df: DataFrame, cluster: str, label: str, mapping: dict, codes: dict | None = None) -> DataFrame:
    """Corrected label (original where the cluster is unmapped), its code and whether it changed."""
    codes = codes if codes is not None else STRESS_CODES
    out = map_values(df, cluster, mapping, "corrected", default=label)
    out = map_values(out, "corrected", codes, "corrected_code")
    return out.withColumn("label_changed", ~col(label).eqNullSafe(F.col("corrected")))


def change_report(df: DataFrame, label: str) -> DataFrame:
    """Per original class: rows, changed rows, changed % and where most of them went."""
    moves = df.groupBy(col(label).alias("label"), "corrected").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("label_changed").alias("c"))
    per = moves.groupBy("label").agg(
        F.sum("n").alias("n_rows"), F.sum("c").alias("n_changed"),
        F.min_by("corrected", F.when(F.col("c") > 0, F.struct(-F.col("c"), F.col("corrected")))).alias("dest"))
    return per.select("label", "n_rows", "n_changed", F.round(100.0 * F.col("n_changed") / F.col("n_rows"), 2).alias("pct_changed"),
                      F.coalesce("dest", F.lit(NO_CHANGES)).alias("main_destination"))


def change_level(df: DataFrame) -> DataFrame:
    """Overall changed share and its band."""
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("label_changed").alias("n_changed"))
    pct = 100.0 * F.col("n_changed") / F.col("n_rows")
    return agg.withColumn("pct_changed", pct).withColumn(
        "level", F.when(pct <= CHANGE_OK, "ok").when(pct <= CHANGE_HIGH, "high").otherwise("critical"))


def lost_classes(df: DataFrame, label: str) -> DataFrame:
    """Original classes that no corrected row carries."""
    from .combine import set_diff
    return set_diff(df.select(col(label).alias("label")), df.select(F.col("corrected").alias("label")), "label")


def transition(df: DataFrame, label: str) -> DataFrame:
    """Zero-filled (before, after, n) over the labels of either side."""
    from .metrics import confusion
    pairs = df.groupBy(col(label).alias("a"), F.col("corrected").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    both = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("label")).where("label is not null").distinct())
    return confusion(df, both, label, "corrected").select(F.col("actual").alias("before"), F.col("predicted").alias("after"), "n")
