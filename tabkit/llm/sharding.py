"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, range partitions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.runtime import q
from .common import packed, staged, unpacked

RANGES_PER_SHARD = 16
ROWS_PER_RANGE = 100_000
MAX_RANGES = 20_000
SAMPLE_PER_RANGE = 32
ROW_BYTES = 16


def splitters(keyed: DataFrame, ranges: int, total: int) -> list[tuple[int, float]]:
    """Boundaries (hash, spread) between ranges of about equal bytes.

    A row enters the sample with a chance in proportion to its size, so equal shares of the sample
    are equal shares of the bytes. At most a few times ``ranges`` * SAMPLE_PER_RANGE keys reach the
    driver, whatever the input. Two neighbouring boundaries within one hash mark a group of copies too
    large for one range, which is subdivided by the spread; any other boundary is moved to the start of
    its group, so that smaller groups stay whole.
    """
    wanted = ranges * SAMPLE_PER_RANGE
    drawn = keyed.where(F.col("__u") * total < F.col("__size") * float(wanted)).select("__h", "__r").toPandas()
    drawn = drawn.sort_values(["__h", "__r"], ignore_index=True)
    if not len(drawn):
        return []
    at = (np.arange(1, ranges) * len(drawn)) // ranges
    cuts = list(zip(drawn["__h"].to_numpy()[at].tolist(), drawn["__r"].to_numpy()[at].tolist()))
    hashes = [h for h, _ in cuts]
    heavy = {a for a, b in zip(hashes, hashes[1:]) if a == b}
    return sorted({(h, r) if h in heavy else (h, -1.0) for h, r in cuts} | {(h, -1.0) for h in heavy})


def _place(cuts: list[tuple[int, float]]):
    """Twice the number of boundaries not above the row, plus one if its group is subdivided."""
    hashes, spreads = np.array([c[0] for c in cuts], dtype=np.int64), np.array([c[1] for c in cuts])
    divided = np.unique(hashes[spreads >= 0])

    @F.pandas_udf("int")
    def place(h: pd.Series, r: pd.Series) -> pd.Series:
        hv, rv = h.to_numpy(), r.to_numpy()
        low, high = np.searchsorted(hashes, hv, "left"), np.searchsorted(hashes, hv, "right")
        out = high.copy()  # boundaries not above the row: all with a smaller hash, and of its own hash those not above its spread
        for i in np.flatnonzero(high > low):
            out[i] = low[i] + np.searchsorted(spreads[low[i]:high[i]], rv[i], "right")
        return pd.Series((2 * out + np.isin(hv, divided)).astype(np.int32))

    return place


def shard_by_bytes(docs: DataFrame, shards: int = 40, text: str = "text", seed: int = 42) -> DataFrame:
    """All columns of ``docs`` but the text, with ``size`` (UTF-8 bytes of the text plus 16), ``text_crc32``,
    ``law`` ("bytes"), ``shard``, ``slot`` and ``grown_shard`` (null under this law).

    Rows are ordered by the hash of their text, so equal texts lie together. Sampled splitters cut that
    order into ranges of about equal bytes, many per shard; exact sums per range give every row its place
    in bytes, and shard k takes the k-th share of the total. Sizes differ from an even share by one
    row or one small group at most. Equal texts share a shard unless they weigh more than about one range
    (1/16 of a shard); such a group is subdivided. Slots count from 0 in every shard.

    A null text has no bytes (size 16) and a null text_crc32; an empty one the crc32 of nothing, 0. Rows equal in all
    columns are told apart by the random spread, which is drawn once and written with the rows. Columns
    of ``docs`` with an output's name are replaced.
    """
    made = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    others = [c for c in docs.columns if c != text and c not in made]
    t = docs[q(text)]
    keyed = staged(docs.select(
        packed(docs, others), (F.coalesce(F.octet_length(t), F.lit(0)) + ROW_BYTES).cast("long").alias("__size"),
        F.crc32(F.encode(t, "UTF-8")).alias("__crc"), F.xxhash64(t).alias("__h"), F.rand(seed).alias("__r"),
        F.rand(seed + 1).alias("__u")), "sharding")
    total, n = keyed.agg(F.sum("__size"), F.count(F.lit(1))).first()
    if not n:
        return _named(keyed.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}), others)
    ranges = int(min(MAX_RANGES, max(RANGES_PER_SHARD * shards, n // ROWS_PER_RANGE)))
    cuts = splitters(keyed.select("__h", "__r", "__u", "__size"), ranges, total)
    ranged = keyed.withColumn("__placed", _place(cuts)("__h", "__r")).withColumn("__range", F.floor(F.col("__placed") / 2).cast("int"))

    sums = ranged.groupBy("__range").agg(F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # at most MAX_RANGES rows
    offsets = sums.select(F.col("__range").alias("__range2"), F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("__bytes0"),
                          F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__rows0"))
    order = Window.partitionBy("__range").orderBy("__h", "__r")
    group = Window.partitionBy("__range", "__h")
    placed = ranged.select(
        "*", (F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__size")).alias("__start"),
        (F.row_number().over(order) - 1).cast("long").alias("__row"))
    heavy = F.col("__placed") % 2 == 1
    placed = placed.select(
        "*", F.when(heavy, F.col("__start")).otherwise(F.min("__start").over(group)).alias("__from"),
        F.when(heavy, F.col("__size")).otherwise(F.sum("__size").over(group)).alias("__span"))
    middle = F.col("__bytes0") + F.col("__from") + F.col("__span") / 2
    placed = placed.join(F.broadcast(offsets), F.col("__range") == F.col("__range2")).withColumns({
        "shard": F.least(F.floor(middle * shards / F.lit(float(total))), F.lit(shards - 1)).cast("int"),
        "__at": F.col("__rows0") + F.col("__row")})
    first = placed.groupBy(F.col("shard").alias("__shard")).agg(F.min("__at").alias("__first"))  # one row per shard
    return _named(placed.join(F.broadcast(first), F.col("shard") == F.col("__shard"))
                  .withColumn("slot", F.col("__at") - F.col("__first")), others)


def _named(placed: DataFrame, others: list[str]) -> DataFrame:
    return placed.select(*unpacked(others), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
