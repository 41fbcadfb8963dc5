"""SimHash near-duplicates: a vantage-point tree partitions the fingerprints by Hamming distance.

The tree is fitted on a bounded sample; every fingerprint is routed through it. Each has one home shard, and goes as a
query to every other shard that its ball may overlap (triangle bounds prune the rest). Shards compare their
rows exactly, so the links are all pairs within the radius, found once each, and only a spanning forest of them leaves a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.runtime import q
from ..operators.neighbors import components
from .common import byte_words, mix, signed, staged, unsigned, with_arrow

SEED = 42
SHARD_ROWS = 8_192
MAX_SHARDS = 32_768
SAMPLE_PER_SHARD = 32
VANTAGE_CANDIDATES = 16
PAIRS_AT_ONCE = 2_000_000

_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def shingle_hashes(tokens: list[bytes], k: int) -> np.ndarray:
    """XXH64 of every run of k words, repeats included; of the whole sequence if it is shorter."""
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    if len(tokens) <= k:
        return np.array([_hash(b" ".join(tokens))], dtype=np.uint64)
    runs = zip(*(tokens[i:] for i in range(k)))
    return np.fromiter(map(_hash, map(b" ".join, runs)), dtype=np.uint64, count=len(tokens) - k + 1)


def simhash(hashes: np.ndarray) -> int:
    """64 majority votes; without hashes zero."""
    if not len(hashes):
        return 0
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = np.ascontiguousarray(hashes[at:at + 65_536], dtype="<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle_words: int = 3, name: str = "fingerprint") -> DataFrame:
    """``docs`` with the SimHash of the lower-cased words' shingles as a signed 64-bit column. A null text has no words: zero."""
    def run(texts: list[str | None]) -> dict[str, list]:
        prints = [simhash(shingle_hashes(byte_words(t, lower=True), shingle_words)) for t in texts]
        return {name: signed(np.array(prints, dtype=np.uint64)).tolist()}

    return with_arrow(docs, docs[q(text)], T.StructType([T.StructField(name, T.LongType())]), run)


class VantageTree:
    """Inner nodes hold a vantage fingerprint and the median distance to it; leaves are shards."""

    def __init__(self, sample: np.ndarray, leaf_sample: int, seed: int = SEED) -> None:
        self.nodes: list[tuple] = []  # (vantage, median, inner, outer) or (shard,)
        self.shards = 0
        self._rng = np.random.default_rng(seed)
        self._grow(np.unique(sample), max(2, leaf_sample))

    def _grow(self, points: np.ndarray, leaf_sample: int) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if len(points) > leaf_sample:
            tried = self._rng.choice(points, min(VANTAGE_CANDIDATES, len(points)), replace=False)
            probe = points if len(points) <= 512 else self._rng.choice(points, 512, replace=False)
            spread = [np.bitwise_count(probe ^ v).astype(np.float64).std() for v in tried]
            vantage = tried[int(np.argmax(spread))]
            distance = np.bitwise_count(points ^ vantage)
            median = int(np.median(distance))
            inside = distance <= median
            if inside.all():
                median -= 1
                inside = distance <= median
            if inside.any() and not inside.all():
                self.nodes[at] = (vantage, median, self._grow(points[inside], leaf_sample), self._grow(points[~inside], leaf_sample))
                return at
        self.nodes[at] = (self.shards,)
        self.shards += 1
        return at

    def homes(self, prints: np.ndarray) -> np.ndarray:
        out = np.empty(len(prints), dtype=np.int32)
        for shard, home, _ in self.route(prints, 0):
            out[home] = shard
        return out

    def route(self, prints: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, rows at home, rows that query it). Of a pair on two sides of a boundary only the inner row crosses it."""
        none = np.empty(0, dtype=np.int64)
        stack = [(0, np.arange(len(prints)), none)]
        while stack:
            at, home, query = stack.pop()
            if not len(home) and not len(query):
                continue
            node = self.nodes[at]
            if len(node) == 1:
                yield node[0], home, query
                continue
            vantage, median, inner, outer = node
            dh = np.bitwise_count(prints[home] ^ vantage).astype(np.int16)
            dq = np.bitwise_count(prints[query] ^ vantage).astype(np.int16)
            inside = dh <= median
            crossing = home[inside & (dh + radius > median)]
            stack.append((inner, home[inside], query[dq - radius <= median]))
            stack.append((outer, home[~inside], np.concatenate([query[dq + radius > median], crossing])))


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of every pair (a[i], b[i]); the smaller root stays."""
    def root(x):
        p = parent[x]
        while True:
            up = parent[p]
            if (up == p).all():
                return p
            p = up
    while len(a):
        ra, rb = root(a), root(b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def close_pairs(home: np.ndarray, others: np.ndarray, radius: int, vantage: np.uint64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within the radius, block by block. Rows sorted by their distance to a vantage point only
    meet others whose distance differs by the radius at most."""
    dh, do = np.bitwise_count(home ^ vantage).astype(np.int16), np.bitwise_count(others ^ vantage).astype(np.int16)
    oh, oo = np.argsort(dh, kind="stable"), np.argsort(do, kind="stable")
    dh, do, home, others = dh[oh], do[oo], home[oh], others[oo]
    for d in np.unique(dh):
        a, b = np.searchsorted(dh, [d, d + 1])
        lo, hi = np.searchsorted(do, [d - radius, d + radius + 1])
        step = max(1, PAIRS_AT_ONCE // max(1, hi - lo))
        for at in range(a, b, step):
            near = np.bitwise_count(home[at:min(b, at + step), None] ^ others[None, lo:hi]) <= radius
            x, y = np.nonzero(near)
            yield oh[at + x], oo[lo + y]


def _shard_links(radius: int):
    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        prints = unsigned(pdf["fp"].to_numpy())
        here = pdf["home"].to_numpy()
        order = np.argsort(~here, kind="stable")
        prints, n = prints[order], int(here.sum())
        parent = np.arange(len(prints))
        if n:
            for a, b in close_pairs(prints[:n], prints, radius, prints[0]):
                apart = a < b  # the home half once, queries after it
                unite(parent, a[apart], b[apart])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        linked = np.flatnonzero(parent != np.arange(len(parent)))
        return pd.DataFrame({"u": signed(prints[linked]), "v": signed(prints[parent[linked]])})
    return links


def fingerprint_links(prints: DataFrame, radius: int = 2, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(u, v): a spanning forest of every group of fingerprints linked within the radius, over distinct ones in column ``fp``.

    The tree's sample is bounded (SAMPLE_PER_SHARD * MAX_SHARDS keys at most). A shard that still holds over
    ``shard_rows`` homes (very dense data, or more than MAX_SHARDS * shard_rows rows) is cut into blocks: queries visit all its blocks, homes
    of one block also query the later ones, so no pair is lost and no task grows.
    """
    n = prints.count()
    shards = max(1, min(MAX_SHARDS, math.ceil(2 * n / shard_rows)))
    wanted = SAMPLE_PER_SHARD * shards
    drawn = prints if shards == 1 else prints.where(F.pmod(F.xxhash64("fp", F.lit(SEED)), F.lit(max(1, n // wanted))) == 0)
    sample = unsigned(drawn.toPandas()["fp"].to_numpy()) if shards > 1 else np.empty(0, dtype=np.uint64)
    tree = VantageTree(sample, max(2, math.ceil(len(sample) / shards)))

    @F.pandas_udf("int")
    def home_of(fp: pd.Series) -> pd.Series:
        return pd.Series(tree.homes(unsigned(fp.to_numpy())))

    blocks = np.ones(tree.shards, dtype=np.int64)
    if tree.shards > 1 or n > shard_rows:
        for shard, rows in prints.groupBy(home_of("fp").alias("shard")).count().collect():  # one row per shard
            blocks[shard] = -(-rows // shard_rows)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = unsigned(batch.column(0).to_numpy(zero_copy_only=False))
            for shard, home, query in tree.route(fp, radius):
                b = int(blocks[shard])
                own = (mix(fp[home]) % np.uint64(b)).astype(np.int64)
                visits = [(home, own, True)]
                for k in range(b):
                    visits.append((query, np.full(len(query), k), False))
                    visits.append((home[own < k], np.full(int((own < k).sum()), k), False))
                rows = np.concatenate([v[0] for v in visits])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(rows), shard, dtype=np.int32)), pa.array(np.concatenate([v[1] for v in visits]).astype(np.int32)),
                    pa.array(signed(fp[rows])), pa.array(np.concatenate([np.full(len(v[0]), v[2]) for v in visits]))],
                    names=["shard", "block", "fp", "home"])

    routed = prints.select("fp").mapInArrow(route, "shard int, block int, fp long, home boolean")
    return routed.groupBy("shard", "block").applyInPandas(_shard_links(radius), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle_words: int = 3, radius: int = 2,
                    shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per document: the id column, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id
    reachable over fingerprints that differ in ``radius`` bits or fewer.

    Null and empty texts have fingerprint zero and are linked like others. A null id never is the smallest;
    a group without any id gets null. Repeated rows stay, with the same component. Extra columns are not carried.
    """
    marked = staged(with_fingerprint(docs.select(docs[id_col].alias("id"), docs[text].alias("text")), "text", shingle_words, "fp").select("id", "fp"), "fingerprints")
    distinct = staged(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    linked = components(fingerprint_links(distinct, radius, shard_rows))
    roots = linked.join(distinct, linked["id"] == distinct["fp"]).select("fp", "root", "least")
    least = roots.groupBy("root").agg(F.min("least").alias("lowest"))
    labels = staged(roots.select("fp", "root").join(least, "root").select("fp", "lowest"), "components")
    labels = staged(distinct.join(labels, "fp", "left").select(F.col("fp").alias("print"), F.when(F.col("lowest").isNull(), F.col("least")).otherwise(F.col("lowest")).alias("component")), "labels")
    return marked.join(labels, F.col("fp") == F.col("print")).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
