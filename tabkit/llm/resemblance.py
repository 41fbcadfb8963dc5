"""One document of each near-duplicate group, by SimHash candidates and exact resemblance.

Near-duplicates share at least 80 % of their distinct 5-word shingles (Jaccard). Fingerprints of such texts still differ in up to 16 of 64 bits,
a radius at which no triangle bound prunes anything, so candidates come from two sides: fingerprints linked in the vantage-point tree within
a small radius, and sampled views, each a fingerprint of the two smallest shingle hashes under its own permutation. Two texts
of resemblance 0.8 agree in a given view with probability 0.64, and miss all of VIEWS with (1 - 0.64) ** 6 = 0.2 %. Every candidate is verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.neighbors import components
from .common import byte_words, give_back, mix, packed, signed, staged, unpacked
from .simhash import fingerprint_links, shingle_hashes, simhash

SHINGLE_WORDS = 5
MIN_PERCENT = 80
VIEWS = 6
RADIUS = 2
BLOCK = 1_000  # rows of a bucket that meet in one task
ROWS_PER_TASK = 2_000
PAIRS_AT_ONCE = 1 << 20  # postings read at a time
FILTER_BITS = 2**23


def views_of(hashes: np.ndarray, views: int = VIEWS) -> list[int]:
    """Per view one fingerprint of the two smallest of the permuted distinct hashes."""
    out = []
    for j in range(views):
        m = mix(hashes ^ np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        low = np.sort(np.partition(m, 1)[:2]) if len(m) > 1 else m
        out.append(int(mix(np.array([(int(low[0]) * 31 + int(low[-1])) & (2**64 - 1)], dtype=np.uint64))[0]))
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1_000):
            batch = whole.slice(at, 1_000)
            rows = []
            for text in batch.column(2).to_pylist():
                words = byte_words(text, lower=True)
                h = shingle_hashes(words, SHINGLE_WORDS)
                d = xxhash.xxh3_128_digest(b" ".join(words))
                u = np.unique(h)
                v = views_of(u) if len(u) else [0] * VIEWS
                rows.append((int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True),
                             *signed(np.array([simhash(h), *v], dtype=np.uint64)).tolist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in zip(*rows)]],
                                             names=["row", "place", "c1", "c2", "fp", *[f"v{j}" for j in range(VIEWS)]])
    whole = batch = None
    give_back()


def _ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 200):
            rows = []
            for row, text, buckets in zip(*(c.to_pylist() for c in whole.slice(at, 200).columns)):
                raw = np.unique(shingle_hashes(byte_words(text, lower=True), SHINGLE_WORDS)).tobytes()
                for b in buckets:
                    n, own = b["blocks"], row % b["blocks"]
                    rows += [(b["kind"], b["key"], min(own, x) * n + max(own, x), row, own, raw) for x in range(n)]
            if rows:
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["kind", "key", "pair", "row", "block", "hashes"])
    whole = rows = None
    give_back()


def similar_pairs(sets: list[np.ndarray], percent: int = MIN_PERCENT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) with i < j whose distinct hashes resemble each other, by counting along an inverted index."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(place, kind="stable")
    posting, start = owner[order], np.searchsorted(place[order], np.arange(len(values) + 1))
    at = np.cumsum(sizes) - sizes
    for i in range(len(sets)):
        mine = place[at[i]:at[i] + sizes[i]]
        low, n = start[mine], start[mine + 1] - start[mine]
        shared = np.zeros(len(sets), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(n) // PAIRS_AT_ONCE)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(mine)]):
            lo, k = low[a:b], n[a:b]
            where = np.arange(int(k.sum())) + np.repeat(lo - (np.cumsum(k) - k), k)
            shared += np.bincount(posting[where], minlength=len(sets))
        close = np.flatnonzero(100 * shared >= percent * (sizes + sizes[i] - shared))
        close = close[close > i]
        yield np.full(len(close), i), close


def connect(sets: list[np.ndarray], percent: int = MIN_PERCENT) -> np.ndarray:
    """Parents in a forest of the sets whose distinct hashes resemble each other: its trees are the connected components of all pairs.

    Each set is compared with those that are not yet in its component, so near copies are passed over once they are linked. Of two ways to count
    what it shares with them, along its posting lists or through all their hashes, the shorter one is taken; memory is that of the hashes.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    parent = np.arange(len(sets))
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(place, kind="stable")
    posting, start = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)[order], np.searchsorted(place[order], np.arange(len(values) + 1))
    end = np.cumsum(sizes)
    mark = np.zeros(len(values), dtype=bool)
    for i in range(len(sets)):
        other = np.flatnonzero(parent != parent[i])
        other = other[(other > i) & (100 * np.minimum(sizes[other], sizes[i]) >= percent * np.maximum(sizes[other], sizes[i]))]
        if not len(other):
            continue
        mine = place[end[i] - sizes[i]:end[i]]
        low, n = start[mine], start[mine + 1] - start[mine]
        if n.sum() <= sizes[other].sum():
            shared = np.zeros(len(sets), dtype=np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(n) // PAIRS_AT_ONCE)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(mine)]):
                lo, k = low[a:b], n[a:b]
                where = np.arange(int(k.sum())) + np.repeat(lo - (np.cumsum(k) - k), k)
                shared += np.bincount(posting[where], minlength=len(sets))
            shared = shared[other]
        else:
            mark[mine] = True
            shared = np.array([np.count_nonzero(mark[place[end[j] - sizes[j]:end[j]]]) for j in other])
            mark[mine] = False
        close = other[100 * shared >= percent * (sizes[other] + sizes[i] - shared)]
        if len(close):
            groups = np.append(parent[close], parent[i])
            parent[np.isin(parent, groups)] = groups.min()
    return parent


def _verify(pdf: pd.DataFrame) -> pd.DataFrame:
    u, v = [], []
    for _, g in pdf.groupby(["kind", "key", "pair"], sort=False):
        rows = g["row"].to_numpy()
        parent = connect([np.frombuffer(h, dtype=np.uint64) for h in g["hashes"]])
        linked = np.flatnonzero(parent != np.arange(len(parent)))
        u.append(rows[linked])
        v.append(rows[parent[linked]])
    give_back()
    return pd.DataFrame({"u": np.concatenate(u), "v": np.concatenate(v)})


def _maybe_in(rows: DataFrame, name: str) -> Column:
    """A bit filter of fixed size over the row numbers: what it turns away is surely not among ``rows``, so that only the other texts are
    shuffled by the exact join behind it. A full filter lets everything pass."""
    def slot(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)).cast("int")
    taken = rows.select(slot(name).alias("slot")).distinct().toPandas()["slot"].to_numpy()  # at most FILTER_BITS numbers
    flags = np.zeros(FILTER_BITS, dtype=bool)
    flags[taken] = True
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(flags, bitorder="little"))

    @F.pandas_udf("boolean")
    def maybe(slots: pd.Series) -> pd.Series:
        at = slots.to_numpy()
        return pd.Series((shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))
    return maybe(slot("row"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, less those that a group has beyond its first: the smallest id stays, of whatever type that has an
    order (null ids last).

    Groups are the connected components of resemblance. Texts with the same words, empty and null ones among themselves, are copies: of
    repeated rows one stays. Texts under five words are one shingle. Rows are numbered once and written with their columns:
    numbers made anew in each scan would follow how the files are split, which follows the number of live cores.
    """
    placed = staged(docs.select(packed(docs, docs.columns), F.monotonically_increasing_id().alias("row")), "placed")
    narrow = placed.select("row", F.col("rest")[id_col].alias("place"), F.col("rest")[text].alias("text"))
    longs = ", ".join(f"{c} long" for c in ["c1", "c2", "fp", *[f"v{j}" for j in range(VIEWS)]])
    marked = staged(narrow.mapInArrow(_features, f"row long, place {docs.schema[id_col].dataType.simpleString()}, {longs}"), "features")
    smallest = lambda row: F.min(F.struct(F.col("place").isNull().alias("nil"), "place", row))
    same = marked.groupBy("c1", "c2").agg(smallest("row").alias("first"), *[F.min(c).alias(c) for c in ["fp", *[f"v{j}" for j in range(VIEWS)]]])
    reps = staged(same.select("c1", "c2", "first.place", "first.row", "fp", *[f"v{j}" for j in range(VIEWS)]), "distinct-words")

    roots = components(fingerprint_links(reps.select("fp").distinct(), RADIUS)).select(F.col("id").alias("fp2"), "root")
    by_print = reps.join(roots, F.col("fp") == F.col("fp2"), "left").select(F.lit(-1).alias("kind"), F.coalesce("root", "fp").alias("key"), "row")
    by_view = reps.select(F.inline(F.array(*[F.struct(F.lit(j).alias("kind"), F.col(f"v{j}").alias("key")) for j in range(VIEWS)])), "row")
    member = staged(by_print.unionByName(by_view.select("kind", "key", "row")), "buckets")
    # a bucket with the same rows as another one, as groups of near copies have in several views, is verified once
    rows_of = [F.count(F.lit(1)).alias("n"), F.min("row").alias("low"), F.max("row").alias("high"), F.bit_xor(F.xxhash64("row")).alias("x1"),
               F.bit_xor(F.xxhash64("row", F.lit(1))).alias("x2")]
    sizes = member.groupBy("kind", "key").agg(*rows_of).where("n > 1").groupBy("n", "low", "high", "x1", "x2") \
        .agg(F.min(F.struct("kind", "key")).alias("one")).select(F.col("one.kind").alias("kind2"), F.col("one.key").alias("key2"), "n")
    wanted = staged(member.join(sizes, (F.col("kind") == F.col("kind2")) & (F.col("key") == F.col("key2")))
                    .groupBy(F.col("row").alias("row2")).agg(F.collect_list(F.struct("kind", "key", F.ceil(F.col("n") / BLOCK).alias("blocks"))).alias("buckets")), "candidates")
    shipped = narrow.where(_maybe_in(wanted, "row2")).join(wanted, F.col("row") == F.col("row2")).select("row", "text", "buckets").mapInArrow(
        _ship, "kind int, key long, pair long, row long, block long, hashes binary")
    tasks = max(1, (wanted.agg(F.sum(F.expr("aggregate(buckets, 0L, (n, b) -> n + b.blocks)"))).first()[0] or 0) // ROWS_PER_TASK)
    links = shipped.groupBy(F.pmod(F.xxhash64("kind", "key", "pair"), F.lit(tasks))).applyInPandas(_verify, "u long, v long")

    groups = components(links)
    groups = staged(groups.join(reps.select(F.col("row").alias("id"), "place", "c1", "c2"), "id"), "groups")
    stays = groups.groupBy(F.col("root").alias("root2")).agg(smallest("id").alias("stay"))
    second = groups.join(stays, F.col("root") == F.col("root2")).where("id <> stay.id").select(F.col("id").alias("gone"))
    copies = marked.join(reps.select(F.col("c1").alias("d1"), F.col("c2").alias("d2"), F.col("row").alias("kept")),
                         (F.col("c1") == F.col("d1")) & (F.col("c2") == F.col("d2"))).where("row <> kept").select(F.col("row").alias("gone"))
    gone = staged(second.unionByName(copies), "removed")
    maybe = _maybe_in(gone, "gone")
    doubtful = placed.where(maybe).join(gone, F.col("row") == F.col("gone"), "left_anti")
    return placed.where(~maybe).unionByName(doubtful).select(*unpacked(docs.columns))
