"""Substring de-duplication with compressed FM-indexes, one per shard.

A repeated run of WINDOW words shares every word group inside it, so each window is represented by its anchor, the group of
ANCHOR words with the smallest hash in it. Anchors that only one text has cannot lie in a repeated window. The windows of
the other anchors are cut out as segments and sharded by anchor: equal windows meet in one shard. There a wavelet-matrix FM-index
of the segments is searched backward with the segments streamed from right to left; a match is held at WINDOW words, so each window
costs one step, and its interval tells the smallest document that has it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_words, mix, signed, staged

WINDOW = 50
ANCHOR = 8
SHARD_WORDS = 1_000_000
HOT_SEGMENTS = 5_000
LAST = 2**63 - 1  # documents without an id come after all others

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def window_anchors(tokens: list[bytes], window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, windows) for runs of consecutive windows with the same anchor."""
    n = len(tokens)
    if n < window:
        return (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
    marks = np.fromiter(map(_hash, tokens), dtype=np.uint64, count=n)
    groups = np.zeros(n - anchor + 1, dtype=np.uint64)
    for j in range(anchor):
        groups = groups * np.uint64(0x9E3779B97F4A7C15) + marks[j:n - anchor + 1 + j]
    groups = mix(groups)
    low, at, span, wanted = groups, np.arange(len(groups)), 1, window - anchor + 1
    while span < wanted:
        step = min(span, wanted - span)
        left, right = low[:-step], low[step:]
        at = np.where(left <= right, at[:-step], at[step:])
        low = np.minimum(left, right)
        span += step
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return low[first], first, np.diff(np.r_[first, len(at)])


class FmIndex:
    """Backward search for words over a text of segments, for patterns of up to ``depth`` words.

    Suffixes are sorted by their first ``depth`` words (prefix doubling), which is all that such patterns need. The transformed
    text is kept as a wavelet matrix: per bit of the word codes a packed bit vector with running counts.
    """

    def __init__(self, codes: np.ndarray, owners: np.ndarray, depth: int = WINDOW) -> None:
        """``codes``: word codes from 1, with 0 after every segment. ``owners``: per position, the document it is from."""
        n = len(codes)
        rank, span = codes.astype(np.int64), 1
        while 2 * span <= depth:
            rank = np.unique(self._pair(rank, span), return_inverse=True)[1].astype(np.int64) + 1
            span *= 2
        whole, shorter = self._pair(rank, depth - span), self._pair(rank, depth - 1 - span)
        order = np.argsort(whole, kind="stable")
        new = np.r_[True, whole[order][1:] != whole[order][:-1]]
        starts = np.flatnonzero(new)
        self.lowest = np.minimum.reduceat(owners[order], starts)[np.cumsum(new) - 1]  # by row: smallest owner of its first `depth` words
        new = np.r_[True, shorter[order][1:] != shorter[order][:-1]]
        starts = np.flatnonzero(new)
        place = np.cumsum(new) - 1
        self.parent_low, self.parent_high = starts[place], np.r_[starts[1:], n][place]  # rows that share all but the last of those words
        bwt = codes[order - 1]
        self.size, self.depth = n, depth
        self.before = np.r_[0, np.cumsum(np.bincount(codes))][:-1]
        self.levels, current = [], bwt
        for bit in reversed(range(max(1, int(codes.max()).bit_length()))):
            ones = (current >> bit & 1).astype(bool)
            packed = np.packbits(np.r_[ones, np.zeros(-n % 64 + 64, dtype=bool)], bitorder="little").view("<u8")
            counts = np.r_[0, np.cumsum(np.bitwise_count(packed), dtype=np.int64)][:-1]
            zeros = n - int(ones.sum())
            self.levels.append((bit, packed, counts, zeros))
            current = np.concatenate([current[~ones], current[ones]])
        self.base = self._walk(np.arange(len(self.before)), np.zeros(len(self.before), dtype=np.int64))

    @staticmethod
    def _pair(rank: np.ndarray, shift: int) -> np.ndarray:
        right = np.zeros_like(rank)
        right[:len(rank) - shift] = rank[shift:]
        return rank * (int(rank.max()) + 1) + right

    def _walk(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, packed, counts, zeros in self.levels:
            block = at >> 6
            ones = counts[block] + np.bitwise_count(packed[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where(code >> bit & 1, zeros + ones, at - ones)
        return at

    def extend(self, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the patterns with one more word on the left."""
        shift = self.before[code] - self.base[code]
        return shift + self._walk(code, low), shift + self._walk(code, high)

    def smallest_owners(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(segment, window start in it, smallest document with that window), streaming all segments from their right ends. They are part of
        the index, so no step comes out empty."""
        live = np.arange(len(starts))
        low, high = np.zeros(len(starts), dtype=np.int64), np.full(len(starts), self.size, dtype=np.int64)
        for step in range(1, int(lengths.max()) + 1):
            at = lengths[live] - step
            live, low, high, at = live[at >= 0], low[at >= 0], high[at >= 0], at[at >= 0]
            if step > self.depth:
                low, high = self.parent_low[low], self.parent_high[low]
            low, high = self.extend(codes[starts[live] + at], low, high)
            if step >= self.depth:
                yield live, at, self.lowest[low]


def _shard(window: int):
    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        segments = [s.split(b" ") for s in pdf["segment"]]
        lengths = np.array([len(s) for s in segments], dtype=np.int64)
        known: dict[bytes, int] = {}
        codes = np.zeros(int(lengths.sum()) + len(segments), dtype=np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1
        for s, at in zip(segments, starts):
            codes[at:at + len(s)] = [known.setdefault(w, len(known) + 1) for w in s]
        owners = pdf["low"].to_numpy()
        index = FmIndex(codes, np.repeat(owners, lengths + 1), window)
        found: dict[int, list[int]] = {}
        for seg, at, lowest in index.smallest_owners(codes, starts, lengths):
            for i in np.flatnonzero(lowest < owners[seg]):
                found.setdefault(int(seg[i]), []).append(int(at[i]))
        rows = list(found)
        return pd.DataFrame({"a": pdf["anchor"].to_numpy()[rows], "s1": pdf["s1"].to_numpy()[rows], "s2": pdf["s2"].to_numpy()[rows],
                             "windows": [sorted(found[r]) for r in rows]})
    return search


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("text"), text).alias("k2")]


def _two(raw: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(raw)
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _anchor_rows(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                batch = whole.slice(at, 1_000)
                parts = [window_anchors(byte_words(t), window, anchor) for t in batch.column(2).to_pylist()]
                rows = pa.array(np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(signed(np.concatenate([p[0] for p in parts]))), batch.column(0).take(rows), batch.column(1).take(rows),
                    pa.array(np.concatenate([p[1] for p in parts]).astype(np.int32)), pa.array(np.concatenate([p[2] for p in parts]).astype(np.int32))],
                    names=["anchor", "k1", "k2", "first", "n"])
    return texts.mapInArrow(run, "anchor long, k1 long, k2 long, first int, n int")


def _finish(words: list[bytes], windows: list[int] | None, window: int) -> tuple[int, int, str]:
    n = len(words)
    if windows is None or not len(windows):
        return n, 0, hashlib.sha256(b" ".join(words)).hexdigest()
    change = np.zeros(n + 1, dtype=np.int64)
    at = np.unique(np.asarray(windows))
    change[at] += 1
    np.add.at(change, at + window, -1)
    kept = np.cumsum(change[:-1]) == 0
    left = [w for w, k in zip(words, kept.tolist()) if k]
    return n, n - len(left), hashlib.sha256(b" ".join(left)).hexdigest()


OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR,
                   shard_words: int = SHARD_WORDS, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """One row per document: the id column (long), ``n_words``, ``n_removed``, ``kept_sha256``.

    A word goes if a window of ``window`` words over it also starts in a document with a smaller id; windows are judged on the
    input. A null text has no words. Null ids count as larger than all others; of rows with one id none is smaller. Repeated rows are kept,
    each with its result. Extra columns are not carried.

    An anchor with over ``hot_segments`` different segments (a passage in very many surroundings) is not searched in one shard: its
    windows are looked up one by one, by their hash, which spreads them over all tasks.
    """
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    base = base.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("place"), "text", *_text_key(F.col("text")))
    runs = staged(_anchor_rows(base.select("k1", "k2", "text"), window, anchor), "anchors")
    # written first, so that the join may split the rows of a hot anchor among tasks
    shared = staged(runs.groupBy("anchor").agg(F.min("k1").alias("a"), F.max("k1").alias("b"), F.min("k2").alias("c"), F.max("k2").alias("d"))
                    .where("a <> b or c <> d").select(F.col("anchor").alias("shared")), "shared-anchors")
    suspects = (runs.join(shared, F.col("anchor") == F.col("shared")).select("k1", "k2", "anchor", "first", "n").distinct()
                .groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "first", "n")).alias("runs")))
    keyed = staged(base.groupBy("k1", "k2").agg(F.min("place").alias("owner")).join(suspects, ["k1", "k2"], "left"), "texts")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                batch = whole.slice(at, 1_000)
                ids, places, texts, owners, some = (batch.column(i) for i in range(5))
                done = []
                for place, t, owner, has in zip(places.to_pylist(), texts.to_pylist(), owners.to_pylist(), some.to_pylist()):
                    words = byte_words(t)
                    if place > owner:  # another row has the whole text
                        done.append((*_finish(words, range(max(0, len(words) - window + 1)), window), None))
                    elif has:
                        done.append((len(words), None, None, t))
                    else:
                        done.append((*_finish(words, None, window), None))
                n, gone, sha, pending = zip(*done)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()),
                                                  pa.array(pending, pa.string()), batch.column(5), batch.column(6)],
                                                 names=["doc_id", "n_words", "n_removed", "kept_sha256", "text", "k1", "k2"])

    known = keyed.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), "owner", F.col("runs").isNotNull().alias("some"))
    joined = base.join(known, (F.col("k1") == F.col("o1")) & (F.col("k2") == F.col("o2"))).select("doc_id", "place", "text", "owner", "some", "k1", "k2")
    state = staged(joined.mapInArrow(settle, OUT + ", text string, k1 long, k2 long"), "state")
    pending = state.where("text is not null")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                rows = []
                for k1, k2, t, owner, found in zip(*(c.to_pylist() for c in whole.slice(at, 200).columns)):
                    words = byte_words(t)
                    for r in found:
                        segment = b" ".join(words[r["first"]:r["first"] + r["n"] + window - 1])
                        rows.append((k1, k2, owner, r["first"], r["n"], r["anchor"], *_two(segment), segment))
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     names=["k1", "k2", "owner", "first", "n", "anchor", "s1", "s2", "segment"])

    texts = pending.select("k1", "k2", "text").join(keyed.select("k1", "k2", "owner", "runs").where("runs is not null"), ["k1", "k2"])
    places = staged(texts.mapInArrow(cut, "k1 long, k2 long, owner long, first int, n int, anchor long, s1 long, s2 long, segment binary"), "segments")
    segments = staged(places.groupBy("anchor", "s1", "s2", "segment").agg(F.min("owner").alias("low")), "distinct-segments")

    sizes = staged(segments.groupBy(F.col("anchor").alias("__a")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1"), "segments-by-anchor")
    met = staged(segments.join(sizes, F.col("anchor") == F.col("__a")).select("anchor", "s1", "s2", "segment", "low", "__n"), "met-segments")
    total = met.agg(F.sum(F.octet_length("segment"))).first()[0] or 0
    shards = max(1, -(-int(total) // (6 * shard_words)))
    hits = (met.where(F.col("__n") <= hot_segments).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int"))
            .groupBy("shard").applyInPandas(_shard(window), "a long, s1 long, s2 long, windows array<int>"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            rows = []
            for a, s1, s2, segment, low in zip(*(c.to_pylist() for c in whole.columns)):
                words = segment.split(b" ")
                rows += [(a, s1, s2, low, i, *_two(b" ".join(words[i:i + window]))) for i in range(len(words) - window + 1)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["a", "s1", "s2", "low", "i", "w1", "w2"])

    single = met.where(F.col("__n") > hot_segments).select("anchor", "s1", "s2", "segment", "low").mapInArrow(
        spread, "a long, s1 long, s2 long, low long, i int, w1 long, w2 long")
    least = single.groupBy(F.col("w1").alias("v1"), F.col("w2").alias("v2")).agg(F.min("low").alias("least"))
    hot = (single.join(least, (F.col("w1") == F.col("v1")) & (F.col("w2") == F.col("v2"))).where("least < low")
           .groupBy("a", "s1", "s2").agg(F.collect_list("i").alias("windows")))

    found = staged(hits.unionByName(hot), "repeated-windows")
    lows = segments.select(F.col("anchor").alias("b"), F.col("s1").alias("t1"), F.col("s2").alias("t2"), "low")
    lows = lows.join(found, (F.col("b") == F.col("a")) & (F.col("t1") == F.col("s1")) & (F.col("t2") == F.col("s2")), "left").select("b", "t1", "t2", "low", "windows")
    own = F.when(F.col("low") < F.col("owner"), F.sequence(F.lit(0), F.col("n") - 1)).otherwise(F.col("windows"))
    removed = (places.select("k1", "k2", "owner", "first", "n", "anchor", "s1", "s2")
               .join(staged(lows, "segment-results"), (F.col("b") == F.col("anchor")) & (F.col("t1") == F.col("s1")) & (F.col("t2") == F.col("s2")))
               .select("k1", "k2", F.transform(own, lambda i: i + F.col("first")).alias("w")).where("w is not null")
               .groupBy(F.col("k1").alias("o1"), F.col("k2").alias("o2")).agg(F.flatten(F.collect_list("w")).alias("windows")))

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                done = [_finish(byte_words(t), w, window) for t, w in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
                n, gone, sha = zip(*done)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha)],
                                                 names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    resolved = (pending.join(removed, (F.col("k1") == F.col("o1")) & (F.col("k2") == F.col("o2")), "left")
                .select("doc_id", "text", "windows").mapInArrow(resolve, OUT))
    out = state.where("text is null").select("doc_id", "n_words", "n_removed", "kept_sha256").unionByName(resolved)
    return out.withColumnRenamed("doc_id", id_col)
