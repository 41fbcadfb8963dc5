"""Best-fit packing by minimum bin slack: per bin the fullest feasible combination of lengths.

Only lengths matter to the search, so it runs on their histogram: at most ``capacity`` counts, whatever the
input. A combination is found by bitset subset-sum dynamic programming and taken as often as the counts
allow. Rows then receive their places by their rank within their length.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.runtime import col
from .common import give_back, staged

CAPACITY = 1024
END_ID = 2
KNOWN_WORDS = 500_000  # words a worker remembers; the older half goes when there are more
NEW_WORDS = 200_000  # words that are encoded together
KNOWN_RESTS = 20_000  # what follows the letters of new words
TEXTS_AT_ONCE, BYTES_AT_ONCE = 2_000, 1 << 23

SPACE_MARK = "\u0120"  # what a byte-level vocabulary writes for a space
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"  # all of these are letters to the splitting rule, and no ASCII character else
WORD = f"(?s)^(?P<letters>[{LETTERS}]+)(?P<rest>(?:[\\x00-@\\[-`{{-\\x7f].*)?)$"
BYTE_UNITS = np.arange(256, dtype="<u4")  # what it writes for the bytes of letters and of a space; the others in this table are not asked for
BYTE_UNITS[[*range(32, 33), *range(127, 161), 173]] = 256 + np.array([32, *range(33, 67), 67])
SPACE_PAIR, INNER_SPACE = re.compile(r" \s"), re.compile(r"\s \s|\s \Z|\A \s|\A \Z")


def needs_whole(text: str) -> bool:
    """Whether a space stands inside a longer run of white space, where no cut is certain."""
    return (SPACE_PAIR.search(text) is not None or text[-1:] == " ") and INNER_SPACE.search(text) is not None


class Ids:
    """The ids of some words in one array; word i has those from ``starts[i]`` to ``starts[i + 1]``."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray) -> None:
        self.ids, self.starts = ids, starts

    @classmethod
    def of(cls, parts: list[bytes]) -> Ids:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts))) // 4
        return cls(np.frombuffer(b"".join(parts), dtype="<u4"), np.append(0, ends))

    def take(self, place: np.ndarray) -> np.ndarray:
        """The ids of the words at these places, one word after the other."""
        begin = self.starts[place]
        n = self.starts[place + 1] - begin
        before = np.cumsum(n) - n
        return self.ids[np.repeat(begin - before, n) + np.arange(n.sum())]

    def followed_by(self, other: Ids) -> Ids:
        return Ids(np.concatenate([self.ids, other.ids]), np.concatenate([self.starts, other.starts[1:] + self.starts[-1]]))


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    The byte-level vocabulary's splitting rule always cuts before a single space that follows a
    non-space, so a text is encoded word by word (each with its leading space) and ids of words are
    remembered, words and ids each in one flat array. Of a new word that starts with letters of LETTERS, the letters are encoded apart: the
    rule also cuts between a letter and what is none.
    Texts where a space stands inside a longer run of white space are encoded as a whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, models, pre_tokenizers
        assert array("I").itemsize == 4
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        split = self.tokenizer.pre_tokenizer
        self.cuts_letters = (self.tokenizer.normalizer is None and isinstance(self.model, models.BPE) and isinstance(split, pre_tokenizers.ByteLevel)
                             and split.use_regex and not split.add_prefix_space)
        self.forget()

    def forget(self) -> None:
        self.known, self.ids, self.rests = pa.array([], pa.string()), Ids.of([]), {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, runs: list[str]) -> list[bytes]:
        """Ids of a space and a run of letters, which are one piece to the splitting rule."""
        if not runs:
            return []
        units = BYTE_UNITS[np.frombuffer((" " + "\n ".join(runs)).encode(), np.uint8)].tobytes().decode("utf-32-le")
        return [array("I", [t.id for t in self.model.tokenize(u)]).tobytes() for u in units.split("\n")]

    def _rests(self, rests: list[str]) -> list[bytes]:
        if len(self.rests) > KNOWN_RESTS:
            self.rests = {}
        new = [r for r in rests if r not in self.rests]
        self.rests.update(zip(new, self._whole(new)))
        return [self.rests[r] for r in rests]

    def _words(self, words: pa.Array) -> Ids:
        """Ids of every word behind a space."""
        if not self.cuts_letters:
            return Ids.of(self._whole([" " + w for w in words.to_pylist()]))
        parts = pc.extract_regex(words, WORD)
        other = parts.is_null()
        heads, rests = (pc.fill_null(part, "").dictionary_encode() for part in parts.flatten())
        place = np.stack([heads.indices.to_numpy().astype(np.int64), rests.indices.to_numpy() + np.int64(len(heads.dictionary))], axis=1)
        odd = np.flatnonzero(other.to_numpy(zero_copy_only=False))
        letters, after = heads.dictionary.to_pylist(), rests.dictionary.to_pylist()
        none = letters.index("") if len(odd) else len(letters)  # the empty run stands for the other words
        ids = Ids.of(self._letters(letters[:none]) + [b""] * (none < len(letters)) + self._letters(letters[none + 1:]) + self._rests(after)
                     + self._whole([" " + w for w in words.take(pa.array(odd)).to_pylist()]))
        place[odd, 1] = len(letters) + len(after) + np.arange(len(odd))
        sizes = np.diff(ids.starts)[place].sum(axis=1)
        return Ids(ids.take(place.ravel()), np.append(0, np.cumsum(sizes)))

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where the different ``words`` stand among the remembered ones; new ones are added."""
        at = pc.index_in(words, value_set=self.known)
        if len(self.known) + at.null_count > KNOWN_WORDS and len(self.known):  # the older half goes, and what this batch needs of it is encoded again
            first = min(len(self.known), max(len(self.known) // 2, len(self.known) + at.null_count - KNOWN_WORDS))
            self.known = pa.concat_arrays([self.known.slice(first)])
            self.ids = Ids(self.ids.ids[self.ids.starts[first]:].copy(), self.ids.starts[first:] - self.ids.starts[first])
            at = pc.index_in(words, value_set=self.known)
        out = at.fill_null(-1).to_numpy().astype(np.int64)
        if at.null_count:
            fresh = words.filter(at.is_null())
            out[out < 0] = len(self.known) + np.arange(len(fresh))
            for i in range(0, len(fresh), NEW_WORDS):
                self.ids = self.ids.followed_by(self._words(fresh.slice(i, NEW_WORDS)))
            self.known = pa.concat_arrays([self.known, fresh])
        return out

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.string()).fill_null("")
        strings = texts.to_pylist()
        whole = np.array([needs_whole(t) for t in strings], dtype=bool)
        split = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        firsts, flat = split.offsets.to_numpy()[:-1], split.flatten()
        is_tail = np.ones(len(flat), dtype=bool)
        is_tail[firsts] = False
        tails = flat.filter(pa.array(is_tail)).dictionary_encode()
        place = self._places(tails.dictionary)[tails.indices.to_numpy()]
        heads = self._whole([t if w else t.partition(" ")[0] for t, w in zip(strings, whole.tolist())])
        ends = np.append(firsts[1:], len(flat)) - np.arange(1, len(strings) + 1)
        return [head + self.ids.take(place[a:b]).tobytes() for head, a, b in zip(heads, [0, *ends.tolist()], ends.tolist())]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most TEXTS_AT_ONCE texts and BYTES_AT_ONCE bytes of text, or one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        most = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BYTES_AT_ONCE, "right"))
        until = min(max(most, at + 1), at + TEXTS_AT_ONCE)
        yield batch.slice(at, until - at)
        at = until


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document: only the first may be shorter than the capacity."""
    first = n if n <= capacity else n % capacity or capacity
    at = 0
    while at < n:
        length = first if at == 0 else capacity
        yield at, length
        at += length


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
           remember: bool = True) -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, rank): the pieces of every document, written once. ``rank`` counts the pieces of one length
    within their part. ``remember``: as in ``pack``."""
    end = np.array([end_id], dtype="<u4").tobytes()
    base = docs.select(docs[id_col].alias("__id"), docs[text].alias("__text"), F.spark_partition_id().alias("__part"))
    schema = f"__id {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, part int, rank long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for whole in batches:
            for batch in parts_of(whole):
                rows, out = [], []
                for i, ids in enumerate(encoder(tokenizer).encode(batch.column(1))):
                    ids += end
                    for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        rows.append(i)
                        out.append((k, start, length, zlib.crc32(memoryview(ids)[4 * start:4 * (start + length)]), int(seen[length])))
                        seen[length] += 1
                k, start, length, crc, rank = zip(*out)
                rows = pa.array(rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(rows), pa.array(k, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()), batch.column(2).take(rows), pa.array(rank, pa.int64())],
                    names=["__id", "piece", "start", "length", "ids_crc32", "part", "rank"])
        if not remember:
            encoder(tokenizer).forget()
        whole = batch = None
        give_back()

    return staged(base.mapInArrow(run, schema), "pieces")


def fullest(counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """(length, times) of the available lengths with the largest sum not above ``room``.

    ``reach`` holds one bit per sum; a length with c copies is added in powers of two. The choice is
    read back from the last step, which prefers long pieces.
    """
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in np.flatnonzero(counts[:room + 1]).tolist():
        left, k = min(int(counts[length]), room // length), 1
        while left > 0:
            take = min(k, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, k = left - take, 2 * k
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return sorted(chosen.items(), reverse=True)


def minimum_slack(counts: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(bins, [(length, pieces per bin)]): the longest piece left opens a bin, the fullest combination of the others
    completes it, and the bin is repeated while its lengths last."""
    counts, runs = counts.copy(), []
    for top in range(capacity, 0, -1):
        while counts[top]:
            counts[top] -= 1
            rest = fullest(counts, capacity - top)
            counts[top] += 1
            bin_ = dict(rest)
            bin_[top] = bin_.get(top, 0) + 1
            times = min(int(counts[n]) // k for n, k in bin_.items())
            for n, k in bin_.items():
                counts[n] -= times * k
            runs.append((times, sorted(bin_.items(), reverse=True)))
    return runs


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
         remember: bool = True) -> DataFrame:
    """One row per piece: the id column, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A document is its token ids and the end id; a null or empty text is the end id alone. Documents longer than the capacity are cut, the first
    piece may be shorter. Repeated rows and null ids are documents like others. The histogram of the lengths (at most ``capacity`` counts) is
    all that reaches the driver, and the table of bins that comes back is bounded by the capacity as well (below capacity * ln capacity runs).

    A worker remembers the words it has encoded. ``remember=False`` forgets them at the end of each partition, for jobs whose workers go on
    to other work: less memory, more time, the same result.
    """
    rows = pieces(docs, tokenizer, id_col, text, capacity, end_id, remember)
    sizes = rows.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in histogram:
        counts[r["length"]] = r["n"]
    taken, table, first = np.zeros(capacity + 1, dtype=np.int64), [], 0
    for bins, content in minimum_slack(counts, capacity):
        at = 0
        for length, k in content:
            table.append((length, int(taken[length]), int(taken[length]) + bins * k, k, first, at))
            taken[length] += bins * k
            at += length * k
        first += bins
    table.sort()
    lengths = np.array([t[0] for t in table], dtype=np.int64)
    low = np.array([t[1] for t in table], dtype=np.int64)
    k_of, first_of, at_of = (np.array([t[i] for t in table], dtype=np.int64) for i in (3, 4, 5))
    start_of = np.searchsorted(lengths, np.arange(capacity + 2))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(), rank.to_numpy()
        i = np.empty(len(n), dtype=np.int64)
        for value in np.unique(n):
            mine = n == value
            a, b = start_of[value], start_of[value + 1]
            i[mine] = a + np.searchsorted(low[a:b], r[mine], "right") - 1
        within = r - low[i]
        return pd.DataFrame({"sequence_id": first_of[i] + within // k_of[i], "offset": at_of[i] + (within % k_of[i]) * n})

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    offsets = sizes.select(F.col("part").alias("__part"), F.col("length").alias("__length"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    ranked = rows.join(offsets, (rows["part"] == offsets["__part"]) & (rows["length"] == offsets["__length"])).withColumn("__rank", F.col("rank") + F.col("__before"))
    return ranked.withColumn("__place", place("length", "__rank")).select(
        F.col("__id").alias(id_col), "piece", "start", "length", "ids_crc32", F.col("__place.sequence_id"), F.col("__place.offset"))
