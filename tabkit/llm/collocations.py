"""Phrase collocations: an FM-index per shard over word ids, phrase counts summed across shards."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.runtime import col
from .common import LOWER, UPPER, mix, staged

MAX_WORDS = 4
SHARD_WORDS = 1 << 20  # words of one index; a longer piece makes a longer index
SLICE = 1 << 20  # bytes of a text that are split at a time, cut where a piece ends
SEGMENT_KEYS = 1 << 21  # keys that one task sums, on average
MIN_SEGMENTS = 256
BREAK, OTHER, FIRST = 0, 1, 2  # ids: end of a piece, a word no longer followed, the first word

# What ends a piece, as one mark. It can stand in no word.
CUTS = b".,;:!?\x0a\x0b\x0c\x0d"
MARK = b"."
PIECES = bytes.maketrans(UPPER.encode() + CUTS, LOWER.encode() + MARK * len(CUTS))

SHARD_SCHEMA = "shard long, lang string, vocabulary binary, ids binary, n_words long"
BLOCK_SCHEMA = "segment long, shard long, keys binary, checks binary, counts binary"
LEVEL_SCHEMA = f"kind string, lang string, {BLOCK_SCHEMA}, vocabulary binary, ids binary, phrase string, words int, n long, n_left long, n_right long"


# shards ---------------------------------------------------------------------------------

class _Ids(dict):
    """Ids of words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = len(self) - 1 + FIRST
        return value


class _Shard:
    """Texts of one language until they make an index."""

    def __init__(self):
        self.words, self.parts, self.size = _Ids({MARK: BREAK}), [], 0

    def add(self, raw: bytes) -> None:
        at, raw = 0, raw.translate(PIECES)
        while at < len(raw):
            end = raw.find(MARK, at + SLICE)
            end = len(raw) if end < 0 else end
            tokens = raw[at:end].replace(MARK, b" . ").split()
            tokens.append(MARK)
            self.parts.append(np.fromiter(map(self.words.__getitem__, tokens), np.int32, len(tokens)))
            self.size += len(tokens)
            at = end + 1

    def row(self, shard: int, lang: str) -> dict:
        ids = np.concatenate(self.parts)
        ids = ids[(ids != BREAK) | np.concatenate([[True], ids[:-1] != BREAK])]  # one break is enough
        return {"shard": shard, "lang": lang, "vocabulary": MARK.join(list(self.words)[1:]), "ids": pack(ids),
                "n_words": int((ids != BREAK).sum())}


def pack(ids: np.ndarray) -> bytes:
    """Ids as bytes: the low and the high halves apart, since few words of a shard need the high ones."""
    halves = np.ascontiguousarray(ids, np.uint32).view(np.uint16).reshape(-1, 2).T.tobytes()
    return len(ids).to_bytes(8, "little") + pa.compress(halves, "zstd", asbytes=True)


def unpack(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    halves = np.frombuffer(pa.decompress(raw[8:], 4 * n, "zstd"), np.uint16).reshape(2, -1)
    return np.ascontiguousarray(halves.T).view(np.uint32).ravel().view(np.int32)


def shards(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Whole texts as rows of word ids, one language each. A shard is a stretch of one input partition."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, open_ = TaskContext.get().partitionId() << 32, {}

        def closed(name: str) -> pa.RecordBatch:
            nonlocal number
            number += 1
            return _batch([open_.pop(name).row(number, name)], SHARD_TYPES)

        for batch in batches:
            for name, raw in zip(batch.column(0), batch.column(1)):
                name = name.as_py()
                open_.setdefault(name, _Shard()).add(raw.as_py())
                if open_[name].size >= SHARD_WORDS:
                    yield closed(name)
                elif sum(s.size for s in open_.values()) >= 2 * SHARD_WORDS:
                    yield closed(max(open_, key=lambda k: open_[k].size))
        for name in [n for n, s in open_.items() if s.parts]:
            yield closed(name)

    source = docs.select(F.coalesce(col(lang).cast("string"), F.lit("und")).alias("lang"), col(text).cast("string").cast("binary").alias("raw"))
    return source.where("length(raw) > 0").mapInArrow(build, SHARD_SCHEMA)


SHARD_TYPES = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("vocabulary", pa.binary()), ("ids", pa.binary()), ("n_words", pa.int64())])
LEVEL_TYPES = pa.schema([("kind", pa.string()), ("lang", pa.string()), ("segment", pa.int64()), ("shard", pa.int64()), ("keys", pa.binary()),
                         ("checks", pa.binary()), ("counts", pa.binary()), ("vocabulary", pa.binary()), ("ids", pa.binary()), ("phrase", pa.string()),
                         ("words", pa.int32()), ("n", pa.int64()), ("n_left", pa.int64()), ("n_right", pa.int64())])


def _batch(rows: list[dict], types: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, types)


# index ----------------------------------------------------------------------------------

class _Direction:
    """Burrows-Wheeler transform of the ids read one way, suffixes ordered by their first ``depth`` ids.

    Within that depth the phrases of an index are contiguous intervals, which is all that interval extension needs.
    """

    def __init__(self, ids: np.ndarray, depth: int):
        n, size = len(ids), int(ids.max(initial=0)) + 1
        padded = np.concatenate([ids.astype(np.int64), np.zeros(4, np.int64)])
        key = padded[:n]
        if depth > 1:
            key = padded[:n + 2] * size + padded[1:n + 3]
        if depth > 2:
            ranks = np.unique(key, return_inverse=True)[1]
            key = ranks[:n] * (int(ranks.max(initial=0)) + 1) + ranks[2:n + 2]
        self.order = np.argsort(key[:n]).astype(np.int32)
        self.bwt = ids[self.order - 1]  # the id before the first one is the last one, always a break
        self.first = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=size))])

    @cached_property
    def last_to_first(self) -> np.ndarray:
        """Where the suffix that starts one id earlier stands: the ids before all suffixes, counted up to each place."""
        by_id = np.argsort(self.bwt, kind="stable")
        out = np.empty(len(by_id), np.int32)
        out[by_id] = np.arange(len(by_id), dtype=np.int32)
        return out


class Phrases:
    """Intervals of the distinct phrases of one length, in the index of the text and in the one of its reversal."""

    def __init__(self, words: np.ndarray, low: np.ndarray, back: np.ndarray, n: np.ndarray):
        self.words, self.low, self.back, self.n = words, low, back, n  # words: one row per phrase

    def where(self, keep: np.ndarray) -> "Phrases":
        return Phrases(self.words[keep], self.low[keep], self.back[keep], self.n[keep])


class PhraseIndex:
    """Bidirectional FM-index of one shard, for phrases of up to ``depth`` words and their extensions by one word."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.ids, self.size = ids, int(ids.max(initial=0)) + 1
        self.forward, self.backward = _Direction(ids, depth), _Direction(ids[::-1].copy(), depth)

    def single(self) -> Phrases:
        counts = np.bincount(self.ids, minlength=self.size)
        words = np.flatnonzero(counts)
        words = words[words >= FIRST]
        low = self.forward.first[words]
        return Phrases(words[:, None], low, low, counts[words])

    def extend(self, of: Phrases, left: bool) -> Phrases:
        """All phrases with one word more on one side. The index that is read gives the new interval by last-to-first steps,
        the other one by the number of smaller ids inside the old interval."""
        side = self.forward if left else self.backward
        low, other = (of.low, of.back) if left else (of.back, of.low)
        which, places = ranges(low, of.n)
        added = side.bwt[places].astype(np.int64)
        order = np.argsort(which * self.size + added)
        key_which, key_added, places = which[order], added[order], places[order]
        new = np.flatnonzero(np.concatenate([[True], (key_which[1:] != key_which[:-1]) | (key_added[1:] != key_added[:-1])])[:len(order)])
        n = np.diff(np.append(new, len(order)))
        first_place = np.minimum.reduceat(places, new) if len(new) else places
        which, added = key_which[new], key_added[new]
        inside = np.concatenate([[0], np.cumsum(of.n)])[:-1]
        moved, kept = side.last_to_first[first_place].astype(np.int64), other[which] + new - inside[which]
        words = np.column_stack([added[:, None], of.words[which]] if left else [of.words[which], added[:, None]])
        out = Phrases(words, moved, kept, n) if left else Phrases(words, kept, moved, n)
        return out.where(added >= FIRST)

    def at_edge(self, of: Phrases, left: bool) -> np.ndarray:
        """How many occurrences of each phrase start (or end) their piece."""
        side, low = (self.forward, of.low) if left else (self.backward, of.back)
        breaks = np.concatenate([[0], np.cumsum(side.bwt == BREAK)])
        return breaks[low + of.n] - breaks[low]

    def places(self, of: Phrases) -> np.ndarray:
        """Where the phrases start."""
        return self.forward.order[ranges(of.low, of.n)[1]]


def ranges(low: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the intervals, and which interval each belongs to."""
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) + np.repeat(low - (np.cumsum(n) - n), n)


def keys_of(words: np.ndarray, hashes: np.ndarray, lang: str) -> tuple[np.ndarray, np.ndarray]:
    """Phrases as 80 bits, the same in every shard: a key and a check. Among 10^13 phrases 40 pairs are expected to share both; that
    one of them is frequent is far less likely still."""
    out = np.full(len(words), xxhash.xxh64_intdigest(lang), np.uint64)
    check = out + np.uint64(words.shape[1])
    for i in range(words.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[words[:, i]])
        check = mix(check + np.uint64(0xD6E8FEB86659FD93) * hashes[words[:, i]])
    return out, (check >> np.uint64(48)).astype(np.uint16)


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands in the sorted array, and whether it is there."""
    if not len(wanted):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
    return at, wanted[at] == keys


def _arrays(found: list, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(f[name], kind) for f in found] or [np.empty(0, kind)])


class _Reader:
    """One shard at one level, with what is known of its phrases over all shards."""

    def __init__(self, row: dict, depth: int):
        self.shard, self.lang, self.raw = row["shard"], row["lang"], row["vocabulary"]
        self.vocabulary = [b"", b"", *self.raw.split(MARK)]
        self.index = PhraseIndex(unpack(row["ids"]), depth)
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.vocabulary), np.uint64, len(self.vocabulary))
        found = row.get("found") or []
        self.frequent = np.sort(_arrays(found, "frequent", np.uint64))
        told = _arrays(found, "told", np.uint64)
        order = np.argsort(told)
        self.told, self.checks, self.totals = told[order], _arrays(found, "checks", np.uint16)[order], _arrays(found, "totals", np.int64).reshape(-1, 3)[order]

    def surviving(self, words: np.ndarray) -> np.ndarray:
        return find(keys_of(words, self.hashes, self.lang)[0], self.frequent)[1]

    def blocks(self, levels: list[Phrases], segments: int) -> list[dict]:
        """Keys and counts (occurrences, those that start and those that end a piece), cut by the high bits of the key."""
        pairs = [keys_of(p.words, self.hashes, self.lang) for p in levels]
        keys, checks = np.concatenate([k for k, _ in pairs]), np.concatenate([c for _, c in pairs])
        counts = np.concatenate([np.column_stack([p.n, self.index.at_edge(p, True), self.index.at_edge(p, False)]) for p in levels]).astype(np.uint32)
        order = np.argsort(keys)
        keys, checks, counts = keys[order], checks[order], counts[order]
        segment = ((keys >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
        ends = np.flatnonzero(np.diff(segment)) + 1
        return [{"kind": "block", "shard": self.shard, "segment": int(segment[a]), "keys": keys[a:b].tobytes(), "checks": checks[a:b].tobytes(),
                 "counts": pa.compress(counts[a:b].T.tobytes(), "zstd", asbytes=True)} for a, b in zip([0, *ends], [*ends, len(keys)]) if b > a]

    def phrases(self, of: Phrases) -> pa.RecordBatch:
        """The frequent phrases that this shard is to tell, as text with their counts over all shards."""
        keys, checks = keys_of(of.words, self.hashes, self.lang)
        at, known = find(keys, self.told)
        known[known] = self.checks[at[known]] == checks[known]
        words, totals = of.words[known], self.totals[at[known]]
        texts = [b" ".join([self.vocabulary[i] for i in row]).decode("utf-8", "surrogatepass") for row in words.tolist()]
        n = len(texts)
        given = {"kind": pa.array(["phrase"] * n), "lang": pa.array([self.lang] * n), "phrase": pa.array(texts, pa.string()),
                 "words": pa.array(np.full(n, of.words.shape[1], np.int32)), "n": pa.array(totals[:, 0]),
                 "n_left": pa.array(totals[:, 0] - totals[:, 1]), "n_right": pa.array(totals[:, 0] - totals[:, 2])}
        return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(n, f.type)) for f in LEVEL_TYPES], schema=LEVEL_TYPES)

    def reduced(self, pairs: Phrases) -> dict:
        """The same shard with only those words that a phrase of three frequent pairs' words could hold. Of a run of other ids
        the first and the last stay, so that neighbours still tell a word from the end of a piece."""
        ids = self.index.ids
        pair = np.zeros(len(ids) + 1, bool)
        pair[self.index.places(pairs)] = True
        three = pair[:-1] & pair[1:]
        held = three.copy()
        held[1:] |= three[:-1]
        held[2:] |= three[:-2]
        new = np.where(held, ids, np.minimum(ids, OTHER)).astype(np.int32)
        inner = ~held
        inner[1:] &= ~held[:-1]
        inner[:-1] &= ~held[1:]
        inner[0] = inner[-1] = False
        return {"kind": "shard", "shard": self.shard, "lang": self.lang, "vocabulary": self.raw, "ids": pack(new[~inner])}


# levels ---------------------------------------------------------------------------------

def first_level(segments: int):
    """Words and pairs as keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            shard = _Reader(row, 2)
            words = shard.index.single()
            pairs = shard.index.extend(words, left=False)
            yield _batch(shard.blocks([words, pairs], segments), LEVEL_TYPES)
    return run


def second_level(segments: int):
    """Frequent words and pairs as text; three words whose two pairs are both frequent as keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            shard = _Reader(row, 3)
            words = shard.index.single()
            yield shard.phrases(words)
            pairs = shard.index.extend(words, left=False)
            pairs = pairs.where(shard.surviving(pairs.words))
            yield shard.phrases(pairs)
            three = shard.index.extend(pairs, left=True)
            three = three.where(shard.surviving(three.words[:, :2]))
            if len(three.n):
                yield _batch([*shard.blocks([three], segments), shard.reduced(pairs)], LEVEL_TYPES)
    return run


def third_level(segments: int):
    """Frequent phrases of three words as text, and those of four whose two threes are frequent as keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            shard = _Reader(row, MAX_WORDS)
            three = shard.index.extend(shard.index.extend(shard.index.single(), left=False), left=True)
            three = three.where(shard.surviving(three.words))
            yield shard.phrases(three)
            four = shard.index.extend(three, left=False)
            four = four.where(shard.surviving(four.words[:, 1:]))
            if len(four.n):
                yield _batch(shard.blocks([four], segments), LEVEL_TYPES)
    return run


def fourth_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequent phrases of four words as text."""
    for row in _rows(batches):
        shard = _Reader(row, MAX_WORDS)
        found = shard.index.single()
        for left in (False, True, False):
            found = shard.index.extend(found, left)
        yield shard.phrases(found)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def survivors(blocks: DataFrame, least: int) -> DataFrame:
    """(shard, found): the shard's keys whose counts over all shards reach ``least``, and those among them that this shard, the
    first one to hold them, is to tell, with their counts. A segment holds one range of keys; a shard has each of its keys there
    once, so no key is hot."""
    def total(group: pa.Table) -> pa.Table:
        group = group.sort_by("shard")
        shard, raw = group.column("shard").to_pylist(), {c: group.column(c).to_pylist() for c in ("keys", "checks", "counts")}
        keys = np.concatenate([np.frombuffer(k, np.uint64) for k in raw["keys"]])
        checks = np.concatenate([np.frombuffer(k, np.uint16) for k in raw["checks"]])
        planes = [np.frombuffer(pa.decompress(c, 12 * (len(k) // 8), "zstd"), np.uint32).reshape(3, -1) for c, k in zip(raw["counts"], raw["keys"])]
        counts = np.concatenate(planes, axis=1).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        differ = checks[order][1:] != checks[order][:-1]
        if (differ & (keys[order][1:] == keys[order][:-1])).any():  # one key for several phrases
            order = np.lexsort((np.arange(len(keys)), checks, keys))
        new = np.flatnonzero(np.concatenate([[True], (keys[order][1:] != keys[order][:-1]) | (checks[order][1:] != checks[order][:-1])]))
        sums = np.add.reduceat(counts[:, order], new, axis=1)
        often = sums[0] >= least
        frequent, told = np.zeros(len(keys), bool), np.full(len(keys), -1, np.int64)
        frequent[order] = np.repeat(often, np.diff(np.append(new, len(keys))))
        told[order[new[often]]] = np.flatnonzero(often)
        ends = np.cumsum([len(k) // 8 for k in raw["keys"]])
        out = []
        for s, a, b in zip(shard, [0, *ends], ends):
            if frequent[a:b].any():
                mine = np.flatnonzero(told[a:b] >= 0) + a
                out.append({"shard": s, "frequent": keys[a:b][frequent[a:b]].tobytes(), "told": keys[mine].tobytes(), "checks": checks[mine].tobytes(),
                            "totals": np.ascontiguousarray(sums[:, told[mine]].T).tobytes()})
        return pa.Table.from_pylist(out, FOUND_TYPES)

    found = blocks.groupBy("segment").applyInArrow(total, "shard long, frequent binary, told binary, checks binary, totals binary")
    return found.groupBy("shard").agg(F.collect_list(F.struct("frequent", "told", "checks", "totals")).alias("found"))  # at most the shard's own phrases


FOUND_TYPES = pa.schema([("shard", pa.int64()), *[(c, pa.binary()) for c in ("frequent", "told", "checks", "totals")]])


def phrase_counts(docs: DataFrame, least: int = 30, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n, n_left, n_right) of all phrases of one to four words with at least ``least`` occurrences inside
    pieces, and (lang, n) with all word occurrences. n_left and n_right count the occurrences with a word on that side.

    Each level extends phrases inside the shards and sums the counts of their keys across them; a phrase goes on only where its
    parts are frequent over all shards, and one of the shards that hold it tells its text.
    """
    cut = staged(shards(docs, text, lang), "collocation-shards")
    totals = cut.groupBy("lang").agg(F.sum("n_words").alias("n"))
    words = cut.agg(F.sum("n_words")).first()[0] or 0
    segments = max(MIN_SEGMENTS, words // SEGMENT_KEYS)

    def known(level: DataFrame) -> DataFrame:
        return survivors(level.where("kind = 'block'").select("segment", "shard", "keys", "checks", "counts"), least)

    columns = ["shard", "lang", "vocabulary", "ids"]
    one = cut.select(*columns).mapInArrow(first_level(segments), LEVEL_SCHEMA)
    two = staged(cut.select(*columns).join(known(one), "shard").mapInArrow(second_level(segments), LEVEL_SCHEMA), "collocation-threes")
    rest = two.where("kind = 'shard'").select(*columns)
    three = staged(rest.join(known(two), "shard").mapInArrow(third_level(segments), LEVEL_SCHEMA), "collocation-fours")
    four = rest.join(known(three), "shard").mapInArrow(fourth_level, LEVEL_SCHEMA)
    found = [t.where("kind = 'phrase'").select("lang", "phrase", "words", "n", "n_left", "n_right") for t in (two, three, four)]
    return found[0].unionByName(found[1]).unionByName(found[2]), totals


def collocations(docs: DataFrame, least: int = 30, top: int = 2_000, scale: int = 2_000_000, share_percent: int = 80, text: str = "text",
                 lang: str = "lang") -> DataFrame:
    """The ``top`` phrases of two to four words of each language: lang, rank, phrase, a, l, r, n, score, n_left, n_right.

    A text is lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and a piece into words at spaces and tabs. A phrase
    with a >= ``least`` occurrences is cut after each of its words into parts with l and r occurrences; its score is the smallest
    floor(scale * a / (l + r)), the shortest first part among equal ones. Phrases inside a longer one that has at least
    ``share_percent`` of their occurrences are left out. Ranks go by score, a (both falling) and the phrase's bytes.
    Null texts count as empty, null languages as ``und``; rows are taken as they are, so repeated rows count repeatedly, and other
    columns do not matter. An empty table gives no rows.
    """
    counts, totals = phrase_counts(docs, least, text, lang)
    frequent = staged(counts, "collocation-frequent")
    candidates = frequent.where("words > 1").withColumn("parts", F.split("phrase", " "))
    part = frequent.select("lang", F.col("phrase").alias("part"), F.col("n").alias("part_n"))
    cuts = candidates.select("lang", "phrase", F.col("n").alias("a"), "n_left", "n_right", "parts", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")) \
        .withColumns({"head": F.array_join(F.expr("slice(parts, 1, k)"), " "), "tail": F.array_join(F.expr("slice(parts, k + 1, size(parts))"), " ")}) \
        .drop("parts")
    heads = part.select(F.col("lang"), F.col("part").alias("head"), F.col("part_n").alias("l"))
    tails = part.select(F.col("lang"), F.col("part").alias("tail"), F.col("part_n").alias("r"))
    exact = F.expr(f"cast({scale} AS decimal(18, 0)) * cast(a AS decimal(20, 0)) div (l + r)")
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumn("score", exact) \
        .groupBy("lang", "phrase", "a", "n_left", "n_right").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    inner = candidates.where("words > 2").select("lang", F.col("n").alias("whole"), "parts", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")) \
        .select("lang", "whole", "parts", "size", F.explode(F.expr("sequence(1, words - size + 1)")).alias("at")) \
        .select("lang", F.array_join(F.expr("slice(parts, at, size)"), " ").alias("phrase"), "whole") \
        .groupBy("lang", "phrase").agg(F.max("whole").alias("whole"))
    left = scored.join(inner, ["lang", "phrase"], "left") \
        .where(f"whole IS NULL OR cast(100 AS decimal(18, 0)) * whole < cast({share_percent} AS decimal(18, 0)) * a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.select("lang", "phrase", "a", "best.l", "best.r", "best.score", "n_left", "n_right") \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "n_left", "n_right")
