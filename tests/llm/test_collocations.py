"""Collocations against counting all phrases of all texts, and the index against counting phrases of one shard."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from awkward import prose, table
from pyspark.sql import functions as F

from tabkit.llm import collocations


def pieces(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0a-\x0d]", low)]


def phrases(rows):
    f, n, left, right = (collections.Counter() for _ in range(4))
    for text, lang in rows:
        for w in pieces(text):
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    key = lang or "und", tuple(w[i:i + k])
                    f[key] += 1
                    left[key] += i > 0
                    right[key] += i + k < len(w)
    return f, n, left, right


def brute(rows, least, top):
    f, n, left, right = phrases(rows)
    kept = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inner = {(l, w[i:i + s]) for (l, w), a in kept.items() for s in range(2, len(w)) for i in range(len(w) - s + 1) if 100 * a >= 80 * f[l, w[i:i + s]]}
    out = collections.defaultdict(list)
    for (l, w), a in kept.items():
        if (l, w) not in inner:
            score, k = min((2_000_000 * a // (f[l, w[:k]] + f[l, w[k:]]), k) for k in range(1, len(w)))
            out[l].append((-score, -a, " ".join(w).encode(), f[l, w[:k]], f[l, w[k:]], left[l, w], right[l, w]))
    return sorted((l, i + 1, p.decode(), -a, x, y, n[l], -s, lo, hi) for l, found in out.items()
                  for i, (s, a, p, x, y, lo, hi) in enumerate(sorted(found)[:top]))


def rows():
    rng = random.Random(3)
    vocabulary = [rng.choice(["Al", "be", "É", "ß", "漢", "\x1c", "-"]) + str(i % 30) for i in range(45)] + ["the"] * 25
    out = [(prose(rng, rng.randint(0, 200), vocabulary), rng.choice(["en", "en", "fr", None])) for _ in range(90)]
    out += [(out[0][0], "en")] * 40 + [("Copied passage of six words, twice copied", "fr")] * 35  # copies: phrases inside longer ones
    out += [(None, "en"), ("", None), (" \t. ,", "fr"), (None, None), ("one", "de"), ("new york " * 20_000, "de"), ("the the the the the", "und")]
    out += [(f"tie{i} tie{i}x", "es") for i in range(6)] * 30
    return out


@pytest.mark.parametrize("least, top", [(30, 2_000), (3, 2_000), (3, 7), (1, 50)])
def test_collocations_equal_counting(spark, least, top):
    docs = table(spark, rows(), "text string", "lang string").repartition(5)
    got = collocations.collocations(docs, least=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "n_left", "n_right"]
    assert all(t == "bigint" for c, t in got.dtypes if c not in ("lang", "phrase"))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows(), least, top)


def test_empty_tables(spark):
    docs = table(spark, rows(), "text string", "lang string")
    assert collocations.collocations(docs.where("false")).collect() == []
    assert collocations.collocations(docs.where("text IS NULL")).collect() == []


def test_long_texts_are_split_where_pieces_end(monkeypatch):
    text = "One two, three.four  five\nsix;" * 50 + "no end " * 30
    whole, sliced = collocations._Shard(), collocations._Shard()
    whole.add(text.encode())
    monkeypatch.setattr(collocations, "SLICE", 16)
    sliced.add(text.encode())
    assert whole.row(1, "en") == sliced.row(1, "en")


@pytest.mark.parametrize("seed", range(4))
def test_index_extends_both_ways(seed):
    """All phrases of up to four words, reached by every order of left and right extensions, with their counts."""
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, 7, 400).astype(np.int32)
    ids[ids == collocations.OTHER] = collocations.BREAK
    ids[-1] = collocations.BREAK
    index = collocations.PhraseIndex(ids, 4)
    for sides in [(True,) * 3, (False,) * 3, (False, True, False), (True, False, True)]:
        found = index.single()
        for size in range(1, 5):
            if size > 1:
                found = index.extend(found, left=sides[size - 2])
            starts = [i for i in range(len(ids) - size + 1) if (ids[i:i + size] >= collocations.FIRST).all()]
            want = collections.Counter(tuple(ids[i:i + size].tolist()) for i in starts)
            assert dict(zip(map(tuple, found.words.tolist()), found.n.tolist())) == want
            assert sorted(index.places(found).tolist()) == starts
            before = collections.Counter(tuple(ids[i:i + size].tolist()) for i in starts if ids[i - 1] == collocations.BREAK)
            after = collections.Counter(tuple(ids[i:i + size].tolist()) for i in starts if ids[i + size] == collocations.BREAK)
            for w, a, b in zip(map(tuple, found.words.tolist()), index.at_edge(found, True), index.at_edge(found, False)):
                assert (a, b) == (before[w], after[w])


def test_one_key_for_several_phrases(spark):
    """Counts stay apart where only the checks differ."""
    def block(shard, keys, checks, counts):
        return 0, shard, np.array(keys, np.uint64).tobytes(), np.array(checks, np.uint16).tobytes(), pa.compress(np.array([counts, [0] * len(counts), counts], np.uint32).tobytes(), "zstd", asbytes=True)
    rows = [block(1, [5, 9], [1, 1], [20, 40]), block(2, [5, 7], [2, 1], [29, 3]), block(3, [5, 7], [2, 1], [2, 26])]
    found = collocations.survivors(spark.createDataFrame(rows, collocations.BLOCK_SCHEMA), 30).collect()
    told = [(r["shard"], np.frombuffer(f["told"], np.uint64).tolist(), np.frombuffer(f["checks"], np.uint16).tolist(), np.frombuffer(f["totals"], np.int64).tolist())
            for r in found for f in r["found"]]
    assert sorted(told) == [(1, [9], [1], [40, 0, 40]), (2, [5], [2], [31, 0, 31]), (3, [], [], [])]


def test_ids_survive_packing():
    for ids in ([], [0], [0, 1, 2, 70_000, 2**31 - 1]):
        assert collocations.unpack(collocations.pack(np.array(ids, np.int32))).tolist() == ids
