"""Fill-in-middle against a plain version over strings, and the skip list against sums of widths."""

import hashlib
import re

import numpy as np
import pytest
from awkward import table
from pyspark.sql import functions as F

from tabkit.llm import infill

TEXTS = ["", None, "a", "ab", " \t\n ", "plain words in a row", "mark <P> inside", "<M>", "<S", "<<P", "P><S", "éß🤦🏼‍♂️ñ 漢字 é x", "long 漢 " * 40_000, "same", "same"]
ROWS = [(i % 37, TEXTS[i % len(TEXTS)]) for i in range(400)] + [(None, "no key"), (None, None), (5, TEXTS[5]), (5, TEXTS[5])]


def brute(key, text, unit=None):
    text = text or ""
    pieces = list(text) if unit is None else [p for p in re.split(f"({unit})", text) if p]
    h = hashlib.sha256(f"1:{'null' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(pieces)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (pieces[:a], pieces[a:b], pieces[b:]))
    form = "spm" if h4 % 100 < 20 else "psm"
    return n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", [None, r"\w+", r"[^\n]+\n?"])
def test_infill_equals_strings(spark, unit):
    docs = table(spark, ROWS, "doc_id long", "text string").repartition(3)
    made = infill.infill(docs, unit=unit).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    assert {"doc_id", "text", "a.b", "shard"} <= set(made.columns)
    got = made.collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["doc_id"], r["text"], unit)
        assert r["back"] == (r["text"] or "")
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_string_keys_and_empty_table(spark):
    docs = table(spark, [("k1", "one two three")], "doc_id string", "text string")
    r = infill.infill(docs).first()
    assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute("k1", "one two three")
    assert infill.infill(docs.where("false")).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 15, 16, 17, 300, 70_000])
def test_skip_list_reaches_every_rank(n):
    rng = np.random.default_rng(n)
    lanes = infill.Lanes(100_000)
    widths = rng.integers(1, 9, n)
    before = np.concatenate([[0], np.cumsum(widths)])
    ranks = range(n + 1) if n < 400 else [0, 1, n - 1, n, *rng.integers(0, n, 300).tolist()]
    units, points = infill.SkipList(n, widths, lanes), infill.SkipList(n, None, lanes)
    assert n < 400 or len(units.lanes) >= 3
    for r in ranks:
        assert units.seek(int(r)) == before[r]
        assert points.seek(int(r)) == r


def test_lanes_grow_with_the_text():
    small = infill.Lanes(64)
    large = small.at_least(1_000)
    assert small.at_least(64) is small and large.size >= 1_000
    assert [r[r < 64].tolist() for r in large.ranks][:len(small.ranks)] == [r.tolist() for r in small.ranks]
