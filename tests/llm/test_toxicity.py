"""The classifier: its features and ratios against plain counting, its held-out accuracy, and awkward rows."""

import collections
import math
import random

import numpy as np
import pytest
from awkward import prose, table
from pyspark.sql import functions as F

from tabkit.llm import toxicity
from tabkit.llm.queries import QUERIES

VOCABULARY = [f"{a}{b}" for a in ("ta", "lo", "mi", "ru", "éz") for b in ("n", "ra", "st", "pé", "ck")]
INSULTS = ["vilko", "grubax", "zwonk"]


def corpus(n=400):
    rng = random.Random(11)
    docs, labels = [], []
    for i in range(n):
        text, toxic = prose(rng, rng.randint(5, 120), VOCABULARY), i % 5 == 0
        if toxic:
            words = text.split(" ")
            for _ in range(rng.randint(1, 5)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(INSULTS).upper() if i % 3 else rng.choice(INSULTS) + rng.choice(["en", "s", ""]))
            text = " ".join(words)
        docs.append((i, text))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    docs = table(spark, docs + [(None, None), (None, "x"), (9_001, ""), (9_002, "tan " * 400_000), (9_003, "vilko grubax zwonk " * 3)], "doc_id long", "text string")
    labels = table(spark, labels + [(None, 1), (3, None), (9_001, 0), (7, 0), (12_345, 1)], "doc_id long", "toxic int")
    return docs.repartition(4), labels


def grams(text):
    flat = " " + " ".join((text or "").lower().split()) + " "
    return {flat[i:i + n] for n in toxicity.SIZES for i in range(len(flat) - n + 1)}


def test_buckets_are_those_of_the_grams(monkeypatch):
    text = "  Ab\tcd éñ\n漢🤦 x"
    one = {g: np.unique(np.concatenate(list(toxicity.buckets_of(g)))) for g in ("abc",)}
    assert one and collections.Counter(len(b) for b in toxicity.buckets_of(text)) == collections.Counter(len(" ab cd éñ 漢🤦 x ") - n + 1 for n in toxicity.SIZES)
    whole = np.sort(np.concatenate(list(toxicity.buckets_of("abc de " * 50))))
    monkeypatch.setattr(toxicity, "SLICE", 10)
    assert np.array_equal(whole, np.sort(np.concatenate(list(toxicity.buckets_of("abc de " * 50)))))
    assert sum(len(b) for b in toxicity.buckets_of(None)) == 0


def test_ratios_equal_counting(spark):
    docs, labels = corpus(60)
    rows = [(t, l) for (_, t), (_, l) in zip(docs, labels)] + [("", 0), (None, 1)]
    got = toxicity.ratios(spark.createDataFrame(rows, "text string, label int").repartition(3), 1 << 20)
    held = [collections.Counter(), collections.Counter()]
    for text, label in rows:
        held[label].update({int(b) for bs in toxicity.buckets_of(text) for b in bs})
    seen = set(held[0]) | set(held[1])
    p, q = (sum(h[b] + 1.0 for b in seen) for h in (held[1], held[0]))
    assert {r["bucket"] for r in got} == seen
    n = [sum(l == c for _, l in rows) for c in (0, 1)]

    def g2(b):
        cells = [(held[c][b], n[c], True) for c in (0, 1)] + [(n[c] - held[c][b], n[c], False) for c in (0, 1)]
        both = held[0][b] + held[1][b]
        return sum(o * math.log(o / (of * (both if present else sum(n) - both) / sum(n))) for o, of, present in cells if o)
    for r in got:
        assert r["ratio"] == pytest.approx(math.log((held[1][r["bucket"]] + 1) / p) - math.log((held[0][r["bucket"]] + 1) / q))
        assert r["g2"] == pytest.approx(g2(r["bucket"]), abs=1e-5)
    assert [r["g2"] for r in got] == sorted((r["g2"] for r in got), reverse=True)


def test_scores_by_hand_and_held_out(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels.where("doc_id % 3 <> 1"))
    scored = toxicity.apply(docs, model)
    assert set(docs.columns) == set(scored.columns)  # the given column score is replaced
    rows = scored.select("doc_id", "text", "score").collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    weight = dict(zip(model.buckets.tolist(), model.weights.tolist()))
    for r in rows:
        held = {int(b) for bs in toxicity.buckets_of(r["text"]) for b in bs}
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-(model.intercept + sum(weight.get(b, 0) for b in held)))), abs=1e-9)
    by_id = {r["doc_id"]: r["score"] for r in rows}
    wrong = [i for i, l in corpus()[1] if i % 3 == 1 and (by_id[i] >= 0.5) != l]
    assert len(wrong) <= 4, wrong
    assert by_id[9_003] > 0.7 > by_id[9_001]


def test_sample_is_bounded_and_weighted(spark, tables):
    docs, labels = tables
    sample, counts = toxicity.labelled_sample(docs, labels, "doc_id", "text", "toxic", 40)
    got = sample.groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()
    assert counts == {1: 81, 0: 321}
    assert all(20 <= r["n"] <= 60 and abs(r["w"] / counts[r["label"]] - r["n"] / 40) < 1e-9 for r in got)


def test_missing_classes_and_empty_tables(spark, tables):
    docs, labels = tables
    for few, share in [(labels.where("false"), 0.5), (labels.where("toxic = 1 AND doc_id < 10"), 3 / 4)]:
        scores = {round(r["score"], 9) for r in toxicity.apply(docs, toxicity.fit(docs, few)).select("score").collect()}
        assert scores == {round(share, 9)}
    assert toxicity.apply(docs.where("false"), toxicity.fit(docs.where("false"), labels)).collect() == []


def test_query_is_accurate_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op11_naive_bayes_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out")
    r = got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("accuracy"),
                F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("false_alarms")).first()
    assert r["accuracy"] > 0.95 and r["false_alarms"] < 0.01
