"""Benchmark decontamination: size-partitioned MinHash containment search. DataFrame functions only.

A document holds an item if it has at least 80 % of the item's distinct 5-word shingles. Of an item with n shingles at most
m = n - ceil(0.8 n) may be missing, so among the m + 1 smallest hashes (its MinHash sketch, longer for larger
items) one must occur in the document: looking those up misses nothing, however long the document. What is found is
verified with the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import q
from .common import packed, staged, unpacked, words

SHINGLE_WORDS = 5
MIN_CONTAINMENT_PERCENT = 80


def _tokens(text: Column) -> Column:
    return words(F.lower(text))


def _starts(tokens: Column, k: int) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.size(tokens) - k, F.lit(0)))


def shingle_hashes(tokens: Column, k: int = SHINGLE_WORDS) -> Column:
    """Hashes of the k-word shingles; of the whole sequence if it is shorter, none without words."""
    marks = F.transform(tokens, lambda w: F.xxhash64(w))

    def of(m: Column) -> Column:
        return (F.when(F.size(m) >= k, F.transform(_starts(m, k), lambda i: F.xxhash64(*[F.get(m, i + j) for j in range(k)])))
                .when(F.size(m) > 0, F.array(F.xxhash64(m))).otherwise(F.array().cast("array<bigint>")))
    return F.transform(F.array(marks), of)[0]  # a one-element array binds the word hashes to a name


def shingles(tokens: Column, k: int = SHINGLE_WORDS) -> Column:
    def of(w: Column) -> Column:
        return (F.when(F.size(w) >= k, F.transform(_starts(w, k), lambda i: F.concat_ws(" ", *[F.get(w, i + j) for j in range(k)])))
                .when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>")))
    return F.transform(F.array(tokens), of)[0]


def _text_key(text: Column) -> list[Column]:
    """128 bits that stand for the text: rows with equal texts are looked up once, and need no id."""
    return [F.xxhash64(text).alias("__k1"), F.xxhash64(F.lit("text"), text).alias("__k2")]


def _matches(docs: DataFrame, text: str, items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """(__k1, __k2, __item, __n, __shared) of every document text and item that it holds."""
    texts = docs.select(docs[q(text)].alias("__text")).where("__text is not null")
    bench = items.select(items[q(item_id)].alias("__item"), items[q(item_text)].alias("__body")).distinct()
    bench = staged(bench.withColumn("__shingles", F.array_distinct(shingles(_tokens(F.col("__body")))))
                   .select("__item", F.xxhash64("__body").alias("__body_key"), F.size("__shingles").alias("__n"), "__shingles",
                           F.array_sort(F.array_distinct(shingle_hashes(_tokens(F.col("__body"))))).alias("__hashes"))
                   .where("__n > 0"), "benchmark")
    missing = F.col("__n") - F.ceil(F.col("__n") * MIN_CONTAINMENT_PERCENT / 100).cast("int")
    sketch = staged(bench.select("__item", "__body_key", F.explode(F.slice("__hashes", F.lit(1), missing + 1)).alias("__hash")), "sketch")
    looked = texts.select(*_text_key(F.col("__text")), F.explode(shingle_hashes(_tokens(F.col("__text")))).alias("__h"))
    found = (looked.join(sketch, F.col("__h") == F.col("__hash"))  # Spark broadcasts the sketch if its written size allows it
             .select("__k1", "__k2", "__item", "__body_key").distinct())
    found = found.join(bench.select(F.col("__item").alias("__i"), F.col("__body_key").alias("__b"), "__n", "__shingles"),
                       F.col("__item").eqNullSafe(F.col("__i")) & (F.col("__body_key") == F.col("__b")))
    found = staged(found.select("__k1", "__k2", "__item", "__n", "__shingles"), "candidates")
    # first the few texts that have a candidate, by keys alone; then these with what the items hold
    keys = staged(found.select("__k1", "__k2").distinct(), "candidate-texts")
    named = staged(texts.select(*_text_key(F.col("__text")), "__text").join(keys, ["__k1", "__k2"], "left_semi"), "texts-to-verify")
    pairs = named.join(found, ["__k1", "__k2"])
    shared = F.size(F.array_intersect("__shingles", shingles(_tokens(F.col("__text")))))
    # a one-row generator keeps the filter from counting once more
    held = pairs.select("__k1", "__k2", "__item", "__n", F.explode(F.array(shared)).alias("__shared")).where(100 * F.col("__shared") >= MIN_CONTAINMENT_PERCENT * F.col("__n"))
    return held.groupBy("__k1", "__k2", "__item").agg(F.max("__n").alias("__n"), F.max("__shared").alias("__shared"))


def containments(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document row and item it holds: the id column, the item's id, ``n_shingles`` (distinct ones of the item),
    ``n_shared`` and ``containment``. Documents that hold none do not appear.

    Null or empty texts and items hold and match nothing. Texts under five words are one shingle. Repeated document rows each
    get their rows; repeated items (same id, same text) count once. Extra columns are not carried.
    """
    held = staged(_matches(docs, text, items, item_id, item_text), "containments")
    keyed = docs.select(docs[q(id_col)].alias("__id"), *_text_key(docs[q(text)])).where(docs[q(text)].isNotNull())
    return keyed.join(held, ["__k1", "__k2"]).select(
        F.col("__id").alias(id_col), F.col("__item").alias(item_id), F.col("__n").cast("long").alias("n_shingles"),
        F.col("__shared").cast("long").alias("n_shared"), (F.col("__shared") / F.col("__n")).alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item. Rows with a null text stay."""
    bad = staged(_matches(docs, text, items, item_id, item_text).select("__k1", "__k2").distinct(), "contaminated")
    names = docs.columns
    keyed = docs.select(packed(docs, names), *_text_key(docs[q(text)]))
    return keyed.join(bad, ["__k1", "__k2"], "left_anti").select(*unpacked(names))
