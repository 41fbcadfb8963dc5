"""Line-first cleaning: rules per line, then a verdict per document. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import q
from .common import packed, unpacked, words

# Fixed values of the rules.
SENTENCE_END = r"[.!?…][)\]\x22\x27”’»]*( |\t|$)"  # a sentence ends somewhere in the line
MARKS = r"[#*$%&|<>!?]"  # marks that prose uses sparingly
BOILERPLATE = (r"(?i)licensed under|released under the|all rights reserved|copyright|©|\bcookies?\b|privacy policy|terms of (use|service)"
               r"|enable javascript|subscribe to|click here|sign up|log in|read more|share this|powered by")
MARKS_PER_100_WORDS = 40
SEPARATORS_PER_100_WORDS = 30
MAX_LOST_PERCENT = 30
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _hits(text: Column, pattern: str) -> Column:
    return F.size(F.split(text, pattern)) - 1


def line_fails(line: Column) -> Column:
    """A line with words fails if no sentence ends in it (punctuation), if marks crowd its words
    (punctuation), if it is a row of items between bars (navigation), or if it holds a stock
    phrase of notices and licenses (boilerplate). A line without words never fails."""
    n = F.size(words(line))
    return (n > 0) & (~F.rlike(line, F.lit(SENTENCE_END))
                      | (100 * _hits(line, MARKS) > MARKS_PER_100_WORDS * n)
                      | (100 * _hits(line, r"[|»›·•]") > SEPARATORS_PER_100_WORDS * n)
                      | F.rlike(line, F.lit(BOILERPLATE)))


def _chars(text: Column) -> Column:
    return F.length(F.array_join(words(text), ""))


def repeat_words(tokens: Column) -> Column:
    """Words inside a 3-word window whose content occurs twice or more, first occurrence included.

    Windows are compared by 64-bit hash: sorted with their places, equal neighbours are repeats.
    Texts without a repeat are told by one primitive sort.
    """
    last = F.size(tokens) - 3
    hashes = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(
        F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)))).otherwise(F.array().cast("array<bigint>"))
    return hashes


def _covered(hashes: Column) -> Column:
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(rows: Column) -> Column:
        at = F.filter(rows, lambda x, i: (x["h"] == F.get(rows, i + 1)["h"]) | (x["h"] == F.get(rows, i - 1)["h"]))
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    # a one-element array binds the sorted rows to a name, so that they are sorted once
    return F.get(F.transform(F.array(placed), places), F.lit(0))


def _measured(df: DataFrame) -> DataFrame:
    t = F.col("__text")
    df = df.withColumn("__words", words(t)).withColumn("__lines", F.split(F.coalesce(t, F.lit("")), "\n"))
    df = df.withColumn("__hashes", repeat_words(F.col("__words")))
    df = df.withColumn("__repeats", F.size(F.col("__hashes")) > F.size(F.array_distinct("__hashes")))
    full = F.filter("__lines", lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    return df.withColumns({
        "__n_words": F.size("__words").cast("long"),
        "__word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "__n_symbols": _hits(F.coalesce(t, F.lit("")), r"[#*$%&|<>]").cast("long"),
        "__n_dup_lines": F.transform(F.array(full), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long"),
        "__n_repeat_words": F.when(F.col("__repeats"), _covered(F.col("__hashes"))).otherwise(0).cast("long"),
        "__kept_lines": F.filter("__lines", lambda x: ~line_fails(x)),
    })


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text"]


def clean_lines(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """All rows and columns of ``docs`` with the measures of the text, ``base_failed``, ``kept`` and
    ``clean_text`` (the lines that pass, joined by line breaks), each named with ``prefix``.

    ``base_failed``: under 50 words, or over half of them in repeated 3-word windows. ``kept``: not
    base_failed and no more than 30 % of the word characters lost with the failing lines.
    A null text counts as empty: no words, base_failed, an empty clean_text. Repeated rows are
    judged one by one alike; an empty table gives an empty one.
    """
    keep = [c for c in docs.columns if c not in [prefix + m for m in MEASURES]]
    out = _measured(docs.select(packed(docs, keep), docs[q(text)].alias("__text")))
    clean = F.array_join("__kept_lines", "\n")
    out = out.withColumn("__clean_text", clean).withColumn("__lost", F.col("__word_chars") - _chars(F.col("__clean_text")))
    out = out.withColumn("__base_failed", (F.col("__n_words") < MIN_WORDS)
                         | (100 * F.col("__n_repeat_words") > MAX_REPEAT_PERCENT * F.col("__n_words")))
    out = out.withColumn("__kept", ~F.col("__base_failed") & (100 * F.col("__lost") <= MAX_LOST_PERCENT * F.col("__word_chars")))
    # a one-row generator: a filter on a verdict is applied to the measured columns instead of measuring once more
    measured = F.inline(F.array(F.struct(*[F.col(f"__{m}").alias(prefix + m) for m in MEASURES])))
    return out.select(*unpacked(keep), measured)
