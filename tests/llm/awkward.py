"""Rows for the newer text operators: nulls in every column, empty, blank and very long texts, repeated rows, ties, clashing names."""

import random

CLASH = ["n", "form", "score", "phrase", "shard", "keys", "words", "rest", "source", "a.b"]


def columns(*names):
    return ", ".join([*names, *[f"`{c}` string" for c in CLASH if c not in "".join(names).split()]])


def table(spark, rows, *names):
    extra = columns(*names).count(",") + 1 - len(names)
    return spark.createDataFrame([(*r, *["x"] * extra) for r in rows], columns(*names))


def prose(rng, n, vocabulary):
    return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ?! "]) for _ in range(n))
