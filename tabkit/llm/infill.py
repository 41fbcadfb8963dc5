"""Fill-in-middle: two cut ranks per text, reached in an indexable skip list of its units."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.runtime import col
from .common import mix, with_arrow

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
LANE_BITS = 4  # a unit reaches the next lane with a chance of 1 / 16

ADDED = T.StructType([T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
                      T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])


class Lanes:
    """Which units stand on which express lane: coins that depend on the unit's rank alone, so that every list of at most
    ``size`` units is a prefix of the same lanes. Lane j lists its ranks and where each of them stands on lane j - 1."""

    def __init__(self, size: int):
        self.size, self.ranks, self.below = size, [], []
        ranks = np.arange(size, dtype=np.int64)
        coins = mix(ranks.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        while len(ranks) > 1:
            up = np.flatnonzero((coins & np.uint64((1 << LANE_BITS) - 1)) == 0)
            up = np.concatenate([[0], up[up > 0]])  # the head is on every lane
            if len(up) == 1:
                break
            ranks, coins = ranks[up], coins[up] >> np.uint64(LANE_BITS)
            self.ranks.append(ranks)
            self.below.append(up)

    def at_least(self, n: int) -> "Lanes":
        return self if n <= self.size else Lanes(max(n, 2 * self.size))


class SkipList:
    """The units of one text in order, indexable by rank.

    A link of an express lane carries its unit-width (how many units it passes) and its code-point-width (how many code points
    these units hold); the ground lane has the units themselves. ``widths`` are the code points of each unit; None: one each.
    """

    def __init__(self, n: int, widths: np.ndarray | None, lanes: Lanes):
        self.n, self.widths = n, widths
        starts = None if widths is None else np.concatenate([[0], np.cumsum(widths)])
        self.lanes = []
        for ranks, below in zip(lanes.ranks, lanes.below):
            k = int(np.searchsorted(ranks, n))
            if k < 2:
                break
            ends = np.append(ranks[:k], n)
            units = np.diff(ends)
            self.lanes.append((units, units if starts is None else np.diff(starts[ends]), below[:k]))

    def seek(self, rank: int) -> int:
        """Code points before the unit of this rank (rank n: of the whole text), by descending from the topmost lane."""
        left, points, at = rank, 0, 0
        for units, chars, below in reversed(self.lanes):
            while at < len(units) and units[at] <= left:
                left -= int(units[at])
                points += int(chars[at])
                at += 1
            if at == len(units):  # past the last unit
                return points
            at = int(below[at])
        return points + (left if self.widths is None else int(self.widths[at:at + left].sum()))


def unit_widths(text: str, pattern: re.Pattern) -> np.ndarray:
    """Code points of the units: the pattern's matches from left to right, and what stands between them."""
    widths, at = [], 0
    for m in pattern.finditer(text):
        if m.end() > m.start():
            widths += [m.start() - at, m.end() - m.start()] if m.start() > at else [m.end() - m.start()]
            at = m.end()
    if at < len(text):
        widths.append(len(text) - at)
    return np.array(widths, np.int64)


def draws(seed: int, key: str) -> list[int]:
    """Four numbers of 32 bits that depend on seed and key alone."""
    digest = hashlib.sha256(f"{seed}:{key}".encode("utf-8", "surrogatepass")).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4)]


def infill(df: DataFrame, key: str = "doc_id", text: str = "text", unit: str | None = None, seed: int = 1, plain_percent: int = 10,
           spm_percent: int = 20) -> DataFrame:
    """``df`` plus n (units), form, prefix_chars, middle_chars (code points) and output, the rearranged text.

    ``unit`` is a regular expression; None takes code points. Both cuts are uniform ranks between units, drawn from ``seed`` and
    the key. ``psm`` puts prefix, suffix, middle behind their marks, ``spm`` suffix, prefix, middle; ``plain`` leaves the text as
    it is: texts without units, texts that hold a mark, and ``plain_percent`` of the others. A null text is an empty one and gives
    an empty output; a null key draws like the text ``null``; equal rows give equal results. Columns of ``df`` with one of the
    added names are replaced. A row needs memory for its own text only.
    """
    state = {"lanes": None}

    def rearrange(rows: list) -> dict[str, list]:
        lanes = state["lanes"] or Lanes(1 << 14)
        pattern = re.compile(unit) if unit is not None else None
        out = {f.name: [] for f in ADDED}
        for row in rows:
            whole = row["text"] or ""
            widths = None if pattern is None else unit_widths(whole, pattern)
            n = len(whole) if widths is None else len(widths)
            h1, h2, h3, h4 = draws(seed, "null" if row["key"] is None else row["key"])
            form, a, b, made = "plain", None, None, whole
            if n and h3 % 100 < 100 - plain_percent and not (PREFIX in whole or SUFFIX in whole or MIDDLE in whole):
                lanes = lanes.at_least(n)
                units = SkipList(n, widths, lanes)
                low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                a, b = units.seek(low), units.seek(high)
                form = "spm" if h4 % 100 < spm_percent else "psm"
                first, last = PREFIX + whole[:a], SUFFIX + whole[b:]
                made = (last + first if form == "spm" else first + last) + MIDDLE + whole[a:b]
            for name, value in zip(out, (n, form, a, None if a is None else b - a, made)):
                out[name].append(value)
        state["lanes"] = lanes
        return out

    source = F.struct(col(text).cast("string").alias("text"), col(key).cast("string").alias("key"))
    return with_arrow(df, source, ADDED, rearrange)


def restored(output: Column, form: Column) -> Column:
    """The text before ``infill``, from output and form. A text that holds a mark is never rearranged, and no mark can arise where
    two parts meet one, so the three marks cut an output into exactly its parts."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
