"""Secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.runtime import q
from .common import with_arrow

# The base patterns, in the order in which their kinds are listed.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = {"assign": 0, "access": 1, "hex": 2, "entropy": 3}
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

# The entropy scan: candidate strings are runs of RUN_CHARS; a window of WINDOW characters of one class
# is random if its entropy in bits reaches the class's threshold.
RUN_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 24
CLASSES = {"hex": (frozenset("0123456789abcdefABCDEF"), 3.0), "token": (frozenset(RUN_CHARS), 3.85)}
# Keys in one case: base36, base32. They have fewer symbols, so their thresholds are lower and they must hold several digits.
LOWER, UPPER = frozenset("abcdefghijklmnopqrstuvwxyz0123456789"), frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
LONG = CLASSES | {"lower": (LOWER, 3.7), "upper": (UPPER, 3.7)}
# Tokens of SHORT to WINDOW - 1 characters, whole or between separators, are read with a window of SHORT.
SHORT = 20
BRIEF = {"hex20": (CLASSES["hex"][0], 2.9, re.compile(r"[0-9a-fA-F]+")), "token": (CLASSES["token"][0], 3.75, re.compile(r"[0-9a-zA-Z]+")),
         "lower": (LOWER, 3.5, re.compile(r"[0-9a-z]+")), "upper": (UPPER, 3.5, re.compile(r"[0-9A-Z]+"))}
# Least numbers of digits, lower-case, upper-case characters and letters in a window.
NEEDS = {"token": (1, 1, 1, 2), "lower": (3, 3, 0, 3), "upper": (2, 0, 3, 3), "hex20": (3, 0, 0, 3)}
# Allow-list: identifiers that look random but open nothing, and placeholders.
ALLOWED = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}|sha(?:1|256|384|512)-[A-Za-z0-9+/]*=*|(?i:example|placeholder|your[_-]|xxxx|abcdefghij|0123456789)")

_RUNS = np.zeros(128, dtype=bool)
_RUNS[[ord(c) for c in RUN_CHARS]] = True


def runs(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of candidate characters that are long enough for any rule but ``assign``."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    member = np.zeros(len(points) + 2, dtype=np.int8)
    member[1:-1] = (points < 128) & _RUNS[np.minimum(points, 127)]
    edge = np.flatnonzero(np.diff(member))
    starts, ends = edge[::2], edge[1::2]
    long = ends - starts >= min(MIN_ACCESS, MIN_HEX, WINDOW)
    yield from zip(starts[long].tolist(), ends[long].tolist())


def random_parts(text: str, start: int, end: int, classes: dict[str, tuple] = CLASSES, window: int = WINDOW) -> list[tuple[int, int]]:
    """Unions of windows whose entropy reaches the threshold of a class that holds all their characters.

    Counts are carried from window to window: entropy = log2 W - sum(c log2 c) / W, and one character
    more or less changes one term of the sum. Most classes also ask for digits and letters (NEEDS),
    which words, paths and numbers lack.
    """
    weight = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]
    found: list[tuple[int, int]] = []
    for kind, (chars, least, *_) in classes.items():
        most = (math.log2(window) - least) * window  # the largest allowed sum of c log2 c
        counts: dict[str, int] = {}
        total, foreign = 0.0, 0
        for i in range(start, end):
            for c, step in ((text[i], 1), (text[i - window] if i - window >= start else "", -1)):
                if not c:
                    continue
                n = counts.get(c, 0)
                counts[c] = n + step
                total += weight[n + step] - weight[n]
                foreign += step * (c not in chars)
            if i - start + 1 >= window and not foreign and total <= most + 1e-9:
                if kind in NEEDS and not _holds(counts, NEEDS[kind]):
                    continue
                at = i - window + 1
                if found and found[-1][1] >= at and found[-1][0] <= at:
                    found[-1] = (found[-1][0], max(found[-1][1], i + 1))
                else:
                    found.append((at, i + 1))
    return _merged(found)


def _merged(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and merged[-1][1] >= a:
            merged[-1] = (merged[-1][0], max(merged[-1][1], b))
        else:
            merged.append((a, b))
    return merged


def _holds(counts: dict[str, int], need: tuple[int, int, int, int]) -> bool:
    digits = sum(n for c, n in counts.items() if c.isdigit())
    lower = sum(n for c, n in counts.items() if c.islower())
    upper = sum(n for c, n in counts.items() if c.isupper())
    return all(x >= least for x, least in zip((digits, lower, upper, lower + upper), need))


def entropy_parts(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Random parts of a run. Only windows that overlap an allow-listed match are left out, so the scan reads the gaps between the matches."""
    edges = [start, *(x for m in ALLOWED.finditer(text, start, end) for x in m.span()), end]
    found: list[tuple[int, int]] = []
    for a, b in zip(edges[::2], edges[1::2]):
        if b - a >= WINDOW:
            found += random_parts(text, a, b, LONG)
        elif b - a >= SHORT:
            found += random_parts(text, a, b, BRIEF, SHORT)
        for kind, rule in BRIEF.items():
            for m in rule[2].finditer(text, a, b):
                if SHORT <= m.end() - m.start() < WINDOW:
                    found += random_parts(text, m.start(), m.end(), {kind: rule}, SHORT)
    return _merged(found)


def find_secrets(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind. Offsets are code points, ends exclusive."""
    text = text or ""
    spans = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_VALUE]
    entropy = []
    for start, end in runs(text):
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text, start, end) if m.end() - m.start() >= MIN_ACCESS]
        spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text, start, end) if m.end() - m.start() >= MIN_HEX]
        entropy += entropy_parts(text, start, end)
    fixed = sorted((s, e) for s, e, _ in spans)
    starts, reach = [s for s, _ in fixed], list(accumulate((e for _, e in fixed), max))
    for a, b in entropy:  # only what no fixed pattern covers
        before = bisect_right(starts, a)
        if not before or reach[before - 1] < b:
            spans.append((a, b, "entropy"))
    return sorted(spans, key=lambda s: (s[0], KINDS[s[2]]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with every span (overlapping ones as one) replaced by ``[SECRET]``."""
    if not spans:
        return text
    out, at = [], 0
    for start, end, _ in sorted(spans):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``secret_spans`` array<struct<start, end, kind>>, ``n_assign``, ``n_access``,
    ``n_hex``, ``n_entropy``, ``base_sha256``, ``spans`` and ``redacted`` (the text with secrets masked).

    A null text is scanned as empty and stays null in ``redacted``. Columns of ``docs`` with one of
    these names are replaced. One pass, no shuffle; rows are independent.
    """
    added = T.StructType([
        T.StructField("secret_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                                                T.StructField("kind", T.StringType())]))),
        *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("redacted", T.StringType())])
    names = [f.name for f in added]

    def scan(texts: list[str | None]) -> dict[str, list]:
        found = [find_secrets(t) for t in texts]
        return {"secret_spans": [[{"start": s, "end": e, "kind": k} for s, e, k in f] for f in found],
                **{f"n_{kind}": [sum(k == kind for _, _, k in f) for f in found] for kind in KINDS},
                "base_sha256": [hashlib.sha256(joined([s for s in f if s[2] != "entropy"]).encode()).hexdigest() for f in found],
                "spans": [joined(f) for f in found],
                "redacted": [redacted(t, f) for t, f in zip(texts, found)]}

    return with_arrow(docs, docs[q(text)], added, scan)
