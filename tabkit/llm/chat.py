"""Chat formatting: minimum-cost repair of the roles, then rendering.

Legal conversations are an optional system turn, then user and assistant turns in alternation, the last one of the assistant. Every input turn is
kept, given another role, merged into the turn before it, or preceded by an empty turn; dynamic programming over the states "last
open turn" finds the cheapest way. The cost of a stretch of turns is a 4 x 4 matrix in (min, +), so long conversations are solved in segments:
their matrices first, then the states at the segment borders, then each segment by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import in_order, row_number
from .common import staged

SEGMENT = 10_000
ROWS_PER_TASK = 5_000
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = ["", "system", "user", "assistant"]
# Other names of the roles, the legal next turns, and the costs. Among equal costs the earlier action of ACTIONS wins.
SYNONYMS = {"system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "prompter": USER, "assistant": ASSISTANT, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
UNKNOWN = 0
ACTIONS = ["keep", "merge", "relabel", "insert"]
MERGE_SAME, MERGE_OTHER, RELABEL, RELABEL_UNKNOWN, INSERT = 1, 3, 2, 1, 2
NEVER = 10**9


def _moves(role: int) -> list[list[tuple[int, int, int] | None]]:
    """For a turn of this role: from state to state the cheapest (cost, action, inserted role)."""
    out: list[list[tuple[int, int, int] | None]] = [[None] * 4 for _ in range(4)]

    def offer(s: int, t: int, cost: int, action: int, inserted: int) -> None:
        if out[s][t] is None or (cost, action) < out[s][t][:2]:
            out[s][t] = (cost, action, inserted)
    for s in range(4):
        if s != START:
            offer(s, s, MERGE_SAME if role in (s, UNKNOWN) else MERGE_OTHER, 1, 0)
        for via, price in [(0, 0), *((p, INSERT) for p in LEGAL[s])]:
            for t in LEGAL[via or s]:
                change = 0 if t == role else RELABEL_UNKNOWN if role == UNKNOWN else RELABEL
                offer(s, t, price + change, 3 if via else 2 if change else 0, via)
    return out


MOVES = [_moves(r) for r in range(4)]
COSTS = np.array([[[NEVER if m is None else m[0] for m in row] for row in moves] for moves in MOVES])
CLOSING = {START: NEVER, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}  # empty turns after the last one


def stretch(roles: list[int]) -> np.ndarray:
    """Cheapest cost from state to state over these turns."""
    cost = np.where(np.eye(4, dtype=bool), 0, NEVER)
    for r in roles:
        cost = np.minimum((cost[:, :, None] + COSTS[r][None]).min(axis=1), NEVER)
    return cost


def best_path(roles: list[int], entry: int, leave: int) -> list[tuple[int, int, int]]:
    """(state after, action, inserted role) per turn on the cheapest way between the two states."""
    cost, back = [NEVER] * 4, []
    cost[entry] = 0
    for r in roles:
        new, how = [NEVER] * 4, [0] * 4
        for t in range(4):
            for s in range(4):
                m = MOVES[r][s][t]
                if m is not None and cost[s] + m[0] < new[t]:
                    new[t], how[t] = cost[s] + m[0], s
        back.append(how)
        cost = new
    path, state = [], leave
    for r, how in zip(reversed(roles), reversed(back)):
        before = how[state]
        _, action, inserted = MOVES[r][before][state]
        path.append((state, action, inserted))
        state = before
    return path[::-1]


def borders(matrices: list[np.ndarray]) -> tuple[int, list[tuple[int, int]]]:
    """The cost of the whole conversation and (entry, exit) of its segments."""
    costs, cost = [], np.full(4, NEVER)
    cost[START] = 0
    for m in matrices:
        costs.append(cost)
        cost = np.minimum((cost[:, None] + m).min(axis=0), NEVER)
    ends = [int(cost[s]) + CLOSING[s] for s in range(4)]
    total, state, out = min(ends), int(np.argmin(ends)), []
    for m, before in zip(reversed(matrices), reversed(costs)):
        entry = int(np.argmin(before + m[:, state]))
        out.append((entry, state))
        state = entry
    return total, out[::-1]


def _groups(pdf: pd.DataFrame, keys: list[str], order: str) -> Iterator[pd.DataFrame]:
    """A task holds the rows of many groups: one frame each, in order."""
    pdf = pdf.sort_values([*keys, order], ignore_index=True)
    new = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy().nonzero()[0].tolist()
    for a, b in zip(new, [*new[1:], len(pdf)]):
        yield pdf.iloc[a:b]


def _matrices(pdf: pd.DataFrame) -> pd.DataFrame:
    out = [(g["key"].iat[0], g["segment"].iat[0], stretch(g["code"].tolist()).ravel().tolist()) for g in _groups(pdf, ["key", "segment"], "pos")]
    return pd.DataFrame(out, columns=["key", "segment", "matrix"])


def _borders(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for g in _groups(pdf, ["key"], "segment"):
        total, ends = borders([np.array(m).reshape(4, 4) for m in g["matrix"]])
        rows += [(k, s, entry, leave, i == len(ends) - 1, total) for i, (k, s, (entry, leave)) in enumerate(zip(g["key"], g["segment"], ends))]
    return pd.DataFrame(rows, columns=["key2", "segment2", "entry", "leave", "last", "total"])


def _solve(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for g in _groups(pdf, ["key", "segment"], "pos"):
        rows += _render(g["code"].tolist(), g["row"].tolist(), g["pos"].tolist(), g["text"].tolist(), int(g["entry"].iat[0]), int(g["leave"].iat[0]),
                        bool(g["last"].iat[0]), int(g["total"].iat[0]))
    return pd.DataFrame(rows, columns=["row", "pos", "part", "action", "new_role", "fragment", "total"])


def _opened(role: int, text: str, first: bool) -> str:
    return ("" if first else "<|im_end|>\n") + f"<|im_start|>{NAMES[role]}\n{text}"


def _render(codes: list[int], ids: list[int], places: list[int], texts: list[str], entry: int, leave: int, last: bool, total: int) -> list[tuple]:
    """(row, pos, part, action, role, fragment, total) of a segment; only merges and insertions are named here."""
    rows, before = [], entry
    for (state, action, inserted), row, pos, text in zip(best_path(codes, entry, leave), ids, places, texts):
        if inserted:
            rows.append((row, pos, 0, "insert", NAMES[inserted], _opened(inserted, "", before == START), total))
            before = inserted
        merged = ACTIONS[action] == "merge"
        rows.append((row, pos, 1, "merge" if merged else None, NAMES[state], "\n" + text if merged else _opened(state, text, before == START), total))
        before = state
    if last:
        for role in {SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,)}.get(before, ()):
            rows.append((ids[-1], places[-1], 1 + role, "insert", NAMES[role], _opened(role, "", False), total))
        rows[-1] = (*rows[-1][:5], rows[-1][5] + "<|im_end|>\n", total)
    return rows


def repair_roles(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """The repaired conversations, one row per piece: the conversation, ``turn`` and ``role`` as they came (null for inserted turns),
    ``pos`` (place of the input turn, from 1), ``part`` (order within it: 0 inserted before, 1 the turn itself, 3 and more inserted at the end), ``action``
    (keep, merge, relabel or insert), ``new_role``, ``fragment`` and ``total_cost``. The fragments in order of pos and part are the rendered conversation.

    Turns are ordered by number, null numbers last; equal ones in the order they are read. Unknown or null roles may become any role. A null text
    is empty. Rows with a null conversation form one conversation. Repeated rows are turns like others. Extra columns are not carried.
    """
    code = F.create_map(*[F.lit(x) for kv in SYNONYMS.items() for x in kv])[F.lower(F.trim(F.col("role")))]
    rows = turns.select(turns[conv_id].alias("conv"), turns[turn].alias("turn"), turns[role].alias("role"), F.coalesce(turns[text], F.lit("")).alias("text"))
    rows = staged(rows.select(
        "*", F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("turn").cast("long"), F.lit(2**63 - 1)).alias("at"),
        F.when(F.col("conv").isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col("conv").cast("string"))).alias("key"),
        F.coalesce(code, F.lit(UNKNOWN)).alias("code")), "turns")
    placed = staged(in_order(rows.select("key", "at", "row", "code"), ["key"], ["at", "row"], {"pos": row_number()})
                    .withColumn("segment", F.floor((F.col("pos") - 1) / segment)).select("key", "row", "code", "pos", "segment"), "placed-turns")
    slots = F.lit(max(1, placed.count() // ROWS_PER_TASK))
    matrices = placed.groupBy(F.pmod(F.xxhash64("key", "segment"), slots)).applyInPandas(_matrices, "key string, segment long, matrix array<long>")
    ends = staged(matrices.groupBy(F.pmod(F.xxhash64("key"), slots)).applyInPandas(
        _borders, "key2 string, segment2 long, entry int, leave int, last boolean, total long"), "segment-borders")
    full = placed.join(rows.select(F.col("row").alias("row2"), "text"), F.col("row") == F.col("row2"))
    full = full.join(ends, (F.col("key") == F.col("key2")) & (F.col("segment") == F.col("segment2")))
    solved = full.select("key", "segment", "row", "pos", "code", "text", "entry", "leave", "last", "total").groupBy(
        F.pmod(F.xxhash64("key", "segment"), slots)).applyInPandas(
        _solve, "row long, pos long, part int, action string, new_role string, fragment string, total long")
    named = rows.select(F.col("row").alias("row2"), "conv", "turn", "role", F.col("code").alias("was"))
    mine = F.col("part") == 1
    names = F.create_map(*[F.lit(x) for kv in {n: i for i, n in enumerate(NAMES) if n}.items() for x in kv])
    action = F.coalesce("action", F.when(names[F.col("new_role")] == F.col("was"), "keep").otherwise("relabel"))
    return solved.join(named, F.col("row") == F.col("row2")).select(
        F.col("conv").alias(conv_id), F.when(mine, F.col("turn")).alias(turn), F.when(mine, F.col("role")).alias(role), "pos", "part",
        action.alias("action"), "new_role", "fragment", F.col("total").alias("total_cost"))
