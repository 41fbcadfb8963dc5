"""Distance work between rows of one table, without a cross join and without stored pairs.

Points are assigned to the nearest of a bounded set of pivots. A point y can only lie within
``eps`` of a point whose nearest pivot is p when d(y, p) <= d(y, nearest pivot) + 2 eps, so y is
also sent to those pivots and nothing else needs comparing. Where eps is so large that a point would go to
more than ``SPREAD`` cells there are no cells, and all rows are compared. Cells that hold many points are
cut into blocks of at most ``BLOCK`` numbers on both sides; a task compares two blocks piece by piece and returns
per-row totals or a spanning forest of the two blocks. Without cells there are ``SPREAD`` blocks a side until a block is
full, so that a row is sent to a fixed number of tasks, whatever the size of the table. Copies of a vector are counted
once with their weight.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.runtime import col, cut_lineage

BLOCK = 1 << 22  # numbers in the vectors of a block: 65,536 rows of 64 columns
MOST_ROWS = 65_536
PIECE = 1_024  # rows compared at once on both sides
FOLD = 1 << 17  # rows of partial results that a task folds together
SPREAD = 8
ROWS_PER_PIVOT = 2_048
MAX_PIVOTS = 16_384
SLACK = 1e-9
DIRECT_DIMS = 8
REFINED = 1 << 16  # pairs that are computed again at once


def as_points(df: DataFrame, key: str, cols: list[str] | None = None, vec: str | None = None) -> DataFrame:
    """(id, vec) of rows whose coordinates are all present."""
    v = col(vec).cast("array<double>") if vec else F.array(*[col(c).cast("double") for c in cols])
    rows = df.select(col(key).alias("id"), v.alias("vec"))
    return rows.where(F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull()))


def distinct_points(points: DataFrame) -> DataFrame:
    """One row per distinct vector: smallest id and number of copies ``w``."""
    return points.groupBy("vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("w")).select("id", "vec", "w")


def square_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    if x.shape[1] <= DIRECT_DIMS:
        out = np.zeros((len(x), len(y)))
        for k in range(x.shape[1]):
            out += np.square(x[:, k, None] - y[None, :, k])
        return out
    out = np.square(x).sum(1)[:, None] + np.square(y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.maximum(out, 0.0)


def within(x: np.ndarray, y: np.ndarray, eps: float) -> np.ndarray:
    """Boolean matrix d(x, y) <= eps; entries near the limit are computed again by differences."""
    return within_each(x, y, [eps])[0]


def within_each(x: np.ndarray, y: np.ndarray, radii: list[float]) -> list[np.ndarray]:
    """``within`` for several radii. More than ``DIRECT_DIMS`` columns are multiplied in 4-byte numbers where their error allows it."""
    if x.shape[1] <= DIRECT_DIMS:
        d2 = square_distances(x, y)
        sure = 1e-11 * (np.square(x).sum(1).max(initial=0.0) + np.square(y).sum(1).max(initial=0.0))
        masks = [(d2 < eps * eps, np.abs(d2 - eps * eps) <= sure + 1e-11 * eps * eps) for eps in radii]
    else:
        close, error = closeness(x, y, min(radii) ** 2 / 64)
        masks = []
        for eps in radii:
            slack = error + 4 * np.finfo(close.dtype).eps * eps * eps
            out, maybe = close > slack - eps * eps / 2, close >= -slack - eps * eps / 2
            masks.append((out, out != maybe if np.count_nonzero(out) != np.count_nonzero(maybe) else None))
    for (out, near), eps in zip(masks, radii):
        i, j = places(near) if near is not None else ((), ())
        for at in range(0, len(i), REFINED):
            some = slice(at, at + REFINED)
            out[i[some], j[some]] = np.sqrt(np.square(x[i[some]] - y[j[some]]).sum(1)) <= eps
    return [out for out, _ in masks]


def places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.nonzero`` of a mask that is mostly false."""
    flat = mask.ravel()
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64) != 0)
    word, byte = np.nonzero(flat[:whole].reshape(-1, 8)[words])
    return np.divmod(np.append(words[word] * 8 + byte, np.flatnonzero(flat[whole:]) + whole), max(1, mask.shape[1]))


def closeness(x: np.ndarray, y: np.ndarray, error: float) -> tuple[np.ndarray, float]:
    """(-d(x, y)^2 / 2 as one product of matrices, a bound on its error): in 4-byte numbers if that bound is at most ``error``. Rows that are not
    finite are close to nothing."""
    dims = x.shape[1]
    with np.errstate(all="ignore"):
        centre = y[:PIECE].mean(0) if len(y) else np.zeros(dims)
        centre = np.where(np.isfinite(centre), centre, 0.0)
        halves = [np.square(v - centre).sum(1) / 2 for v in (x, y)]
    finite = [np.isfinite(h) for h in halves]
    most = sum(float(h.max(initial=0.0, where=f)) for h, f in zip(halves, finite))
    bounds = {kind: (dims + 8) * float(np.finfo(kind).eps) * most for kind in (np.float32, np.float64)}
    kind = np.float32 if most < 1e37 and bounds[np.float32] <= error else np.float64
    sides = []
    for v, h, f, at in zip((x, y), halves, finite, (dims, dims + 1)):
        side = np.ones((len(v), dims + 2), dtype=kind)
        side[:, :dims] = v - centre
        side[:, at] = -h
        side[~f] = 0
        sides.append(side)
    close = sides[0] @ sides[1].T
    close[~finite[0]] = -np.inf
    close[:, ~finite[1]] = -np.inf
    return close, bounds[kind]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def choose_pivots(points: DataFrame, rows_per_pivot: int | None = None, eps: float | None = None) -> np.ndarray:
    """Pivots for a search within ``eps``. Unless their number is asked for there are fewer or none where a row of a sample would go to more than
    ``SPREAD`` cells or half of them on the average: cells that do not part the rows only make copies, and fewer tasks than no cells."""
    n = points.count()
    wanted = min(MAX_PIVOTS, n // (rows_per_pivot or ROWS_PER_PIVOT))
    if wanted < 2:
        return np.zeros((0, 0))
    one_in = max(1, n // (2 * wanted))
    place = F.xxhash64("id", F.lit(11))  # the smallest hashes: the same pivots in every run
    picked = points.where(F.pmod(F.xxhash64("id"), F.lit(one_in)) == 0).orderBy(place, "id").select("vec").limit(wanted).toPandas()
    pivots = _matrix(picked["vec"]) if len(picked) else np.zeros((0, 0))
    if eps is None or rows_per_pivot or len(pivots) < 2:
        return pivots
    seen = points.where(F.pmod(F.xxhash64("id", F.lit(13)), F.lit(max(1, n // PIECE))) == 0).select("vec").limit(2 * PIECE).toPandas()
    seen = _matrix(seen["vec"]) if len(seen) else pivots[:1]
    while len(pivots) >= 2:
        if sum(map(len, _cells(seen, pivots, 2.0 * eps))) <= min(SPREAD, len(pivots) / 2) * len(seen):
            return pivots
        pivots = pivots[:len(pivots) // 4]
    return np.zeros((0, 0))


def _cells(x: np.ndarray, pivots: np.ndarray, reach: float | None) -> list[np.ndarray]:
    """Per row its nearest pivot, and with a reach every pivot within it of that distance."""
    out = []
    for at in range(0, len(x), 256):
        d = np.sqrt(square_distances(x[at:at + 256], pivots))
        if reach is None:
            out += list(d.argmin(axis=1).astype("int32")[:, None])
            continue
        nearest = d.min(axis=1, keepdims=True)
        out += [np.flatnonzero(r).astype("int32") for r in d <= nearest + reach + SLACK * (1.0 + nearest)]
    return out


def _assign(rows: DataFrame, pivots: np.ndarray, reach: float | None) -> DataFrame:
    """Add ``cell``: the nearest pivot, and every further pivot within ``reach`` of that distance."""
    if len(pivots) < 2:
        return rows.withColumn("cell", F.lit(0))
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def cells(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(cell=_cells(_matrix(pdf["vec"]), shared.value, reach))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(cells, f"{kinds}, cell array<int>").withColumn("cell", F.explode("cell"))


class Piece:
    """Some rows of a block: their columns, and their vectors as a matrix."""

    def __init__(self, rows: pa.Table) -> None:
        flat = rows.column("vec").combine_chunks()
        self.vec = np.asarray(flat.flatten(), dtype=float).reshape(rows.num_rows, -1)
        self.rows = rows.drop_columns(["vec"]).to_pandas()

    def __getitem__(self, name: str) -> pd.Series:
        return self.rows[name]


def _pieces(rows: pa.Table) -> list[Piece]:
    return [Piece(rows.slice(at, PIECE)) for at in range(0, rows.num_rows, PIECE)]


def compare_blocks(home: DataFrame, others: DataFrame, pivots: np.ndarray, eps: float, fn: Callable[[Piece, Piece], pd.DataFrame], schema: str,
                   block: int | None = None, merge: Callable[[pd.DataFrame], pd.DataFrame] | None = None, whole: bool = False) -> DataFrame:
    """Run ``fn(home piece, other piece)`` on pieces that together cover all pairs within eps.

    ``merge`` folds results of pieces of the same two blocks into fewer rows that say the same. With ``whole`` it is ``fn(home pieces, other pieces)``
    for all pieces of two blocks. ``block`` asks for blocks of that many rows.
    """
    others = others.select(*[F.col(c).alias(c) for c in others.columns])  # its own columns, also when it is the same table
    a = _assign(home, pivots, None)
    b = _assign(others, pivots, 2.0 * eps)

    def blocks_of(n: str) -> Column:
        most = F.least(F.lit(MOST_ROWS), F.greatest(F.lit(PIECE), F.floor(F.lit(BLOCK) / F.greatest("dims", F.lit(1)))))
        if len(pivots) < 2:
            most = F.least(most, F.greatest(F.lit(PIECE), F.ceil(F.col(n) / SPREAD)))
        return F.ceil(F.col(n) / (F.lit(block) if block else most)).cast("int")
    # at most MAX_PIVOTS rows
    plan = (a.groupBy("cell").agg(F.count(F.lit(1)).alias("na"), F.max(F.size("vec")).alias("dims"))
            .join(b.groupBy("cell").agg(F.count(F.lit(1)).alias("nb")), "cell")
            .select("cell", blocks_of("na").alias("ka"), blocks_of("nb").alias("kb")))
    plan = cut_lineage(plan)
    session = plan.sparkSession
    most_tasks = max(4 * session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    tasks = max(1, min(most_tasks, plan.agg(F.sum(F.col("ka").cast("long") * F.col("kb"))).first()[0] or 0))
    plan = F.broadcast(plan)

    def blocks(rows, mine, theirs, i, j):
        own = F.pmod(F.xxhash64("id", F.lit(7)), F.col(mine)).cast("int")
        return (rows.join(plan, "cell").withColumn(i, own)
                .withColumn(j, F.explode(F.sequence(F.lit(0), F.col(theirs) - 1))).drop("ka", "kb")
                .repartition(tasks, "cell", "i", "j"))  # few bytes can be much work, so tasks are not merged by size
    left, right = blocks(a, "ka", "kb", "i", "j"), blocks(b, "kb", "ka", "j", "i")
    shape = a.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(shape)

    def compare(x: pa.Table, y: pa.Table) -> pa.Table:
        found, rows, folded = [], 0, 0
        if whole and x.num_rows and y.num_rows:
            found.append(fn(_pieces(x), _pieces(y)))
        elif x.num_rows and y.num_rows:
            ys = _pieces(y)
            for at in range(0, x.num_rows, PIECE):
                one = Piece(x.slice(at, PIECE))
                for other in ys:
                    found.append(fn(one, other))
                    rows += len(found[-1])
                    if merge and rows > 2 * folded + FOLD:
                        found = [merge(pd.concat(found, ignore_index=True))]
                        rows = folded = len(found[0])
        if not found:
            return arrow.empty_table()
        all_ = pd.concat(found, ignore_index=True)
        return pa.Table.from_pandas(merge(all_) if merge else all_, arrow, preserve_index=False)
    return left.groupBy("cell", "i", "j").cogroup(right.groupBy("cell", "i", "j")).applyInArrow(compare, shape)


def summed(keys: list[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A merge that adds up all other columns."""
    return lambda parts: parts.groupby(keys, as_index=False, sort=False).sum()


def neighbour_counts(points: DataFrame, radii: list[float], pivots: np.ndarray, block: int | None = None, home: DataFrame | None = None) -> DataFrame:
    """(id, n): total weight of ``points`` within each radius (array in the order of ``radii``) of each of them, or of each of ``home``; the point
    itself included."""
    names = [f"n{i}" for i in range(len(radii))]

    def count(xs: list[Piece], ys: list[Piece]) -> pd.DataFrame:
        found = []
        for x in xs:
            n = np.zeros((len(radii), len(x.vec)), dtype=np.int64)
            for y in ys:
                w = y["w"].to_numpy(dtype="int64")
                for total, near in zip(n, within_each(x.vec, y.vec, radii)):
                    total += _weight(near, w)
            found.append(pd.DataFrame({"id": x["id"], **dict(zip(names, n))}))
        return pd.concat(found, ignore_index=True)
    kind = points.schema["id"].dataType.simpleString()
    schema = ", ".join([f"id {kind}", *[f"{n} long" for n in names]])
    parts = compare_blocks(points if home is None else home, points, pivots, max(radii), count, schema, block, whole=True)
    return parts.groupBy("id").agg(F.array(*[F.sum(n) for n in names]).alias("n"))


def _weight(near: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Total weight in each row."""
    total = np.bitwise_count(np.packbits(near, axis=1)).sum(axis=1, dtype=np.int64)
    more = np.flatnonzero(w != 1)
    return total + np.rint(near[:, more].astype(float) @ (w[more] - 1.0)).astype(np.int64) if len(more) else total


def radius_counts(df: DataFrame, key: str, eps: float, cols: list[str] | None = None, vec: str | None = None,
                  rows_per_pivot: int | None = None, block: int | None = None) -> DataFrame:
    """How many rows lie within eps of each row, itself included."""
    points = as_points(df, key, cols, vec)
    single = cut_lineage(distinct_points(points))
    counts = neighbour_counts(single, [eps], choose_pivots(single, rows_per_pivot, eps), block)
    known = single.join(counts, "id").select("vec", F.col("n")[0].alias("n"))
    return points.join(known, "vec").select(F.col("id").alias(key), F.col("n").alias("n_neighbours"))


def k_distance(df: DataFrame, key: str, k: int, cols: list[str] | None = None, vec: str | None = None,
               rows_per_pivot: int | None = None, block: int | None = None) -> DataFrame:
    """Distance to the k-th nearest row, counting the row itself (distance 0).

    Rows with fewer than k neighbours inside the search radius go on to the next round with a
    doubled radius, so the result is exact whatever the starting radius. Without cells all rows are
    compared anyway, and one round without a radius does.
    """
    points = as_points(df, key, cols, vec)
    single = cut_lineage(distinct_points(points))
    total = single.agg(F.sum("w")).first()[0] or 0
    if total < k:
        raise ValueError(f"{total} rows have no {k}-th neighbour")
    radius = _first_radius(single, k)
    kind = points.schema["id"].dataType.simpleString()
    todo, found = single, []
    while True:
        pivots = choose_pivots(single, rows_per_pivot, radius)
        if len(pivots) < 2:
            radius = float("inf")
        parts = compare_blocks(todo, single, pivots, radius, _nearest(k, radius), f"id {kind}, d double, w bigint", block, whole=True)
        merged = parts.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("d", "w"))).alias("near"))
        enough = F.aggregate("near", F.lit(0).cast("long"), lambda s, x: s + x["w"]) >= k
        step = cut_lineage(merged.select("id", F.when(enough, _kth(k)).alias("d")))
        found.append(step.where("d is not null"))
        rest = step.where("d is null").select("id")
        if rest.isEmpty():
            break
        todo = cut_lineage(todo.join(rest, "id", "left_semi"))
        radius *= 2.0
    done = found[0]
    for f in found[1:]:
        done = done.unionByName(f)
    known = single.join(done, "id").select("vec", "d")
    return points.join(known, "vec").select(F.col("id").alias(key), F.col("d").alias("k_distance"))


def _kth(k: int):
    """Smallest distance whose cumulated weight reaches k, from the sorted array ``near``."""
    start = F.struct(F.lit(0).cast("long").alias("s"), F.lit(None).cast("double").alias("d"))
    last = F.aggregate("near", start, lambda acc, x: F.struct(
        (acc["s"] + x["w"]).alias("s"),
        F.when(acc["s"] < k, x["d"]).otherwise(acc["d"]).alias("d")))
    return last["d"]


def _nearest(k: int, radius: float):
    """(id, d, w) of the nearest vectors in a block until their weight is k, as far as they lie within the radius. What is farther than the k-th
    nearest vector of the pieces before is passed over."""
    first = _first_of(k)

    def nearest(xs: list[Piece], ys: list[Piece]) -> pd.DataFrame:
        found = []
        for x in xs:
            n = len(x.vec)
            limit = np.full(n, radius)
            best_d, best_w = np.full((n, k), np.inf), np.zeros((n, k), dtype=np.int64)
            for y in ys:
                i, j = _not_farther(x.vec, y.vec, limit, k)
                d = np.concatenate([np.sqrt(np.square(x.vec[i[at:at + REFINED]] - y.vec[j[at:at + REFINED]]).sum(1)) for at in range(0, max(1, len(i)), REFINED)])
                keep = d <= limit[i]
                if not keep.any():
                    continue
                i, d, w = i[keep], d[keep], y["w"].to_numpy(dtype="int64")[j[keep]]
                rows = np.unique(i)
                at = np.concatenate([np.repeat(rows, k), i])
                d, w = np.concatenate([best_d[rows].ravel(), d]), np.concatenate([best_w[rows].ravel(), w])
                order = np.lexsort((d, at))
                at, d, w = at[order], d[order], w[order]
                rank = np.arange(len(at)) - np.searchsorted(at, at)
                top = rank < k
                best_d[at[top], rank[top]], best_w[at[top], rank[top]] = d[top], w[top]
                limit[rows] = np.minimum(limit[rows], best_d[rows, k - 1])
            i, j = np.nonzero(best_w > 0)
            found.append(pd.DataFrame({"id": x["id"].to_numpy()[i], "d": best_d[i, j], "w": best_w[i, j]}))
        return first(pd.concat(found, ignore_index=True))
    return nearest


def _not_farther(x: np.ndarray, y: np.ndarray, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that hold the nearest ``k`` rows of ``y`` of each row of ``x``, as far as they are not farther than the row's ``limit``."""
    if x.shape[1] <= DIRECT_DIMS:
        d2 = square_distances(x, y)
        close, error = np.negative(d2 / 2), 0.0
    else:
        known = np.square(limit[np.isfinite(limit)])
        close, error = closeness(x, y, float(np.median(known)) / 64 if len(known) else np.inf)
    open_ = np.flatnonzero(np.isinf(limit))
    least = -np.square(limit) / 2
    if len(open_) and len(y) > k:
        least[open_] = np.partition(close[open_], len(y) - k, axis=1)[:, len(y) - k] - 2 * error
    slack = error + 1e-6 * np.abs(np.where(np.isfinite(least), least, 0.0))
    return places(close >= (least - slack).astype(close.dtype)[:, None])


def _first_of(k: int):
    """A merge that keeps the nearest vectors of an id until their weight reaches k."""
    def first(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values(["id", "d"], ignore_index=True)
        before = parts.groupby("id")["w"].cumsum() - parts["w"]
        return parts[before < k]
    return first


def _first_radius(single: DataFrame, k: int) -> float:
    """Typical k-th distance in a small sample, shrunk to the density of the whole table."""
    n = single.count()
    size = 1_000
    sample = single.where(F.pmod(F.xxhash64("id"), F.lit(max(1, n // size))) == 0).select("vec").limit(2 * size).toPandas()
    x = _matrix(sample["vec"]) if len(sample) else np.zeros((0, 1))
    if len(x) <= k:
        return 1.0
    kth = np.sqrt(np.partition(square_distances(x, x), min(k, len(x) - 1), axis=1)[:, min(k, len(x) - 1)])
    radius = float(np.quantile(kth, 0.9)) * (len(x) / n) ** (1.0 / x.shape[1])
    return radius if radius > 0 else 1.0


def components(edges: DataFrame) -> DataFrame:
    """(id, root): smallest id reachable over undirected edges (u, v), for ids that have an edge.

    Alternates the large-star and small-star steps; each round is written to the checkpoint
    folder. Hubs only take part in aggregates and in joins against one row per id.
    """
    links = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = (both.join(low, both["u"] == low["x"]).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        least = large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        small = (large.join(least, large["u"] == least["x"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select(F.col("x").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct())
        links = cut_lineage(small)
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            return links.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
                links.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
        mark = now
