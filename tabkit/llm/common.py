"""What the text operators share: words, staged tables, row positions that survive a lost executor."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.runtime import q, scratch_path

SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared scratch folder and read them back: computed once, short
    lineage, and the same rows in the same files however often a task is repeated."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Runs of anything but space and \\x09-\\x0D; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def byte_words(text: str | None, lower: bool = False) -> list[bytes]:
    """The same words as UTF-8: bytes split at exactly those six characters, and lower-case only A-Z."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def give_back() -> None:
    """Return what a task has freed to the system, so that a worker that waits for its next task does not hold its last one's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (an invertible finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=np.uint64).view(np.int64)


def unsigned(x) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=np.int64).view(np.uint64)


def packed(df: DataFrame, names: list[str]) -> Column:
    """The caller's columns as one struct, so that no name of theirs meets one of ours on the way."""
    return F.struct(*[df[q(n)].alias(n) for n in names] or [F.lit(0).alias("none")]).alias("rest")


def unpacked(names: list[str]) -> list[Column]:
    return [F.col("rest")[n].alias(n) for n in names]


def with_arrow(df: DataFrame, source: Column, added: T.StructType, fn: Callable[[list], dict[str, list]], rows: int = 2_000) -> DataFrame:
    """``df`` plus the columns that ``fn`` computes from the source values, given and returned as lists.

    Other columns pass through as they are: no null turns a number into a float. Columns of ``df`` with an added name are
    replaced. ``fn`` sees ``rows`` rows at a time.
    """
    keep = [c for c in df.columns if c not in added.names]
    base = df.select(packed(df, keep), source.alias("source"))
    schema = T.StructType([base.schema["rest"], *added])
    target, names = [(f.name, f.dataType) for f in added], schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                new = fn(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(new[n], to_arrow_type(t)) for n, t in target]], names=names)
        whole = batch = new = None
        give_back()

    return base.mapInArrow(run, schema).select(*unpacked(keep), *added.names)
