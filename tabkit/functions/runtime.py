"""Session helpers: reliable checkpoints and small shared utilities."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


MIN_ROWS_PER_PARTITION, MAX_ROWS_PER_PARTITION = 25_000, 500_000
BROADCAST_ROWS = 10_000


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors, unless their Python path (taken over from the driver's environment) has it."""
    root = Path(__file__).resolve().parents[2]
    paths = [Path(p or ".").resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if root in paths or str(root) in spark.conf.get("spark.tabkit.shipped", ""):
        return
    archive = Path(tempfile.mkdtemp(prefix="tabkit-package-")) / "tabkit.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted([*(root / "tabkit").rglob("*.py"), *root.glob("corpus_pipeline.py")]):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    spark.conf.set("spark.tabkit.shipped", str(root))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the session names; only a local session may make its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tabkit-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike a local one."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def kept(df: DataFrame):
    """Persisted rows for work that passes over them many times. Rows that sit in fewer partitions than there are cores, or in
    partitions so large that what a task holds grows with the table, are spread first."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    n, largest = df.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
    n, largest = n or 0, largest or 0
    wanted = min(cores, 1 + n // MIN_ROWS_PER_PARTITION)
    if largest > MAX_ROWS_PER_PARTITION:  # never kept in the large partitions: whatever reads those holds too much
        wanted = max(cores, -(-2 * n // MAX_ROWS_PER_PARTITION))
        df = df.repartition(wanted)
    held = [df.persist()]
    try:
        held[0].count()
        have = held[0].rdd.getNumPartitions()
        if have < wanted:
            held.append(held[0].repartition(wanted).persist())
        elif have > wanted and n < cores * MIN_ROWS_PER_PARTITION:
            held.append(held[0].coalesce(wanted).persist())
        yield held[-1]
    finally:
        for h in held:
            h.unpersist()


def bounded(df: DataFrame, cap: int = BROADCAST_ROWS) -> DataFrame:
    """The lookup side of a join: written once and counted, broadcast when it is small, and
    otherwise joined as Spark sees fit (adaptive execution splits hot keys)."""
    table = cut_lineage(df)
    return F.broadcast(table) if table.count() <= cap else table


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder next to the checkpoints, readable by every executor."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


_scratch: list[str] = []


@contextmanager
def temporary_scratch(spark: SparkSession):
    """Delete the scratch folders made inside, once what was computed from them has been written elsewhere."""
    before = len(_scratch)
    try:
        yield
    finally:
        while len(_scratch) > before:
            delete_path(spark, _scratch.pop())


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def all_of(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def any_of(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def same_keys(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]]) -> Column:
    """Null-safe equality on (left column, right column) pairs."""
    return all_of([left[a].eqNullSafe(right[b]) for a, b in keys])


def q(name: str) -> str:
    """Quote a column name so that spaces, dots and brackets are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


def rows_from(structs: list[Column]) -> Column:
    """Turn the structs of a one-row aggregate into one output row each."""
    return F.inline(F.array(*structs))


def unit_position(keys: list[str], seed: int = 0) -> Column:
    """Uniform integer in [0, 2**52) derived from the key columns, exact as a double.

    The same key always gets the same position, whatever the partitioning or the engine.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")


UNIT_RANGE = float(2**52)
