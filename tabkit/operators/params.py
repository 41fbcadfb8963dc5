"""Fitted parameters: a few numbers or category lists per column, never row-sized."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Params:
    """column -> statistic -> value."""

    values: dict[str, dict[str, object]]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """Long table (column, stat, value as JSON) for storage."""
        rows = [(c, s, json.dumps(v)) for c, stats in self.values.items() for s, v in stats.items()]
        return spark.createDataFrame(rows, "column string, stat string, value string")

    @classmethod
    def from_frame(cls, df: DataFrame) -> "Params":
        out: dict[str, dict[str, object]] = {}
        for r in df.collect():
            out.setdefault(r["column"], {})[r["stat"]] = json.loads(r["value"])
        return cls(out)
