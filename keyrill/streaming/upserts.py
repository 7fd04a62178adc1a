"""Tables fed by streams: every micro-batch adds its changed rows, readers see the newest row of each key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyrill.folders import exists
from keyrill.operators.tables import newest_rows


def newest(changes: DataFrame, keys: Sequence[str], by: str = "batch") -> DataFrame:
    return newest_rows(changes, keys, (by,)).drop(by)


@dataclass(frozen=True)
class UpsertTable:
    """A table below `path`, with at most one row per key in each batch.

    A batch writes its own folder, `changes/batch=<n>`, and may write it again.
    """

    path: str
    keys: tuple[str, ...]

    def write_changes(self, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/changes/batch={batch}")

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The table after all batches written; empty if there was none."""
        if not exists(spark, f"{self.path}/changes"):
            return spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        return newest(spark.read.schema(stored).parquet(f"{self.path}/changes"), self.keys)
