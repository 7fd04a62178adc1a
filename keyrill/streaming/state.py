"""A per-key stateful step."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keyrill.operators.records import keyed

# The step travels to the executors with the query, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOTALS = "key string, total bigint, records bigint"


class RunningTotal(StatefulProcessor):
    """Keeps the total and the number of records of a key, and sends both after each micro-batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("totals", "total bigint, records bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        total, records = self.state.get() if self.state.exists() else (0, 0)
        for part in rows:
            total += int(part["total"].sum())
            records += int(part["records"].sum())
        self.state.update((total, records))
        yield pd.DataFrame({"key": [key[0]], "total": [total], "records": [records]})

    def close(self) -> None:
        pass


def partial_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum each Arrow batch by key, so that a hot key reaches its one stateful task as a row per batch."""
    for batch in batches:
        sums = pa.Table.from_batches([batch]).group_by("key").aggregate([("amount", "sum"), ("amount", "count")])
        columns = {"key": "key", "amount_sum": "total", "amount_count": "records"}
        renamed = pa.table({new: sums.column(old) for old, new in columns.items()})
        yield from renamed.combine_chunks().to_batches()


def stateful_totals(stream: DataFrame, amount: Column) -> DataFrame:
    """Total and count of a bigint amount per key, one row per key and micro-batch."""
    rows = keyed(stream).select("key", amount.cast("bigint").alias("amount"))
    partial = rows.where("amount is not null").mapInArrow(partial_totals, TOTALS)
    return partial.groupBy("key").transformWithStateInPandas(RunningTotal(), TOTALS, "update", "none")
