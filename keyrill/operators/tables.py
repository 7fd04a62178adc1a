"""Tables derived from keyed upserts, and the change streams of such tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyrill.operators.records import keyed


def newest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in the given order.

    Spark limits the rows of a key before the shuffle as well as after, so a hot key costs one row per map task. This is
    faster than `max_by`, whose buffers of text or structs rule out hash aggregation.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(name) for name in order]))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def latest_by_key(
    df: DataFrame, columns: Sequence[str] = ("value",), deleted_when_null: str | None = "value"
) -> DataFrame:
    """The newest record of each key, by (timestamp, offset).

    A key whose newest record has a null in `deleted_when_null` is deleted, so the newest record is chosen first and
    the nulls dropped after. On a stream this is an update-mode aggregation, where the deletes must stay visible to the
    sink: pass `deleted_when_null=None` there.
    """
    order = ("timestamp", "offset")
    records = keyed(df).select("key", *order, *columns)
    if df.isStreaming:
        newest = F.max_by(F.struct(*order, *columns), F.struct(*order))
        table = records.groupBy("key").agg(newest.alias("newest")).select("key", "newest.*")
    else:
        table = newest_rows(records, ("key",), order)
    return table if deleted_when_null is None else table.where(F.col(deleted_when_null).isNotNull())


def table_changes(df: DataFrame, deleted_when_null: str = "value") -> DataFrame:
    """Every update of the table as a record; deletes carry nothing onwards."""
    return keyed(df).where(F.col(deleted_when_null).isNotNull())
