"""Stateless record operators. They run unchanged on batch and streaming DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.functions.text import after_first_dash, whole_number


def keep_containing(df: DataFrame, text: str, column: str = "value") -> DataFrame:
    """Records whose text holds `text` anywhere (not only at the start)."""
    return df.where(F.col(column).contains(text))


def map_after_dash(df: DataFrame, column: str = "value") -> DataFrame:
    """Replace the text with what follows its first dash."""
    return df.withColumn(column, after_first_dash(F.col(column)))


def keep_number_above(df: DataFrame, limit: int, column: str = "value", strict: bool = False) -> DataFrame:
    """Records whose text is a whole number strictly above `limit`.

    Text that is no number is dropped; with `strict` it fails the query instead.
    """
    number = whole_number(F.col(column))
    if strict:
        bad = F.raise_error(F.concat(F.lit("not a whole number: "), F.col(column))).cast("bigint")
        number = F.when(number.isNull() & F.col(column).isNotNull(), bad).otherwise(number)
    return df.where(number > F.lit(limit))


def tap(df: DataFrame, observation, time_column: str = "timestamp") -> DataFrame:
    """Count passing records and note their first and last time; the records pass unchanged.

    `observation` is a `pyspark.sql.Observation` in batch, or a name that a `StreamingQueryListener` sees in
    `observedMetrics` of every progress event.
    """
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("records"),
        F.min(time_column).alias("first_time"),
        F.max(time_column).alias("last_time"),
    )


def route_by_prefix(
    df: DataFrame,
    routes: Sequence[tuple[str, str, int | None]],
    default: tuple[str, int | None],
    column: str = "value",
) -> DataFrame:
    """Set key and partition from the first prefix `(prefix, key, partition)` the text starts with.

    A partition of `None` leaves the choice to the sink.
    """
    key: Column = F.lit(default[0])
    partition: Column = F.lit(default[1]).cast("int")
    for prefix, route_key, route_partition in reversed(routes):
        hit = F.col(column).startswith(prefix)
        key = F.when(hit, F.lit(route_key)).otherwise(key)
        partition = F.when(hit, F.lit(route_partition).cast("int")).otherwise(partition)
    return df.withColumn("key", key).withColumn("partition", partition)


def key_from(df: DataFrame, field: str) -> DataFrame:
    """Take the record key from a payload field."""
    return df.withColumn("key", F.col(field).cast("string"))


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill absent fields with their declared defaults."""
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()})


def keyed(df: DataFrame) -> DataFrame:
    """Records that have a key; grouping, tables and joins ignore the others."""
    return df.where(F.col("key").isNotNull())
