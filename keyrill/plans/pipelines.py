"""The four record pipelines over batch or streaming inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.operators.joins import JOIN_MINUTES, enrich_asof, interval_join
from keyrill.operators.records import keep_containing, keep_number_above, map_after_dash
from keyrill.operators.slices import ROWS_PER_SLICE
from keyrill.operators.tables import latest_by_key, table_changes

# The text that marks an order number, and the size an order number must exceed.
ORDER_MARK = "orderNumber-"
ORDER_LIMIT = 1000


def order_numbers(df: DataFrame, mark: str = ORDER_MARK, limit: int = ORDER_LIMIT, strict: bool = False) -> DataFrame:
    """Text records with the mark, cut down to their number, above the limit."""
    marked = keep_containing(df, mark).transform(map_after_dash)
    return keep_number_above(marked, limit, strict=strict)


def large_updates(df: DataFrame, limit: int = ORDER_LIMIT) -> DataFrame:
    """Every update of a table whose number is above the limit.

    A key whose newest number fails the test sends nothing, so a reader of this stream keeps its older one.
    """
    return table_changes(df).transform(map_after_dash).transform(keep_number_above, limit)


def large_latest(df: DataFrame, limit: int = ORDER_LIMIT) -> DataFrame:
    """The table's rows whose newest number is above the limit."""
    return latest_by_key(df).transform(map_after_dash).transform(keep_number_above, limit)


def join_orders(
    appliances: DataFrame,
    electronics: DataFrame,
    minutes: int = JOIN_MINUTES,
    wall_clock: bool = False,
    salts: int = 1,
) -> DataFrame:
    """Pairs of appliance and electronic orders of one user, as combined orders with an empty user name.

    The record time is the later of the two. The `time` field is that same instant, or with `wall_clock` the time of the
    query.
    """
    later = F.greatest("l.timestamp", "r.timestamp")
    time: Column = F.current_timestamp() if wall_clock else later
    select = [
        F.col("l.key").alias("key"),
        later.alias("timestamp"),
        F.greatest("l.offset", "r.offset").alias("offset"),
        F.col("r.order_id").alias("electronic_order_id"),
        F.col("l.order_id").alias("appliance_order_id"),
        F.col("l.appliance_id").alias("appliance_id"),
        F.unix_millis(time).alias("time"),
    ]
    # a record without a value has no order
    left, right = (df.where(F.col("order_id").isNotNull()) for df in (appliances, electronics))
    return interval_join(left, right, select, minutes, salts)


def combined_orders(
    appliances: DataFrame,
    electronics: DataFrame,
    users: DataFrame,
    minutes: int = JOIN_MINUTES,
    wall_clock: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
    salts: int = 1,
) -> DataFrame:
    """Joined orders with the name the user had at the time; empty where the user was not known."""
    joined = join_orders(appliances, electronics, minutes, wall_clock, salts)
    inputs = [df.select("key", "timestamp", "offset") for df in (appliances, electronics, users)]
    measure = inputs[0].unionByName(inputs[1]).unionByName(inputs[2])
    named = enrich_asof(joined, users, {"name": ""}, "name", rows_per_slice, measure)
    return named.select(
        "key",
        "timestamp",
        "offset",
        "electronic_order_id",
        "appliance_order_id",
        "appliance_id",
        F.col("name").alias("user_name"),
        "time",
    )
