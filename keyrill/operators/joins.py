"""Stream-stream interval joins and enrichment of a stream from a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.functions.instants import MINUTE_US, floor_to
from keyrill.operators.records import keyed
from keyrill.operators.slices import ROWS_PER_SLICE, sliced

JOIN_MINUTES = 30  # fixed value: the order streams are joined within 30 minutes either way


def interval_join(
    left: DataFrame,
    right: DataFrame,
    select: Sequence[Column],
    minutes: int = JOIN_MINUTES,
    salts: int = 1,
) -> DataFrame:
    """All pairs with the same key whose times differ by at most `minutes`, both ends included.

    `select` is written over the aliases `l` and `r`. Rows are matched on (key, time cell) instead of the key alone:
    the cells are twice the join distance wide, so a left row lies in one cell and a right row reaches at most two, and
    every pair meets in exactly one cell. A busy key is thereby spread over its time cells. A single busy cell is left
    to adaptive skew splitting in batch; `salts` splits it by hand, also on a stream, where the adaptive splitting is
    not available. On streams, both sides need a watermark on `timestamp`.
    """
    reach = minutes * MINUTE_US
    width = max(1, 2 * reach)
    at = F.unix_micros("timestamp")
    left = keyed(left).withColumn("_cell", floor_to(at, width))
    first, last = floor_to(at - reach, width), floor_to(at + reach, width)
    right = keyed(right).withColumn("_cell", F.explode(F.array_distinct(F.array(first, last))))
    on = (F.col("l.key") == F.col("r.key")) & (F.col("l._cell") == F.col("r._cell"))
    if salts > 1:
        left = left.withColumn("_salt", F.pmod(F.xxhash64("timestamp", "offset"), F.lit(salts)).cast("int"))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = on & (F.col("l._salt") == F.col("r._salt"))
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    near = F.col("r.timestamp").between(F.col("l.timestamp") - gap, F.col("l.timestamp") + gap)
    return left.alias("l").join(right.alias("r"), on & near, "inner").select(*select)


def enrich_left(stream: DataFrame, table: DataFrame, fields: dict[str, object]) -> DataFrame:
    """Add `fields` of the table's row for each record's key, else what the record has itself, else the given defaults.

    The table has one row per key. No join hint: Spark broadcasts it where its measured size allows, and splits skewed
    stream keys where it does not.
    """
    found = table.select("key", *[F.col(name).alias(f"_found_{name}") for name in fields])
    joined = keyed(stream).join(found, "key", "left")
    return joined.withColumns(
        {name: _first_of(f"_found_{name}", name if name in stream.columns else None, default) for name, default in fields.items()}
    ).drop(*[f"_found_{name}" for name in fields])


def _first_of(found: str, own: str | None, default: object) -> Column:
    """The table's value, else the record's own, else the default."""
    return F.coalesce(F.col(found), *([F.col(own)] if own else []), F.lit(default))


def enrich_asof(
    stream: DataFrame,
    updates: DataFrame,
    fields: dict[str, object],
    deleted_when_null: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    measure: DataFrame | None = None,
) -> DataFrame:
    """As `enrich_left`, but from the table as it was at each record's time.

    `updates` is the table's history. An update at the very time of a record counts as before it; later updates do not
    reach back. One shuffle of both inputs together, no pairing of records with updates. `measure` stands in for both
    when looking for hot keys, where `stream` is expensive to compute.
    """
    kept = [c for c in stream.columns if c not in ("key", "timestamp", "offset")]
    record = F.struct(*kept) if kept else F.struct(F.lit(True).alias("present"))
    row = F.struct(*fields)
    if deleted_when_null is not None:
        # a delete must hide the older rows, so it stays a non-null struct with null fields
        live = F.col(deleted_when_null).isNotNull()
        row = F.struct(*[F.when(live, F.col(name)).alias(name) for name in fields])
    events = keyed(stream).select("key", "timestamp", F.lit(1).alias("side"), "offset", record.alias("record"))
    changes = keyed(updates).select("key", "timestamp", F.lit(0).alias("side"), "offset", row.alias("row"))
    both = events.unionByName(changes, allowMissingColumns=True)
    if measure is not None:
        measure = keyed(measure).withColumn("side", F.lit(0))
    cut = sliced(both, ("timestamp", "side", "offset"), rows_per_slice, measure)
    found = cut.running_last(F.col("row"), "found").result().where("side = 1")
    return found.select(
        "key",
        "timestamp",
        "offset",
        *[F.col(f"record.{name}").alias(name) for name in kept if name not in fields],
        *[
            _first_of(f"found.{name}", f"record.{name}" if name in kept else None, default).alias(name)
            for name, default in fields.items()
        ],
    )
