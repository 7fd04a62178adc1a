"""Enrichment of a stream from a table that is itself fed by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyrill.operators.records import keyed
from keyrill.streaming.ordered import AsOf, in_order


def enrich_stream(
    stream: DataFrame, updates: DataFrame, fields: dict[str, object], deleted_when_null: str | None = None
) -> DataFrame:
    """`enrich_asof` over streams, both with a watermark on `timestamp`: records see the newest update at or before their own time.

    Updates and records of a key wait in state until the watermark has passed them and are taken in order, so an update that comes
    out of order, or after the record, still counts; between them a key keeps one row of the table. The slower of
    both inputs sets the pace.
    """
    own = [name for name in stream.columns if name not in ("timestamp", "key")]
    record = T.StructType([T.StructField("key", T.StringType()), T.StructField("at_us", T.LongType()), *[stream.schema[name] for name in own]])
    table = T.StructType([updates.schema[name] for name in fields])
    changes = keyed(updates).select("key", "timestamp", "offset", F.lit(0).alias("side"), *[F.col(name).alias(f"_new_{name}") for name in fields])
    both = keyed(stream).withColumn("side", F.lit(1)).unionByName(changes, allowMissingColumns=True)
    found = in_order(both, AsOf(record, table, deleted_when_null))
    kept = [name for name in own if name not in fields]
    return found.select(
        "key",
        F.timestamp_micros("at_us").alias("timestamp"),
        *kept,
        *[
            F.coalesce(F.col(f"_found_{name}"), *([F.col(name)] if name in own else []), F.lit(default)).alias(name)
            for name, default in fields.items()
        ],
    )
