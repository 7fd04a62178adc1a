"""Record schemas. All are declared, never inferred: streaming file sources need that anyway."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Every keyed stream carries these columns. They are the column set of Spark's own Kafka source, so
# directory-backed and Kafka-backed topics go through the same code.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

# Field names, field order and types of the four record kinds, and their defaults.
APPLIANCE_ORDER = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("appliance_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("time", T.LongType()),
    ]
)
ELECTRONIC_ORDER = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("electronic_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("time", T.LongType()),
    ]
)
COMBINED_ORDER = T.StructType(
    [
        T.StructField("electronic_order_id", T.StringType()),
        T.StructField("appliance_order_id", T.StringType()),
        T.StructField("appliance_id", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("time", T.LongType()),
    ]
)
USER = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("user_id", T.StringType()),
    ]
)
ELECTRONIC_ORDER_DEFAULTS = {"price": 0.0}
COMBINED_ORDER_DEFAULTS = {"user_name": ""}

METRIC_SAMPLE = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("ts", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
    ]
)

_AVRO_NAMES = {"string": "string", "bigint": "long", "double": "double", "int": "int", "boolean": "boolean"}


def avro_schema(record: T.StructType, name: str, defaults: dict | None = None) -> str:
    """The Avro JSON schema of a flat record, for `from_avro` / `to_avro`."""
    defaults = defaults or {}
    fields = []
    for field in record.fields:
        entry = {"name": field.name, "type": _AVRO_NAMES[field.dataType.simpleString()]}
        if field.name in defaults:
            entry["default"] = defaults[field.name]
        fields.append(entry)
    return json.dumps({"type": "record", "name": name, "fields": fields})
