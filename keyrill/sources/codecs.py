"""Decoding and encoding of record values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyrill.schemas import avro_schema

REGISTRY_HEADER_BYTES = 5  # one marker byte and a four-byte schema id


def decode_text(df: DataFrame) -> DataFrame:
    """Key and value bytes as UTF-8 text."""
    return df.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})


def encode_text(df: DataFrame) -> DataFrame:
    return df.withColumns({"key": F.col("key").cast("binary"), "value": F.col("value").cast("binary")})


def _spread(df: DataFrame, record: Column, defaults: dict | None) -> DataFrame:
    """The record's fields as columns. A record without a value has only nulls, and no defaults."""
    others = [c for c in df.columns if c != "value"]
    decoded = df.select(*others, record.alias("_record"))
    defaults = defaults or {}
    fields = []
    for name in decoded.schema["_record"].dataType.names:
        field = F.col(f"_record.{name}")
        if name in defaults:
            field = F.when(F.col("_record").isNotNull(), F.coalesce(field, F.lit(defaults[name])))
        fields.append(field.alias(name))
    return decoded.select(*others, *fields)


def decode_json(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Replace the JSON value by its fields; absent fields get their defaults."""
    return _spread(df, F.from_json(F.col("value").cast("string"), schema), defaults)


def encode_json(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Pack the fields into one JSON value."""
    value = F.to_json(F.struct(*fields))
    return df.withColumn("value", value).drop(*[f for f in fields if f != "value"])


def decode_avro(
    df: DataFrame,
    schema: T.StructType,
    name: str,
    defaults: dict | None = None,
    registry_framed: bool = False,
) -> DataFrame:
    """As `decode_json` for Avro values. Needs the spark-avro package on the class path."""
    from pyspark.sql.avro.functions import from_avro

    data = F.col("value")
    if registry_framed:
        data = F.substring(data, REGISTRY_HEADER_BYTES + 1, 2**31 - 1)
    return _spread(df, from_avro(data, avro_schema(schema, name, defaults)), defaults)


def encode_avro(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """As `encode_json` for Avro values. Needs the spark-avro package on the class path."""
    from pyspark.sql.avro.functions import to_avro

    value = to_avro(F.struct(*schema.names), avro_schema(schema, name))
    return df.withColumn("value", value).drop(*[f for f in schema.names if f != "value"])
