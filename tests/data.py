"""The fixture rows, and small helpers around them."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from keyrill.schemas import ENVELOPE

T0 = datetime(2024, 1, 1)

# The sample records of the four pipelines.
TEXT = [
    ("order", "orderNumber-1001", 0),
    ("order", "orderNumber-5000", 0),
    ("order", "orderNumber-999", 0),
    ("order", "orderNumber-3330", 0),
    ("bogus", "bogus-1", 1),
    ("bogus", "bogus-2", 1),
    ("order", "orderNumber-8400", 0),
]
UPSERTS = [
    ("orderNumberKey", "orderNumber-1001"),
    ("orderNumberKey", "orderNumber-5000"),
    ("orderNumberKey", "orderNumber-999"),
    ("orderNumberKey", "orderNumber-3330"),
    ("bogusKey", "bogus-1"),
    ("bogusKey", "bogus-2"),
    ("orderNumberKey", "orderNumber-8400"),
    ("bogusKey", "bogus-3"),
    ("transactionKey", "transaction-2000"),
    ("transactionKey", "transaction-3000"),
]
ELECTRONICS = [  # electronic_id, order_id, user_id, price, seconds after T0
    ("HDTV-2333", "instore-1", "10261998", 2000.00, 0),
    ("HDTV-2333", "instore-1", "1033737373", 1999.23, 10),
    ("ABCD-1111", "instore-1", "1026333", 4500.00, 20),
    ("ABCD-1111", "instore-1", "1038884844", 1333.98, 32),
    ("HDTV-2333", "instore-1", "1037894844", 5000.98, 44),
]


def at(minutes: float = 0, seconds: float = 0) -> datetime:
    return T0 + timedelta(minutes=minutes, seconds=seconds)


def envelope(spark: SparkSession, pairs, partitions=None) -> DataFrame:
    """(key, value) pairs as records, one second apart."""
    rows = [
        (key, value, at(seconds=i), partitions[i] if partitions else 0, i) for i, (key, value) in enumerate(pairs)
    ]
    return spark.createDataFrame(rows, ENVELOPE)


def text_records(spark: SparkSession) -> DataFrame:
    return envelope(spark, [(k, v) for k, v, _ in TEXT], [p for _, _, p in TEXT])


def electronic_orders(spark: SparkSession) -> DataFrame:
    rows = [
        (electronic, order, electronic, user, price, int(at(seconds=s).timestamp() * 1000), at(seconds=s), i)
        for i, (electronic, order, user, price, s) in enumerate(ELECTRONICS)
    ]
    return spark.createDataFrame(
        rows,
        "key string, order_id string, electronic_id string, user_id string, price double, time bigint, "
        "timestamp timestamp, offset bigint",
    )


APPLIANCE = "key string, order_id string, appliance_id string, timestamp timestamp, offset bigint"
ELECTRONIC = "key string, order_id string, electronic_id string, timestamp timestamp, offset bigint"
USER = "key string, name string, timestamp timestamp, offset bigint"


def appliances(spark, rows=None) -> DataFrame:
    rows = rows or [
        ("10261998", "remodel-1", "dishwasher-1333", at(), 0),
        ("10261999", "remodel-2", "stove-2333", at(), 1),
    ]
    return spark.createDataFrame(rows, APPLIANCE)


def electronics(spark, rows=None) -> DataFrame:
    rows = rows or [
        ("10261998", "remodel-1", "television-2333", at(), 0),
        ("10261999", "remodel-2", "laptop-5333", at(), 1),
    ]
    return spark.createDataFrame(rows, ELECTRONIC)


def users(spark, rows=None) -> DataFrame:
    rows = rows or [("10261998", "Elizabeth Jones", at(-1), 0), ("10261999", "Art Vandelay", at(-1), 1)]
    return spark.createDataFrame(rows, USER)


def streamed(spark: SparkSession, df: DataFrame, folder, files: int = 1, order: str = "offset") -> DataFrame:
    """The rows as a stream of `files` micro-batches in the given order."""
    rows = df.orderBy(order).collect()
    size = -(-len(rows) // files)
    for i in range(files):
        part = spark.createDataFrame(rows[i * size : (i + 1) * size], df.schema).coalesce(1)
        part.write.mode("append").parquet(str(folder))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    """The chosen columns, sorted; nulls last."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
