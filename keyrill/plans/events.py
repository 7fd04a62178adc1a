"""The `events` table read as keyed record streams, changing tables and metric samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyrill.folders import work_folder
from keyrill.plans.rules import BROKER, CLUSTER, PARTITION, TOPIC, recording_rules

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def utc(column: str) -> Column:
    """A time without zone as the instant it is in UTC, whatever the zone of the session."""
    days = F.unix_date(F.col(column).cast("date"))
    # the fields of a time without zone do not depend on the session's; adding days to an instant would
    seconds = F.expr(f"cast(extract(second from {column}) * 1000000 as bigint)")
    minutes = days * 1440 + F.hour(column) * 60 + F.minute(column)
    return F.timestamp_micros(minutes.cast("bigint") * 60_000_000 + seconds)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The events as a stream. The pattern in the path lets one file serve as well as a directory of them."""
    return spark.readStream.schema(EVENTS).options(**options).parquet(f"{sf_dir}/events.parque[t]")


STAGES, LATE_MINUTES = 5, 60


def staged_events(spark: SparkSession, session: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream that brings them in several micro-batches and out of order, up to LATE_MINUTES late.

    Each event arrives some time after it happened, by a hash of its id; the time of arrival is cut into STAGES parts, written one after
    the other, and each part is a micro-batch, whatever the size of the table: all have as many files as the table has input
    partitions. Were a part cut into several micro-batches, the watermark would pass events of the later ones.
    """
    folder = work_folder(spark, "events")
    late = F.pmod(F.xxhash64("event_id"), F.lit(LATE_MINUTES * 60))
    events = table(spark, sf_dir, "events").withColumn("_at", F.unix_micros(utc("ts")) + late * 1_000_000)
    low, high = events.agg(F.min("_at"), F.max("_at")).first()
    stage = F.least(F.floor((F.col("_at") - F.lit(low)) * STAGES / F.lit(max(1, (high or 0) - (low or 0)))), F.lit(STAGES - 1))
    files = max(1, events.rdd.getNumPartitions())
    nothing = spark.createDataFrame([], EVENTS).coalesce(1)

    def write(rows: DataFrame) -> int:
        rows.write.mode("append").option("maxRecordsPerFile", 0).parquet(folder)
        return len(spark.read.schema(EVENTS).parquet(folder).inputFiles())

    for number in range(STAGES):
        rows = events.where(stage == number).drop("_at")
        found = write(rows.repartition(files) if files > 1 else rows)
        while found < files * (number + 1):  # partitions without rows have no file
            found = write(nothing)
    return session.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(folder)


def props_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def records(events: DataFrame, *more: str | Column) -> DataFrame:
    """Events as keyed text records such as `purchase-1231`, keyed by user."""
    number = F.floor(F.col("value") * 100).cast("string")
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        F.concat("event_type", F.lit("-"), number).alias("value"),
        utc("ts").alias("timestamp"),
        F.col("event_id").alias("offset"),
        *more,
    )


def orders(events: DataFrame, event_type: str | None = None) -> DataFrame:
    """Events as priced orders, keyed by user."""
    if event_type is not None:
        events = events.where(F.col("event_type") == event_type)
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        F.col("event_id").cast("string").alias("order_id"),
        F.concat(F.lit("item-"), F.get_json_object("props", "$.k")).alias("appliance_id"),
        F.col("value").cast("decimal(18,2)").alias("price"),
        utc("ts").alias("timestamp"),
        F.col("event_id").alias("offset"),
    )


def users(events: DataFrame) -> DataFrame:
    """Signups as the changing table of users: each one renames its user, and every tenth deletes it."""
    name = F.concat(F.lit("user-"), F.col("event_id").cast("string"))
    return events.where("event_type = 'signup'").select(
        F.col("user_id").cast("string").alias("key"),
        F.when(F.col("event_id") % 10 != 0, name).alias("name"),
        utc("ts").alias("timestamp"),
        F.col("event_id").alias("offset"),
    )


def samples(events: DataFrame) -> DataFrame:
    """Events as samples: the type is the metric; user, kind and, for odd k only, topic are labels."""
    events = events.withColumn("k", props_k())
    labels = [F.lit("user"), F.col("user_id").cast("string"), F.lit("kind"), (F.col("k") % 5).cast("string")]
    topic = [F.lit("topic"), F.concat(F.lit("t"), (F.col("k") % 3).cast("string"))]
    return events.select(
        F.col("event_type").alias("metric"),
        F.when(F.col("k") % 2 == 1, F.create_map(*labels, *topic)).otherwise(F.create_map(*labels)).alias("labels"),
        utc("ts").alias("ts"),
        # whole numbers, so that sums do not depend on the order of addition
        F.floor(F.col("value") * 100).cast("double").alias("value"),
    )


def broker_samples(events: DataFrame) -> DataFrame:
    """Events as samples of the metrics the recording rules read."""
    metrics = sorted({rule.metric for rule in recording_rules()})
    names = F.array(*[F.lit(m) for m in metrics])
    events = events.withColumn("k", props_k())
    topic = F.when(F.col("k") % 10 == 0, F.lit("__cluster_metadata")).otherwise(F.col("event_type"))
    labels = F.create_map(
        F.lit(CLUSTER),
        F.concat(F.lit("c"), (F.col("user_id") % 2).cast("string")),
        F.lit(BROKER),
        F.concat(F.lit("b"), (F.col("user_id") % 3).cast("string")),
        F.lit(TOPIC),
        topic,
        F.lit(PARTITION),
        (F.col("k") % 4).cast("string"),
    )
    value = F.when(F.col("value") < 10, F.lit(0.0)).otherwise(F.floor("value").cast("double"))
    return events.select(
        F.get(names, (F.col("event_id") % len(metrics)).cast("int")).alias("metric"),
        labels.alias("labels"),
        utc("ts").alias("ts"),
        value.alias("value"),
    )
