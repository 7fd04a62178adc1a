"""The four record pipelines as streaming jobs, and the windowed and metric ones.

Each takes streaming DataFrames, runs until everything now available is done, and returns the result as a
batch DataFrame read from what the job wrote.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyrill.operators.joins import JOIN_MINUTES
from keyrill.functions.text import whole_number
from keyrill.operators.quality import dead_letters, good_records, with_parse_result
from keyrill.operators.records import map_after_dash
from keyrill.operators.rollups import LATENESS, Rule, windowed_rollup, windowed_sum_of_max
from keyrill.operators.tables import latest_by_key
from keyrill.operators.totals import total_by_key
from keyrill.operators.windows import hopping_sum, session_sum_stream, tumbling_sum
from keyrill.plans.pipelines import ORDER_LIMIT, ORDER_MARK, join_orders, order_numbers
from keyrill.schemas import ENVELOPE, METRIC_SAMPLE
from keyrill.sources.topics import Topic
from keyrill.folders import exists
from keyrill.streaming.enrich import enrich_stream
from keyrill.streaming.jobs import Job, finish
from keyrill.streaming.ordered import FilteredChanges, RunningTotal, Step, in_order
from keyrill.streaming.rules import start_rules
from keyrill.streaming.state import stateful_totals
from keyrill.streaming.upserts import UpsertTable

NO_GRACE = "0 seconds"  # fixed value: the order streams wait for no late records


def _upserts(spark: SparkSession, job: Job, changes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    table = UpsertTable(job.output, keys)
    finish(job.for_each_batch(changes, table.write_changes, "update"))
    return table.read(spark, changes.schema)


def _read(spark: SparkSession, schema, path: str) -> DataFrame:
    """What a job wrote; empty if it never had anything to write."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def run_order_numbers(
    spark: SparkSession, job: Job, stream: DataFrame, mark: str = ORDER_MARK, limit: int = ORDER_LIMIT
) -> DataFrame:
    numbers = order_numbers(stream, mark, limit)
    finish(job.append(numbers))
    return _read(spark, numbers.schema, job.output)


def run_table(spark: SparkSession, job: Job, stream: DataFrame) -> DataFrame:
    """The latest value per key; deletes reach the table as null values and are dropped on reading."""
    changes = latest_by_key(stream, deleted_when_null=None)
    return _upserts(spark, job, changes, ("key",)).where(F.col("value").isNotNull())


def run_totals(spark: SparkSession, job: Job, stream: DataFrame, value: str = "price") -> DataFrame:
    return _upserts(spark, job, total_by_key(stream, value), ("key",))


def run_running_totals(
    spark: SparkSession, job: Job, stream: DataFrame, sink: Topic, value: str = "price", delay: str = NO_GRACE
) -> DataFrame:
    """The total of a key after each of its records, as text in a topic under the record's offset; up to the watermark.

    One row a record and not one a micro-batch, in (timestamp, offset) order. Decimals are added exactly.
    """
    kind = stream.schema[value].dataType
    if isinstance(kind, T.DecimalType):
        kind = T.DecimalType(38, kind.scale)
    rows = stream.select("key", "timestamp", "offset", F.col(value).cast(kind).alias(value)).withWatermark("timestamp", delay)
    totals = in_order(rows, RunningTotal(value, kind.simpleString()))
    texts = totals.select("key", F.col("total").cast("string").alias("value"), F.timestamp_micros("at_us").alias("timestamp"), "offset")
    finish(sink.write_stream(texts, job.checkpoint, job.name))
    return sink.read(spark) if exists(spark, sink.path) else spark.createDataFrame([], ENVELOPE)


def run_join(
    spark: SparkSession,
    job: Job,
    appliances: DataFrame,
    electronics: DataFrame,
    minutes: int = JOIN_MINUTES,
    salts: int = 1,
) -> DataFrame:
    joined = join_streams(appliances, electronics, minutes, salts)
    finish(job.append(joined))
    return _read(spark, joined.schema, job.output)


def join_streams(
    appliances: DataFrame, electronics: DataFrame, minutes: int = JOIN_MINUTES, salts: int = 1
) -> DataFrame:
    sides = (df.withWatermark("timestamp", NO_GRACE) for df in (appliances, electronics))
    return join_orders(*sides, minutes=minutes, salts=salts)


def run_enrich(
    spark: SparkSession,
    job: Job,
    stream: DataFrame,
    updates: DataFrame,
    fields: dict[str, object],
    deleted_when_null: str | None = None,
    delay: str = NO_GRACE,
) -> DataFrame:
    """`enrich_asof` up to the watermark, which is the slower input's newest time less `delay`."""
    sides = (df.withWatermark("timestamp", delay) for df in (stream, updates))
    enriched = enrich_stream(*sides, fields, deleted_when_null)
    finish(job.append(enriched))
    return _read(spark, enriched.schema, job.output)


def run_combined_orders(
    spark: SparkSession,
    job: Job,
    appliances: DataFrame,
    electronics: DataFrame,
    users: DataFrame,
    minutes: int = JOIN_MINUTES,
    salts: int = 1,
) -> DataFrame:
    """Interval join and enrichment, one job after the other; the second reads what the first has written as a stream."""
    joined = join_streams(appliances, electronics, minutes, salts)
    first = Job(f"{job.name}_joined", f"{job.folder}/joined")
    finish(first.append(joined))
    session = users.sparkSession
    again = session.readStream.schema(joined.schema).parquet(first.output)
    named = run_enrich(spark, job, again, users, {"name": ""}, deleted_when_null="name")
    return named.withColumnRenamed("name", "user_name")


def run_step(spark: SparkSession, job: Job, stream: DataFrame, step: Step, delay: str = NO_GRACE) -> DataFrame:
    """What `step` sends over the rows of each key in order, up to the watermark."""
    sent = in_order(stream.withWatermark("timestamp", delay), step)
    finish(job.append(sent))
    return _read(spark, sent.schema, job.output)


def run_table_changes(
    spark: SparkSession, job: Job, stream: DataFrame, limit: int = ORDER_LIMIT, delay: str = NO_GRACE
) -> DataFrame:
    """The change stream of the table of large numbers: newest numbers above the limit, and a null where a key loses its row."""
    numbers = stream.transform(map_after_dash)
    passes = F.coalesce(whole_number(F.col("value")) > limit, F.lit(False))
    return run_step(spark, job, numbers.withColumn("passes", passes), FilteredChanges(), delay)


def read_store(spark: SparkSession, job: Job) -> DataFrame:
    """The named store of a job that aggregates by one key, read from Spark's state as it is after the last batch."""
    state = spark.read.format("statestore").load(job.checkpoint)
    return state.select("key.*", "value.*")


def run_tumbling(spark: SparkSession, job: Job, stream: DataFrame, value: Column, minutes: int) -> DataFrame:
    """Window sums, updated until the watermark closes a window."""
    sums = tumbling_sum(stream.withWatermark("timestamp", LATENESS), value, minutes)
    return _upserts(spark, job, sums, ("key", "start", "end"))


def run_hopping(spark: SparkSession, job: Job, stream: DataFrame, value: Column, minutes: int, slide: int) -> DataFrame:
    sums = hopping_sum(stream.withWatermark("timestamp", LATENESS), value, minutes, slide)
    return _upserts(spark, job, sums, ("key", "start", "end"))


def run_sessions(spark: SparkSession, job: Job, stream: DataFrame, value: Column, gap_minutes: int) -> DataFrame:
    """Sessions that the watermark has closed; Spark has no update mode for sessions."""
    sums = session_sum_stream(stream.withWatermark("timestamp", LATENESS), value, gap_minutes)
    finish(job.append(sums))
    return _read(spark, sums.schema, job.output)


def run_rollup(spark: SparkSession, job: Job, samples: DataFrame, by: tuple[str, ...], agg: str = "sum") -> DataFrame:
    """A label rollup per tick interval; samples up to ten minutes late still count."""
    rollup = windowed_rollup(samples.withWatermark("ts", LATENESS), by, agg)
    return _upserts(spark, job, rollup, ("tick", *by))


def run_sum_of_max(
    spark: SparkSession, job: Job, samples: DataFrame, inner_by: tuple[str, ...], by: tuple[str, ...], delay: str = LATENESS
) -> DataFrame:
    """The sum over the greatest samples by finer labels, for each tick interval that the watermark has closed."""
    sums = windowed_sum_of_max(samples.withWatermark("ts", delay), inner_by, by)
    finish(job.append(sums))
    return _read(spark, sums.schema, job.output)


def run_rules(spark: SparkSession, job: Job, samples: DataFrame, rules: Sequence[Rule], delay: str = NO_GRACE) -> DataFrame:
    """The recorded samples of all rules, up to the watermark, which is the newest sample's time less `delay`."""
    finish(start_rules(job, samples, rules, delay))
    return _read(spark, METRIC_SAMPLE, job.output)


def run_stateful_totals(spark: SparkSession, job: Job, stream: DataFrame, amount: Column) -> DataFrame:
    return _upserts(spark, job, stateful_totals(stream, amount), ("key",))


def run_split(spark: SparkSession, job: Job, stream: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good and bad records of the number parse, each to its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            good_records(batch).write.mode("overwrite").parquet(f"{job.output}/good/batch={number}")
            dead_letters(batch).write.mode("overwrite").parquet(f"{job.output}/bad/batch={number}")
        finally:
            batch.unpersist()

    finish(job.for_each_batch(with_parse_result(stream), write, "append"))
    split = with_parse_result(stream)
    schemas = {"good": good_records(split).schema, "bad": dead_letters(split).schema}
    return tuple(_read(spark, schema, f"{job.output}/{side}").select(schema.names) for side, schema in schemas.items())
