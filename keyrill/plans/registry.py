"""The registered queries: every operator over the given tables.

Times leave the queries as whole microseconds and decimal totals as doubles, so that they compare the same in every engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyrill.functions.instants import plus_seconds
from keyrill.functions.text import after_first_dash, decimal_number, number_text, whole_number
from keyrill.operators import joins, quality, rollups, tables, totals, windows
from keyrill.operators.records import (
    keep_containing,
    keep_number_above,
    key_from,
    keyed,
    map_after_dash,
    route_by_prefix,
    tap,
)
from keyrill.plans import events as ev
from keyrill.plans import pipelines
from keyrill.plans.events import event_stream, table
from keyrill.plans.rules import BROKER, CLUSTER, PARTITION, PROMOTED_ATTRIBUTES, TOPIC, recording_rules
from keyrill.sources.codecs import decode_json, encode_json
from keyrill.sources.topics import Topic
from keyrill.streaming import pipelines as streaming
from keyrill.streaming.jobs import Job, finish, job_session, work_folder
from keyrill.streaming.ordered import Fold, Silence

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

MARK = "purchase-"
DELAY = f"{ev.LATE_MINUTES} minutes"
SMALL_SLICE = 25  # cuts keys of the small test tables, to run the path meant for hot keys
HOUR, QUARTER, SESSION_GAP = 60, 15, 240  # minutes


def query(fn):
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def us(column: str | Column, name: str | None = None) -> Column:
    """A timestamp column as microseconds."""
    return F.unix_micros(column).alias(name or column)


def num(column: str | Column, name: str | None = None) -> Column:
    """A decimal column as a double."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("double").alias(name) if name else column.cast("double")


def text_records(df: DataFrame) -> DataFrame:
    return df.select("key", "value", us("timestamp", "ts_us"), "offset")


def upserts(events: DataFrame) -> DataFrame:
    """Events as upserts, with some keys missing and some values deleted."""
    rows = ev.records(events)
    return rows.withColumns(
        {
            "key": F.when(F.col("offset") % 50 != 7, F.col("key")),
            "value": F.when(F.col("offset") % 10 != 3, F.col("value")),
        }
    )


def flawed_records(events: DataFrame) -> DataFrame:
    """Events as text records, some of them no numbers."""
    rows = ev.records(events, "event_type", F.col("value").alias("amount"))
    kind = F.col("event_type")
    value = (
        F.when(kind == "error", F.concat(F.lit("error-"), (F.floor("amount")).cast("string"), F.lit(".5")))
        .when(kind == "view", F.concat(F.lit("view- "), F.floor("amount").cast("string")))
        .when(kind == "signup", F.concat(F.lit("signup-"), F.floor("amount").cast("string"), F.lit("0" * 19)))
        .when(F.col("offset") % 7 == 0, F.lit("click-"))
        .when(F.col("offset") % 7 == 1, F.lit(None).cast("string"))
        .otherwise(F.col("value"))
    )
    return rows.withColumn("value", value).drop("event_type", "amount")


# -- records ---------------------------------------------------------------------------------------------------------


@query
def order_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_records(pipelines.order_numbers(ev.records(table(spark, sf_dir, "events")), MARK))


@query
def order_numbers_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = ev.records(event_stream(job_session(spark), sf_dir))
    return text_records(streaming.run_order_numbers(spark, Job.fresh(spark, "order_numbers"), stream, MARK))


@query
def filter_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_records(keep_containing(ev.records(table(spark, sf_dir, "events")), MARK))


@query
def map_after_dash_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_records(map_after_dash(ev.records(table(spark, sf_dir, "events"))))


@query
def filter_number_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_records(keep_number_above(map_after_dash(flawed_records(table(spark, sf_dir, "events"))), 1000))


@query
def scalar_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ev.records(table(spark, sf_dir, "events"), "props", F.col("value").alias("amount"))
    value, number = F.col("value"), after_first_dash(F.col("value"))
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(30))
    return rows.select(
        "offset",
        value.contains("click").alias("has_click"),
        F.instr(value, "-").alias("dash_at"),
        number.alias("number_text"),
        value.startswith("pu").alias("starts_pu"),
        whole_number(number).alias("number"),
        decimal_number(number).alias("as_double"),
        number_text(whole_number(number)).alias("number_again"),
        (whole_number(number) > 1000).alias("over_1000"),
        (F.col("amount") + F.lit(0.5)).alias("plus_half"),
        whole_number(value).isNull().alias("no_number"),
        us(plus_seconds(F.col("timestamp"), F.lit(10)), "later_us"),
        us(F.col("timestamp") + gap, "half_hour_us"),
        F.floor(us("timestamp") / 1000).alias("at_ms"),
        F.concat(F.lit("key "), "key", F.lit(" value "), "value").alias("line"),
    )


@query
def tap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the taps before and after the order number pipeline saw."""
    seen, sent = Observation("seen"), Observation("sent")
    rows = tap(ev.records(table(spark, sf_dir, "events")), seen)
    tap(pipelines.order_numbers(rows, MARK), sent).write.format("noop").mode("overwrite").save()
    taps = [(name, *(o.get[c] for c in ("records", "first_time", "last_time"))) for name, o in (("in", seen), ("out", sent))]
    df = spark.createDataFrame(taps, "tap string, records bigint, first_time timestamp, last_time timestamp")
    return df.select("tap", "records", us("first_time", "first_us"), us("last_time", "last_us"))


@query
def route_by_prefix_(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_by_prefix(
        ev.records(table(spark, sf_dir, "events")),
        [("purchase", "orderNumberKey", 0), ("error", "bogusKey", 1)],
        ("transactionKey", 2),
    )
    return routed.select("key", "value", "partition", "offset")


@query
def decode_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through their JSON form and back; absent fields come back as their defaults."""
    rows = ev.orders(table(spark, sf_dir, "events")).select(
        "key",
        "offset",
        "order_id",
        F.when(F.col("price") >= 10, num("price")).alias("price"),
        F.when(F.col("offset") % 3 == 0, F.concat(F.lit("name-"), "key")).alias("user_name"),
    )
    schema = T.StructType().add("order_id", "string").add("price", "double").add("user_name", "string")
    return decode_json(encode_json(rows, schema.names), schema, {"price": 0.0, "user_name": ""})


@query
def rekey_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_from(ev.orders(table(spark, sf_dir, "events")), "appliance_id").select("key", "order_id", num("price", "price"))


@query
def topic_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events loaded twice into a directory topic under one load id, and read back once."""
    topic = Topic(f"{work_folder(spark, 'topic')}")
    routed = route_by_prefix(ev.records(table(spark, sf_dir, "events")), [("purchase", "order", 0)], ("other", 1))
    topic.load(routed, "first")
    topic.load(routed, "first")
    return topic.read(spark).select("key", "value", us("timestamp", "ts_us"), "partition", "offset")


@query
def topic_mixed_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the events each by a load, two stream writers of one name and another load, with loads and streams repeated."""
    topic = Topic(f"{work_folder(spark, 'topic')}")

    def quarter(events: DataFrame, number: int) -> DataFrame:
        return ev.records(events.where(F.col("event_id") % 4 == number))

    def stream(number: int) -> None:
        job = Job.fresh(spark, f"writer{number}")
        for _ in range(2):
            events = event_stream(job_session(spark), sf_dir)
            finish(topic.write_stream(quarter(events, number), job.checkpoint, "writer"))

    events = table(spark, sf_dir, "events")
    topic.load(quarter(events, 0), "first")
    stream(1)
    stream(2)
    topic.load(quarter(events, 3), "last")
    topic.load(quarter(events, 0), "first")
    return topic.read(spark).select("key", "value", us("timestamp", "ts_us"), "offset")


# -- tables and totals -----------------------------------------------------------------------------------------------


@query
def table_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_records(tables.latest_by_key(upserts(table(spark, sf_dir, "events"))))


@query
def table_latest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = upserts(event_stream(job_session(spark), sf_dir))
    return text_records(streaming.run_table(spark, Job.fresh(spark, "table_latest"), stream))


@query
def table_filter_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filtered table, by replaying the change stream that a job sends for it, deletes included."""
    stream = upserts(ev.staged_events(spark, job_session(spark), sf_dir))
    changes = streaming.run_table_changes(spark, Job.fresh(spark, "table_changes"), stream, delay=DELAY)
    table_now = tables.newest_rows(changes, ("key",), ("at_us", "offset")).where("value is not null")
    return table_now.select("key", "value", F.col("at_us").alias("ts_us"), "offset")


@query
def table_changelog_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_records(pipelines.large_updates(upserts(table(spark, sf_dir, "events"))))


@query
def table_latest_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_records(pipelines.large_latest(upserts(table(spark, sf_dir, "events"))))


@query
def total_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.total_by_key(ev.orders(table(spark, sf_dir, "events"))).select("key", num("total", "total"))


@query
def total_by_key_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("key", F.col("l_partkey").cast("string"))
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return totals.total_by_key(lines, price).select("key", num("total", "total"))


@query
def total_by_key_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = ev.orders(event_stream(job_session(spark), sf_dir))
    result = streaming.run_totals(spark, Job.fresh(spark, "total_by_key"), stream)
    return result.select("key", num("total", "total"))


@query
def store_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals by key, read from the state of the job that keeps them."""
    job = Job.fresh(spark, "store")
    streaming.run_totals(spark, job, ev.orders(ev.staged_events(spark, job_session(spark), sf_dir)))
    return streaming.read_store(spark, job).select("key", num("sum", "total"))


def _prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders with what running totals read only: rows of hot keys are written, with all their columns."""
    return ev.orders(table(spark, sf_dir, "events")).select("key", "price", "timestamp", "offset")


def _running(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    rows = totals.running_total(_prices(spark, sf_dir), **options)
    return rows.select("key", "offset", num("price", "price"), num("total", "total"))


@query
def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _running(spark, sf_dir)


@query
def running_total_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _running(spark, sf_dir, rows_per_slice=SMALL_SLICE)


@query
def running_total_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's total, as text in a topic, from several micro-batches with records out of order; up to the watermark."""
    stream = ev.orders(ev.staged_events(spark, job_session(spark), sf_dir))
    job = Job.fresh(spark, "running_totals")
    totals = streaming.run_running_totals(spark, job, stream, Topic(job.output), delay=DELAY)
    return totals.select("key", "offset", us("timestamp", "ts_us"), "value")


def _running_double(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    orders = _prices(spark, sf_dir).withColumn("price", F.col("price").cast("double") / 8)
    return totals.running_total(orders, **options).select("key", "offset", "total")


@query
def running_total_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _running_double(spark, sf_dir)


@query
def running_total_double_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _running_double(spark, sf_dir, rows_per_slice=SMALL_SLICE)


MODULUS, BASE = 1_000_003, 31
SILENCE_HOURS = 24


def _fingerprint(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """An order-sensitive fold: a polynomial of each user's amounts, modulo a prime."""

    def pair(scale: Column, sum_: Column) -> Column:
        return F.struct((scale % MODULUS).alias("scale"), (sum_ % MODULUS).alias("sum"))

    amounts = ev.orders(table(spark, sf_dir, "events"))
    folded = totals.ordered_fold(
        amounts,
        (F.col("price") * 100).cast("bigint"),
        init=F.struct(F.lit(1).cast("bigint").alias("scale"), F.lit(0).cast("bigint").alias("sum")),
        step=lambda acc, amount: pair(acc["scale"] * BASE, acc["sum"] * BASE + amount),
        merge=lambda a, b: pair(a["scale"] * b["scale"], a["sum"] * b["scale"] + b["sum"]),
        **options,
    )
    return folded.select("key", F.col("result.sum").alias("fingerprint"))


@query
def ordered_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fingerprint(spark, sf_dir)


@query
def ordered_fold_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fingerprint(spark, sf_dir, rows_per_slice=SMALL_SLICE, block=4)


@query
def running_total_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals of doubles among which are NaN, infinities, tiny and huge ones; each user's rows of one kind."""
    orders = _prices(spark, sf_dir)
    kind, user = F.col("offset") % 7, F.col("key").cast("bigint") % 4
    odd = F.when((user == 0) & (kind == 3), F.lit(float("nan"))).when((user == 1) & (kind == 3), F.lit(float("inf")))
    odd = odd.when(user == 2, F.lit(2.0**-60)).when((user == 3) & (kind == 3), F.lit(2.0**100))
    orders = orders.withColumn("price", F.coalesce(odd, F.when(user == 3, F.lit(0.0)).otherwise(F.floor("price").cast("double"))))
    rows = totals.running_total(orders, rows_per_slice=SMALL_SLICE)
    return rows.select("key", "offset", F.col("total").cast("string").alias("total_text"), (F.col("total") == F.col("total") + 1).alias("beyond_ones")).select(
        "key", "offset", F.when(F.col("total_text").isin("NaN", "Infinity"), F.col("total_text")).otherwise("").alias("kind"), F.coalesce("beyond_ones", F.lit(False)).alias("beyond_ones")
    )


@query
def ordered_fold_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fold on a stream of several micro-batches with rows out of order; up to the watermark."""
    stream = ev.orders(ev.staged_events(spark, job_session(spark), sf_dir)).withColumn("amount", (F.col("price") * 100).cast("bigint"))
    stream = stream.select("key", "amount", "timestamp", "offset")  # what is not used would wait in the state
    modulus, base = MODULUS, BASE
    step = Fold("amount", (0,), "fingerprint bigint", lambda state, amount: ((state[0] * base + amount) % modulus,))
    folds = streaming.run_step(spark, Job.fresh(spark, "fold"), stream, step, DELAY)
    return tables.newest_rows(folds, ("key",), ("at_us", "offset")).select("key", "fingerprint")


@query
def silence_alarms_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An alarm for each user of whom nothing was heard for a day; up to the watermark."""
    stream = ev.orders(ev.staged_events(spark, job_session(spark), sf_dir)).select("key", "timestamp", "offset")
    return streaming.run_step(spark, Job.fresh(spark, "silence"), stream, Silence(SILENCE_HOURS * 3_600_000_000), DELAY)


@query
def stateful_total_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = ev.orders(event_stream(job_session(spark), sf_dir))
    result = streaming.run_stateful_totals(spark, Job.fresh(spark, "stateful_total"), stream, F.col("price") * 100)
    return result.select("key", (F.col("total") / 100).alias("total"), "records")


# -- joins -----------------------------------------------------------------------------------------------------------


def _pairs(df: DataFrame) -> DataFrame:
    return df.select("key", us("timestamp", "ts_us"), "electronic_order_id", "appliance_order_id", "appliance_id", "time")


def _combined(df: DataFrame) -> DataFrame:
    return df.select(
        "key", us("timestamp", "ts_us"), "electronic_order_id", "appliance_order_id", "appliance_id", "user_name", "time"
    )


@query
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return _pairs(pipelines.join_orders(ev.orders(events, "click"), ev.orders(events, "purchase")))


@query
def interval_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return _pairs(pipelines.join_orders(ev.orders(events, "click"), ev.orders(events, "purchase"), salts=4))


@query
def interval_join_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_stream(job_session(spark, idle_batches=False), sf_dir)
    job = Job.fresh(spark, "interval_join")
    return _pairs(streaming.run_join(spark, job, ev.orders(events, "click"), ev.orders(events, "purchase")))


@query
def interval_join_salted_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a busy (key, cell) are spread over four tasks, which a stream's plan cannot do by itself."""
    events = event_stream(job_session(spark, idle_batches=False), sf_dir)
    job = Job.fresh(spark, "interval_join_salted")
    return _pairs(streaming.run_join(spark, job, ev.orders(events, "click"), ev.orders(events, "purchase"), salts=4))


@query
def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the name of their customer, where that customer is in the building segment."""
    stream = ev.orders(table(spark, sf_dir, "events"))
    customers = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    names = customers.select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("user_name"))
    return joins.enrich_left(stream, names, {"user_name": ""}).select("key", "offset", "user_name")


@query
def enrich_existing_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `enrich_left`, for records that have the field already, some of them filled."""
    stream = ev.orders(table(spark, sf_dir, "events"))
    stream = stream.withColumn("user_name", F.when(F.col("offset") % 3 == 0, F.concat(F.lit("own-"), "order_id")))
    customers = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    names = customers.select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("user_name"))
    return joins.enrich_left(stream, names, {"user_name": ""}).select("key", "offset", "user_name")


def _asof(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    events = table(spark, sf_dir, "events")
    rows = joins.enrich_asof(ev.orders(events, "click"), ev.users(events), {"name": ""}, "name", **options)
    return rows.select("key", "offset", num("price", "price"), "name")


@query
def enrich_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof(spark, sf_dir)


@query
def enrich_asof_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof(spark, sf_dir, rows_per_slice=SMALL_SLICE)


@query
def enrich_asof_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over several micro-batches, with records and updates out of order; up to the watermark."""
    events = ev.staged_events(spark, job_session(spark), sf_dir)
    job = Job.fresh(spark, "enrich_asof")
    clicks = ev.orders(events, "click").select("key", "price", "timestamp", "offset")
    rows = streaming.run_enrich(spark, job, clicks, ev.users(events), {"name": ""}, "name", DELAY)
    return rows.select("key", "offset", num("price", "price"), "name")


@query
def combined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return _combined(
        pipelines.combined_orders(ev.orders(events, "click"), ev.orders(events, "purchase"), ev.users(events))
    )


@query
def combined_orders_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    clicks, purchases = ev.orders(events, "click"), ev.orders(events, "purchase")
    return _combined(pipelines.combined_orders(clicks, purchases, ev.users(events), rows_per_slice=SMALL_SLICE))


@query
def combined_orders_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_stream(job_session(spark), sf_dir)
    job = Job.fresh(spark, "combined_orders")
    return _combined(
        streaming.run_combined_orders(
            spark, job, ev.orders(events, "click"), ev.orders(events, "purchase"), ev.users(events)
        )
    )


# -- metric rollups --------------------------------------------------------------------------------------------------


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.valid_samples(ev.samples(table(spark, sf_dir, "events")))


def _flat(df: DataFrame, *labels: str, time: str = "tick") -> list[Column]:
    return [us(time, "tick_us"), *[rollups.label(name).alias(name) for name in labels], F.col("value")]


@query
def instant_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of every series at every tick."""
    df = rollups.at_ticks(_valid(spark, sf_dir))
    return df.select("metric", *_flat(df, "user", "kind", "topic"))


@query
def instant_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _valid(spark, sf_dir).select("metric", "from_us", "to_us", "value")
    df = rollups.at_ticks(rows).groupBy("metric", "tick").agg(F.sum("value").alias("value"))
    return df.select("metric", us("tick", "tick_us"), "value")


@query
def sum_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rollups.aggregate_by(_valid(spark, sf_dir), ("kind", "topic"))
    return df.select(*_flat(df, "kind", "topic"))


@query
def sum_by_label_neq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples without the label are kept."""
    df = rollups.aggregate_by(rollups.without_label(_valid(spark, sf_dir), "topic", "t1"), ("kind", "topic"))
    return df.select(*_flat(df, "kind", "topic"))


@query
def sum_of_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = rollups.aggregate_by(_valid(spark, sf_dir), ("kind", "topic"), "max")
    df = rollups.aggregate_by(inner, ("topic",))
    return df.select(*_flat(df, "topic"))


@query
def count_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series above a threshold, counted."""
    df = rollups.aggregate_by(_valid(spark, sf_dir).where("value > 2000"), ("kind",), "count")
    return df.select(*_flat(df, "kind"))


@query
def record_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = rollups.Rule("clicks_by_kind:total", "click", ("kind",), not_equal=("topic", "t1"))
    df = rollups.evaluate_rule(_valid(spark, sf_dir), rule)
    return df.select("metric", *_flat(df, "kind", time="ts"))


@query
def rule_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fifteen recording rules in one pass."""
    valid = rollups.valid_samples(ev.broker_samples(table(spark, sf_dir, "events")))
    df = rollups.evaluate_rules(valid, recording_rules())
    return df.select("metric", *_flat(df, CLUSTER, BROKER, TOPIC, PARTITION, time="ts"))


@query
def rule_suite_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules at every tick before the newest sample."""
    samples = ev.broker_samples(event_stream(job_session(spark), sf_dir))
    df = streaming.run_rules(spark, Job.fresh(spark, "rules"), samples, recording_rules())
    return df.select("metric", *_flat(df, CLUSTER, BROKER, TOPIC, PARTITION, time="ts"))


@query
def rule_suite_late_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules over several micro-batches with samples out of order; up to the watermark."""
    samples = ev.broker_samples(ev.staged_events(spark, job_session(spark), sf_dir))
    df = streaming.run_rules(spark, Job.fresh(spark, "late_rules"), samples, recording_rules(), DELAY)
    return df.select("metric", *_flat(df, CLUSTER, BROKER, TOPIC, PARTITION, time="ts"))


@query
def promote_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = F.create_map(
        F.lit("host.hostname"),
        F.concat(F.lit("h"), (F.col("user_id") % 4).cast("string")),
        F.lit("kafka.broker.id"),
        (F.col("user_id") % 3).cast("string"),
        F.lit("type"),
        F.col("event_type"),
        F.lit("process.pid"),
        F.col("event_id").cast("string"),
    )
    events = table(spark, sf_dir, "events")
    rows = events.select(
        "event_id",
        F.map_filter(
            F.create_map(F.lit("type"), F.concat(F.lit("own-"), "event_type"), F.lit("k"), ev.props_k().cast("string")),
            lambda name, _: (name != "type") | (F.col("event_id") % 2 == 0),
        ).alias("labels"),
        attributes.alias("attributes"),
    )
    df = rollups.promote_labels(rows, "attributes", PROMOTED_ATTRIBUTES)
    names = ("host_hostname", "kafka_broker_id", "type", "process_pid", "k")
    return df.select("event_id", *[rollups.label(n).alias(n) for n in names], F.size("labels").alias("label_count"))


@query
def sum_of_max_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over tick intervals, in several micro-batches with samples out of order; up to the watermark."""
    samples = ev.samples(ev.staged_events(spark, job_session(spark), sf_dir))
    df = streaming.run_sum_of_max(spark, Job.fresh(spark, "sum_of_max"), samples, ("kind", "topic"), ("topic",), DELAY)
    return df.select(us("tick", "tick_us"), "topic", "value")


@query
def rollup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = ev.samples(event_stream(job_session(spark), sf_dir))
    df = streaming.run_rollup(spark, Job.fresh(spark, "rollup"), samples, ("kind", "topic"))
    return df.select(us("tick", "tick_us"), "kind", "topic", "value")


# -- event time, windows, dead letters -------------------------------------------------------------------------------


def _windowed(df: DataFrame) -> DataFrame:
    return df.select("key", us("start", "start_us"), us("end", "end_us"), "records", num("total", "total"))


@query
def event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time from the payload where it has one."""
    seconds = ev.props_k() * 1000
    millis = F.floor(us("timestamp") / 1000) + seconds
    rows = ev.records(table(spark, sf_dir, "events"), "props")
    rows = rows.withColumn("time", F.when(ev.props_k() >= 10, millis)).drop("props")
    return windows.with_event_time(rows).select("key", "offset", us("timestamp", "ts_us"))


@query
def tumbling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windowed(windows.tumbling_sum(ev.orders(table(spark, sf_dir, "events")), F.col("price"), HOUR))


@query
def hopping_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windowed(windows.hopping_sum(ev.orders(table(spark, sf_dir, "events")), F.col("price"), HOUR, QUARTER))


@query
def session_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windowed(windows.session_sum(ev.orders(table(spark, sf_dir, "events")), F.col("price"), SESSION_GAP))


@query
def session_sum_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = ev.orders(table(spark, sf_dir, "events"))
    return _windowed(windows.session_sum(orders, F.col("price"), SESSION_GAP, rows_per_slice=SMALL_SLICE))


@query
def tumbling_sum_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = ev.orders(event_stream(job_session(spark), sf_dir))
    return _windowed(streaming.run_tumbling(spark, Job.fresh(spark, "tumbling"), stream, F.col("price"), HOUR))


@query
def hopping_sum_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = ev.orders(event_stream(job_session(spark), sf_dir))
    return _windowed(streaming.run_hopping(spark, Job.fresh(spark, "hopping"), stream, F.col("price"), HOUR, QUARTER))


@query
def session_sum_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions over before the watermark, which stays ten minutes behind the newest event."""
    stream = ev.orders(event_stream(job_session(spark), sf_dir))
    return _windowed(streaming.run_sessions(spark, Job.fresh(spark, "sessions"), stream, F.col("price"), SESSION_GAP))


@query
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = quality.dead_letters(quality.with_parse_result(flawed_records(table(spark, sf_dir, "events"))))
    return bad.select("key", "value", "offset", "reason")


@query
def dead_letters_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = flawed_records(event_stream(job_session(spark), sf_dir))
    _, bad = streaming.run_split(spark, Job.fresh(spark, "dead_letters"), stream)
    return bad.select("key", "value", "offset", "reason")


@query
def good_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = quality.good_records(quality.with_parse_result(flawed_records(table(spark, sf_dir, "events"))))
    return keyed(good).select("key", "value", "offset", "number")
