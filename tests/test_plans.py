"""Physical plans: what is read, what is shuffled, what is never there."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from keyrill.operators.tables import latest_by_key
from keyrill.operators.totals import running_total, total_by_key
from keyrill.plans import events as ev
from keyrill.plans import registry
from keyrill.plans.pipelines import combined_orders, join_orders
from tests import data

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def unbroadcast(spark):
    """Joins as they are at scale: no side small enough to broadcast by itself."""
    before = {n: spark.conf.get(n) for n in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


STREAMING = [name for name in registry.QUERIES if name.endswith("_stream")]
EAGER = {"tap_counts", "topic_roundtrip", "topic_mixed_writers"}


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in STREAMING and n not in EAGER])
def test_no_python_and_no_nested_loops(spark, unbroadcast, name):
    text = plan(entry.queries()[name](spark, SF))
    for bad in ("Python", "Pandas", "ArrowEval", "NestedLoop", "CartesianProduct"):
        assert bad not in text


def test_stateless_pipeline_has_no_shuffle(spark):
    text = plan(registry.order_numbers(spark, SF))
    assert "Exchange" not in text and text.count("WholeStageCodegen") + text.count("*(1)") >= 1


def test_filters_and_columns_reach_the_scan(spark, unbroadcast):
    text = plan(registry.interval_join(spark, SF))
    assert "EqualTo(event_type,click)" in text and "EqualTo(event_type,purchase)" in text
    read = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert "value" not in read


def test_one_shuffle_per_group(spark, unbroadcast):
    events = ev.table(spark, SF, "events")
    orders = ev.orders(events)
    assert plan(total_by_key(orders)).count("Exchange hashpartitioning") == 1
    assert plan(running_total(orders)).count("Exchange hashpartitioning") == 1
    assert plan(latest_by_key(ev.records(events))).count("Exchange hashpartitioning") == 1
    text = plan(total_by_key(orders))
    assert "partial_sum" in text and text.count("HashAggregate") == 2


def test_interval_join_shuffles_on_key_and_cell(spark, unbroadcast):
    events = ev.table(spark, SF, "events")
    text = plan(join_orders(ev.orders(events, "click"), ev.orders(events, "purchase")))
    assert text.count("Exchange hashpartitioning(key") == 2 and "_cell" in text.split("Exchange")[1]
    assert "SortMergeJoin" in text


def test_enrichment_adds_one_shuffle_to_the_join(spark, unbroadcast):
    events = ev.table(spark, SF, "events")
    text = plan(combined_orders(ev.orders(events, "click"), ev.orders(events, "purchase"), ev.users(events)))
    assert text.count("Exchange hashpartitioning") == 3


def test_rules_share_one_pass_over_the_samples(spark, unbroadcast):
    """One scan, whatever the number of rules; plain and nested rules are grouped together."""
    text = plan(registry.rule_suite(spark, SF))
    assert text.count("FileScan") == 1 and "Union" not in text


def test_a_single_busy_cell_is_split(spark):
    """One user and hour with almost all rows of one side: adaptive execution splits it, in the join and in the pipeline."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        left = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 50 > 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
            F.col("id").cast("string").alias("order_id"),
            F.md5(F.col("id").cast("string")).alias("appliance_id"),
            F.timestamp_micros(F.col("id") * 1000).alias("timestamp"),
            F.col("id").alias("offset"),
        )
        right = left.where("offset % 50000 = 1").withColumnRenamed("appliance_id", "electronic_id")
        users = left.where("offset % 30000 = 1").select("key", F.col("order_id").alias("name"), "timestamp", "offset")
        for df in (join_orders(left, right), combined_orders(left, right, users)):
            assert df.count() == 6 * 294_000
            executed = df.groupBy().agg(F.count("appliance_id"))
            executed.collect()
            assert "skew=true" in plan(executed)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_fixture_helper_order(spark):
    assert [r[0] for r in data.rows_of(data.text_records(spark), "key")] == ["bogus"] * 2 + ["order"] * 5
