"""The four pipelines on the fixture rows, in batch and as streams."""

import pytest
from pyspark.sql import functions as F

from keyrill.functions.text import number_text
from keyrill.operators.tables import latest_by_key
from keyrill.operators.totals import ordered_fold, running_total, total_by_key
from keyrill.plans.pipelines import combined_orders, large_latest, large_updates, order_numbers
from keyrill.streaming import pipelines as streaming
from keyrill.streaming.jobs import Job, job_session
from tests import data

ORDER_ROWS = [("order", "1001"), ("order", "3330"), ("order", "5000"), ("order", "8400")]
LATEST = [
    ("bogusKey", "bogus-3"),
    ("orderNumberKey", "orderNumber-8400"),
    ("transactionKey", "transaction-3000"),
]
TOTALS = [("ABCD-1111", "5833.98"), ("HDTV-2333", "9000.21")]
COMBINED = [
    ("10261998", "remodel-1", "remodel-1", "dishwasher-1333", "Elizabeth Jones"),
    ("10261999", "remodel-2", "remodel-2", "stove-2333", "Art Vandelay"),
]
COMBINED_COLUMNS = ("key", "electronic_order_id", "appliance_order_id", "appliance_id", "user_name")


def test_order_numbers(spark):
    assert data.rows_of(order_numbers(data.text_records(spark)), "key", "value") == ORDER_ROWS


@pytest.mark.parametrize("files", [1, 5])
def test_order_numbers_stream(spark, tmp_path, files):
    stream = data.streamed(job_session(spark), data.text_records(spark), tmp_path / "in", files)
    result = streaming.run_order_numbers(spark, Job("numbers", str(tmp_path / "job")), stream)
    assert data.rows_of(result, "key", "value") == ORDER_ROWS


def test_table(spark):
    upserts = data.envelope(spark, data.UPSERTS)
    assert data.rows_of(latest_by_key(upserts), "key", "value") == LATEST
    assert data.rows_of(large_latest(upserts), "key", "value") == [
        ("orderNumberKey", "8400"),
        ("transactionKey", "3000"),
    ]
    assert data.rows_of(large_updates(upserts), "key", "value") == [
        ("orderNumberKey", "1001"),
        ("orderNumberKey", "3330"),
        ("orderNumberKey", "5000"),
        ("orderNumberKey", "8400"),
        ("transactionKey", "2000"),
        ("transactionKey", "3000"),
    ]


@pytest.mark.parametrize("files", [1, 5])
def test_table_stream(spark, tmp_path, files):
    stream = data.streamed(job_session(spark), data.envelope(spark, data.UPSERTS), tmp_path / "in", files)
    result = streaming.run_table(spark, Job("table", str(tmp_path / "job")), stream)
    assert data.rows_of(result, "key", "value") == LATEST


def test_totals(spark):
    totals = total_by_key(data.electronic_orders(spark)).withColumn("total", number_text(F.col("total")))
    assert data.rows_of(totals) == TOTALS


def test_running_totals(spark):
    rows = running_total(data.electronic_orders(spark)).orderBy("key", "offset")
    assert [(r.key, str(r.text)) for r in rows.select("key", number_text(F.col("total")).alias("text")).collect()] == [
        ("ABCD-1111", "4500.0"),
        ("ABCD-1111", "5833.98"),
        ("HDTV-2333", "2000.0"),
        ("HDTV-2333", "3999.23"),
        ("HDTV-2333", "9000.21"),
    ]


def test_fold_in_text_steps(spark):
    """The total held as text, parsed and formatted again at every step."""

    def add(total, more):
        return number_text(total.cast("double") + more.cast("double"))

    folded = ordered_fold(data.electronic_orders(spark), F.col("price").cast("string"), F.lit("0.0"), add, add)
    assert data.rows_of(folded) == TOTALS


@pytest.mark.parametrize("files", [1, 5])
def test_totals_stream(spark, tmp_path, files):
    stream = data.streamed(job_session(spark), data.electronic_orders(spark), tmp_path / "in", files)
    result = streaming.run_totals(spark, Job("totals", str(tmp_path / "job")), stream)
    assert data.rows_of(result.withColumn("total", number_text(F.col("total")))) == TOTALS


def test_combined_orders(spark):
    result = combined_orders(data.appliances(spark), data.electronics(spark), data.users(spark))
    assert data.rows_of(result, *COMBINED_COLUMNS) == COMBINED


@pytest.mark.parametrize("files", [1, 2])
def test_combined_orders_stream(spark, tmp_path, files):
    session = job_session(spark)
    result = streaming.run_combined_orders(
        spark,
        Job("combined", str(tmp_path / "job")),
        data.streamed(session, data.appliances(spark), tmp_path / "a", files),
        data.streamed(session, data.electronics(spark), tmp_path / "e", files),
        data.streamed(session, data.users(spark), tmp_path / "u", files),
    )
    assert data.rows_of(result, *COMBINED_COLUMNS) == COMBINED


def test_combined_order_time_is_the_wall_clock_on_request(spark):
    inputs = (data.appliances(spark), data.electronics(spark), data.users(spark))
    fixed = combined_orders(*inputs).select("time").distinct().collect()
    assert [r.time for r in fixed] == [int(data.T0.timestamp() * 1000)]
    now = combined_orders(*inputs, wall_clock=True).select(F.min("time")).first()[0]
    assert now > fixed[0].time
