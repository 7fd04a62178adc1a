"""The shared folder, topics that lose nothing, times without zone, and other edges."""

import math
import subprocess
import sys
from fractions import Fraction
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from keyrill.folders import exists, remove, work_folder
from keyrill.operators.joins import enrich_asof, enrich_left, interval_join
from keyrill.operators.slices import sliced
from keyrill.operators.totals import running_total
from keyrill.plans.events import utc
from keyrill.sources.topics import Topic
from keyrill.streaming import pipelines as streaming
from keyrill.streaming.jobs import Job, finish, job_session
from tests import data


def test_a_local_session_without_a_folder_gets_its_own():
    root = Path(__file__).parents[1]
    code = (
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from keyrill.folders import shared_folder, _own\n"
        "import tempfile\n"
        "spark.conf.get = lambda *a: None\n"
        "one = shared_folder(spark)\n"
        "assert one == shared_folder(spark) and list(_own.values()) == [one]\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=200)


def test_crashed_loads_are_repeated(spark, tmp_path):
    topic = Topic(str(tmp_path / "topic"))
    crashed = tmp_path / "topic" / "load=a" / "_temporary"
    crashed.mkdir(parents=True)
    records = data.text_records(spark)
    for _ in range(2):
        topic.load(records, "a")
        assert data.rows_of(topic.read(spark)) == data.rows_of(records)


def test_offsets_are_given_where_absent(spark, tmp_path):
    topic = Topic(str(tmp_path / "topic"))
    records = data.text_records(spark).drop("offset")
    for load in ("a", "b", "b"):
        topic.load(records, load)
    found = topic.read(spark).select("offset").collect()
    assert len({r.offset for r in found}) == len(found) == 2 * len(data.TEXT)
    by_load = spark.read.parquet(topic.path).groupBy("load").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    a, b = by_load.orderBy("load").collect()
    assert a.high < b.low


def test_writers_do_not_hide_each_other(spark, tmp_path):
    source, sink = Topic(str(tmp_path / "in")), Topic(str(tmp_path / "out"))
    source.load(data.text_records(spark), "a")
    sink.load(data.text_records(spark), "before")
    for name in ("w1", "w2"):
        finish(sink.write_stream(source.read(spark, streaming=True), str(tmp_path / name), name))
    sink.load(data.text_records(spark), "after")
    assert sink.read(spark).count() == 4 * len(data.TEXT)


def test_folders(spark):
    path = work_folder(spark, "x")
    assert not exists(spark, path)
    spark.range(3).write.parquet(path)
    assert exists(spark, f"{path}/_SUCCESS")
    remove(spark, path)
    assert not exists(spark, path)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_without_zone_are_utc(spark, zone):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", zone)
    times = ["2024-03-10 02:30:00.000001", "2024-11-03 01:30:00", "1969-12-31 23:59:59.5"]
    rows = session.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    found = [r.us for r in rows.select(F.unix_micros(utc("ts")).alias("us")).collect()]
    assert found == [1710037800000001, 1730597400000000, -500000]


def test_records_that_have_the_field_already(spark):
    records = spark.createDataFrame([("a", "own", 1), ("b", "own", 2), ("c", None, 3), (None, "own", 4)], "key string, name string, offset bigint")
    records = records.withColumn("timestamp", F.lit(data.at(5)))
    names = spark.createDataFrame([("a", "table", data.at(1), 0), ("b", None, data.at(1), 1)], data.USER)
    want = [("a", "table"), ("b", "own"), ("c", "")]
    assert data.rows_of(enrich_left(records, names, {"name": ""}), "key", "name") == want
    assert data.rows_of(enrich_asof(records, names, {"name": ""}), "key", "name") == want


def test_late_updates_in_batch_and_stream(spark, tmp_path):
    """An update that comes later but is older does not replace a newer one."""
    updates = [[("u", "A", data.at(10), 0)], [("u", "B", data.at(5), 1)], [("v", "C", data.at(30), 2)]]
    records = [("u", 1, data.at(20), 10), ("u", 2, data.at(7), 11)]
    schema = "key string, v bigint, timestamp timestamp, offset bigint"
    batch = enrich_asof(spark.createDataFrame(records, schema), spark.createDataFrame(sum(updates, []), data.USER), {"name": ""}, "name")
    want = [("u", 1, "A"), ("u", 2, "B")]
    assert data.rows_of(batch, "key", "v", "name") == want

    session, job = job_session(spark), Job("late", str(tmp_path / "job"))
    user = spark.createDataFrame([], data.USER).schema
    record = spark.createDataFrame([], schema).schema
    # one micro-batch each; the last record lets the watermark pass
    arriving = [[("v", 0, data.at(1), 9)], records, [("w", 0, data.at(40), 12)]]
    for mine, rows in zip(arriving, updates):
        spark.createDataFrame(rows, user).coalesce(1).write.mode("append").parquet(str(tmp_path / "users"))
        spark.createDataFrame(mine, record).coalesce(1).write.mode("append").parquet(str(tmp_path / "records"))
    stream, names = (
        session.readStream.schema(s).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / f)) for s, f in ((record, "records"), (user, "users"))
    )
    found = streaming.run_enrich(session, job, stream, names, {"name": ""}, "name")
    assert data.rows_of(found, "key", "v", "name") == [*want, ("v", 0, "")]


def test_empty_streams_give_empty_tables(spark, tmp_path):
    session = spark.newSession()
    (tmp_path / "in").mkdir()
    stream = session.readStream.schema("key string, price double, timestamp timestamp, offset bigint").parquet(str(tmp_path / "in"))
    found = streaming.run_totals(session, Job("totals", str(tmp_path / "job")), stream)
    assert found.columns == ["key", "total"] and found.count() == 0


def test_interval_of_no_minutes(spark):
    rows = spark.createDataFrame([("k", data.at(1), 1), ("k", data.at(2), 2)], "key string, timestamp timestamp, offset bigint")
    found = interval_join(rows, rows, [F.col("l.offset").alias("a"), F.col("r.offset").alias("b")], minutes=0)
    assert data.rows_of(found) == [(1, 1), (2, 2)]


def test_doubles_do_not_depend_on_the_cut(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 3).cast("string").alias("key"), (F.col("id") * 0.1 + 0.7).alias("price"), F.lit(data.at(1)).alias("timestamp"), F.col("id").alias("offset")
    )
    plain, cut = (data.rows_of(running_total(rows, rows_per_slice=n), "offset", "total") for n in (10_000, 90))
    assert plain == cut


def test_any_number_of_hot_keys(spark):
    rows = spark.range(30_000).select(
        F.floor(F.col("id") / 10).cast("string").alias("key"), F.lit(1).alias("price"), F.lit(data.at(1)).alias("timestamp"), F.col("id").alias("offset")
    )
    cut = sliced(rows, rows_per_slice=5)
    assert cut.rows.where("slice < 0").count() == 0 and cut.slices.select("key").distinct().count() == 3000
    found = running_total(rows, rows_per_slice=5)
    assert found.where(F.col("total") != F.col("offset") % 10 + 1).count() == 0


def test_a_topic_takes_writers_of_one_name(spark, tmp_path):
    """A second writer of the same name with a checkpoint of its own adds its records; a batch written again is not read again."""
    topic, session = Topic(str(tmp_path / "topic")), spark.newSession()
    schema = "key string, value string, timestamp timestamp, offset bigint"
    (tmp_path / "topic").mkdir()
    for number in range(2):
        rows = spark.range(number * 1000, number * 1000 + 1000).selectExpr("string(id) key", "string(id) value", "timestamp_seconds(0) timestamp", "id offset")
        rows.write.parquet(str(tmp_path / f"in{number}"))
        stream = session.readStream.schema(schema).parquet(str(tmp_path / f"in{number}"))
        finish(topic.write_stream(stream, str(tmp_path / f"checkpoint{number}"), "w"))
    assert topic.read(spark).count() == 2000

    def downstream():
        copy = topic.read(session, streaming=True).writeStream.option("checkpointLocation", str(tmp_path / "reader"))
        finish(copy.trigger(availableNow=True).format("parquet").option("path", str(tmp_path / "copy")).start())
        return spark.read.parquet(str(tmp_path / "copy")).count()

    assert downstream() == 2000
    # a crash between writing a batch and noting it: the batch comes again
    for note in (tmp_path / "checkpoint1" / "commits").iterdir():
        note.unlink()
    stream = session.readStream.schema(schema).parquet(str(tmp_path / "in1"))
    finish(topic.write_stream(stream, str(tmp_path / "checkpoint1"), "w"))
    assert topic.read(spark).count() == 2000 and downstream() == 2000


@pytest.mark.parametrize("values", [[float("nan"), 1.0, 2.0], [1e30, 1.0, -1e30], [1e-12] * 6, [float("inf"), 1.0, float("-inf"), 2.0], [1e28] * 5, [0.1] * 9, [1 / 3, 1e-300, 5e15, 2e16]])
def test_totals_of_all_doubles(spark, values):
    rows = spark.createDataFrame([("k", v, data.at(i), i) for i, v in enumerate(values)], "key string, price double, timestamp timestamp, offset bigint")
    plain, cut = ([t for _, t in data.rows_of(running_total(rows, rows_per_slice=n), "offset", "total")] for n in (100, 2))
    finite = all(map(math.isfinite, values))
    want = [float(sum(map(Fraction, values[: i + 1]))) if finite else sum(values[: i + 1]) for i in range(len(values))]
    for found in (plain, cut):
        assert all(x == pytest.approx(y, rel=1e-15, abs=0, nan_ok=True) for x, y in zip(found, want, strict=True))
