"""Streams equal batch, resume where they stopped, and may repeat a batch."""

import datetime
import time
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyrill.operators.joins import enrich_asof
from keyrill.operators.records import tap
from keyrill.operators.rollups import windowed_rollup
from keyrill.operators.totals import total_by_key
from keyrill.operators.windows import session_sum, tumbling_sum
from keyrill.plans import events as ev
from keyrill.plans.pipelines import combined_orders, join_orders, order_numbers
from keyrill.sources.topics import Topic
from keyrill.streaming import pipelines as streaming
from keyrill.streaming.jobs import Job, TapLog, finish, job_session, shared_folder, stop, work_folder
from keyrill.streaming.ordered import Fold, InOrder, Silence, Step
from keyrill.streaming.state import partial_totals
from keyrill.streaming.upserts import UpsertTable
from tests import data

N = 120


@pytest.fixture(scope="module")
def orders(spark):
    rows = [(f"u{i % 7}", f"o{i}", f"i{i % 3}", data.at(i * 4), i) for i in range(N)]
    return data.appliances(spark, rows).withColumn("price", (F.col("offset") % 10).cast("double"))


@pytest.fixture(scope="module")
def names(spark):
    rows = [(f"u{i % 5}", None if i % 4 == 3 else f"n{i}", data.at(i * 30 - 2), i) for i in range(16)]
    return data.users(spark, rows)


def test_job_session_leaves_the_callers_settings_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session = job_session(spark, 3)
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"


def test_folders_come_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_resume_and_start_over(spark, tmp_path, orders):
    """A stopped job goes on with the new files only; a fresh one reads all again."""
    session, folder = job_session(spark), tmp_path / "in"
    first, second = orders.where("offset < 50"), orders.where("offset >= 50")
    job = Job("totals", str(tmp_path / "job"))
    streaming.run_totals(spark, job, data.streamed(session, first, folder, 2))
    table = streaming.run_totals(spark, job, data.streamed(session, second, folder, 2))
    assert data.rows_of(table, "key", "total") == data.rows_of(total_by_key(orders))
    batches = spark.read.parquet(job.output + "/changes").select("batch").distinct().count()
    assert batches == 4
    stream = session.readStream.schema(orders.schema).parquet(str(folder))
    again = streaming.run_totals(spark, Job.fresh(spark, "totals"), stream)
    assert data.rows_of(again, "key", "total") == data.rows_of(total_by_key(orders))


@pytest.mark.parametrize("files, salts", [(1, 1), (4, 1), (4, 3)])
def test_interval_join(spark, tmp_path, orders, files, salts):
    session = job_session(spark)
    right = orders.withColumnRenamed("appliance_id", "electronic_id")
    result = streaming.run_join(
        spark,
        Job("join", str(tmp_path / "job")),
        data.streamed(session, orders, tmp_path / "l", files),
        data.streamed(session, right, tmp_path / "r", files),
        salts=salts,
    )
    columns = ("key", "appliance_order_id", "electronic_order_id", "timestamp")
    assert data.rows_of(result, *columns) == data.rows_of(join_orders(orders, right), *columns)


def test_enrichment_in_batches_that_advance_together(spark, tmp_path, orders, names):
    """Cut by time into four batches on both sides, the stream gives the batch result up to the watermark."""
    session = job_session(spark)

    def by_time(df, name):
        folder = str(tmp_path / name)
        for lower in (-10, 118, 238, 358):
            upper = 10_000 if lower == 358 else lower + 120 if lower > 0 else 118
            part = df.where(F.col("timestamp").between(F.lit(data.at(lower)), F.lit(data.at(upper, -0.000001))))
            part.coalesce(1).write.mode("append").parquet(folder)
        return session.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)

    got = streaming.run_enrich(spark, Job("enrich", str(tmp_path / "job")), by_time(orders, "o"), by_time(names, "n"), {"name": ""}, "name")
    last = names.agg(F.max("timestamp")).first()[0]
    want = enrich_asof(orders, names, {"name": ""}, "name").where(F.col("timestamp") <= F.lit(last))
    assert 100 < want.count() < N
    assert data.rows_of(got, "offset", "name", "price", "timestamp") == data.rows_of(want, "offset", "name", "price", "timestamp")


def test_older_records_see_older_versions(spark, tmp_path):
    """Updates and records of one key arrive in any order within the delay."""
    session = job_session(spark)
    record = spark.createDataFrame([], "key string, v bigint, timestamp timestamp, offset bigint").schema
    user = spark.createDataFrame([], data.USER).schema
    arriving = [
        ([("u", 3, data.at(30), 3)], [("u", "C", data.at(25), 2)]),
        ([("u", 1, data.at(10), 1)], [("u", "A", data.at(5), 0)]),
        ([("u", 2, data.at(20), 2)], [("u", "B", data.at(15), 1)]),
        ([("w", 9, data.at(200), 9)], [("w", "W", data.at(200), 9)]),
    ]
    for records, updates in arriving:
        spark.createDataFrame(records, record).coalesce(1).write.mode("append").parquet(str(tmp_path / "r"))
        spark.createDataFrame(updates, user).coalesce(1).write.mode("append").parquet(str(tmp_path / "u"))
    stream, names = (
        session.readStream.schema(s).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / f)) for s, f in ((record, "r"), (user, "u"))
    )
    got = streaming.run_enrich(spark, Job("late", str(tmp_path / "job")), stream, names, {"name": ""}, "name", "1 hour")
    assert data.rows_of(got, "key", "v", "name") == [("u", 1, "A"), ("u", 2, "B"), ("u", 3, "C")]


def test_combined_orders_in_one_batch(spark, tmp_path, orders, names):
    session = job_session(spark)
    right = orders.withColumnRenamed("appliance_id", "electronic_id")
    result = streaming.run_combined_orders(
        spark,
        Job("combined", str(tmp_path / "job")),
        data.streamed(session, orders, tmp_path / "l"),
        data.streamed(session, right, tmp_path / "r"),
        data.streamed(session, names, tmp_path / "u"),
    )
    last = names.agg(F.max("timestamp")).first()[0]
    want = combined_orders(orders, right, names).where(F.col("timestamp") <= F.lit(last))
    columns = ("key", "appliance_order_id", "electronic_order_id", "user_name", "time")
    assert want.count() > 100
    assert data.rows_of(result, *columns) == data.rows_of(want, *columns)


class _Pairs(Step):
    """A user's step: every second record with the one before it."""

    state = "before bigint"
    output = "key string, first bigint, second bigint"

    def start(self):
        return (None,)

    def step(self, state, row):
        if state[0] is None:
            return (row["offset"],), []
        return (None,), [(row["key"], state[0], row["offset"])]


def test_a_users_step_on_shuffled_input(spark, tmp_path, orders):
    """Records arrive in an order that has nothing to do with time; the job is stopped and resumed between files."""
    session, folder = job_session(spark), str(tmp_path / "in")
    job = Job("pairs", str(tmp_path / "job"))
    for part in range(3):
        orders.where(F.col("offset") * 7 % 3 == part).coalesce(1).write.mode("append").parquet(folder)
        stream = session.readStream.schema(orders.schema).parquet(folder)
        got = streaming.run_step(spark, job, stream, _Pairs(), "1 day")
    assert got.count() == 0
    orders.limit(1).withColumn("timestamp", F.lit(data.at(10_000))).write.mode("append").parquet(folder)
    got = streaming.run_step(spark, job, session.readStream.schema(orders.schema).parquet(folder), _Pairs(), "1 day")
    want = [(f"u{u}", i, i + 7) for u in range(7) for i in range(u, N - 7, 14)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_alarms_after_silence(spark, tmp_path):
    schema = "key string, timestamp timestamp, offset bigint"
    rows = [("a", data.at(0), 0), ("a", data.at(30), 1), ("b", data.at(40), 2), ("a", data.at(120), 3), ("c", data.at(300), 4)]
    df = spark.createDataFrame(rows, schema)
    got = streaming.run_step(spark, Job("silence", str(tmp_path / "job")), data.streamed(job_session(spark), df, tmp_path / "in"), Silence(3_600_000_000))
    alarms = [(r.key, r.last_us, r.alarm_us - r.last_us, r.records) for r in got.collect()]
    micros = {m: int(df.where(F.col("timestamp") == F.lit(data.at(m))).select(F.unix_micros("timestamp")).first()[0]) for m in (30, 40, 120)}
    hour = 3_600_000_000
    assert sorted(alarms) == [("a", micros[30], hour, 2), ("a", micros[120], hour, 1), ("b", micros[40], hour, 1)]


def test_changes_of_a_filtered_table_replay_to_it_after_every_batch(spark, tmp_path):
    """A key whose newest number fails the filter, or that is deleted, is taken back."""
    session, folder = job_session(spark), str(tmp_path / "in")
    updates = [("k", "n-2000"), ("k", "n-10"), ("m", "n-5"), ("k", "n-3000"), ("m", "n-4000"), ("m", None), ("k", "n-x")]
    schema = "key string, value string, timestamp timestamp, offset bigint"
    job = Job("changes", str(tmp_path / "job"))
    seen, expected = {}, []
    for i, (key, value) in enumerate(updates):
        spark.createDataFrame([(key, value, data.at(i), i)], schema).write.mode("append").parquet(folder)
        stream = session.readStream.schema(schema).parquet(folder)
        got = streaming.run_table_changes(spark, job, stream)
        seen[key] = value
        now = {k: v[2:] for k, v in seen.items() if v is not None and v[2:].isdigit() and int(v[2:]) > 1000}
        replayed = {}
        for r in got.orderBy("offset").collect():
            replayed[r.key] = r.value
        expected.append(now)
        assert {k: v for k, v in replayed.items() if v is not None} == now
    assert got.count() == 6


def test_totals_read_from_the_store(spark, tmp_path, orders):
    stream = data.streamed(job_session(spark), orders, tmp_path / "in", 4)
    job = Job("store", str(tmp_path / "job"))
    streaming.run_totals(spark, job, stream)
    got = streaming.read_store(spark, job)
    assert data.rows_of(got.select("key", "sum")) == data.rows_of(total_by_key(orders))


def test_split_and_enrichment_of_nothing(spark, tmp_path):
    session = job_session(spark)
    (tmp_path / "in").mkdir()
    texts = session.readStream.schema("key string, value string, timestamp timestamp, offset bigint").parquet(str(tmp_path / "in"))
    good, bad = streaming.run_split(spark, Job("split", str(tmp_path / "split")), texts)
    assert (good.count(), bad.count()) == (0, 0) and "reason" in bad.columns and "number" in good.columns
    names = session.readStream.schema(data.USER).parquet(str(tmp_path / "in"))
    found = streaming.run_enrich(spark, Job("enrich", str(tmp_path / "enrich")), texts, names, {"name": ""}, "name")
    assert found.count() == 0 and found.columns == ["key", "timestamp", "value", "offset", "name"]


def test_repeated_batch_is_written_over(spark, tmp_path):
    table = UpsertTable(str(tmp_path / "t"), ("key",))
    one = spark.createDataFrame([("a", 1), ("b", 1)], "key string, v int")
    two = spark.createDataFrame([("a", 2)], "key string, v int")
    for rows, batch in ((one, 0), (two, 1), (two, 1)):
        table.write_changes(rows, batch)
    assert data.rows_of(table.read(spark, one.schema)) == [("a", 2), ("b", 1)]


def test_stateful_totals_over_batches(spark, tmp_path, orders):
    stream = data.streamed(job_session(spark), orders, tmp_path / "in", 3)
    result = streaming.run_stateful_totals(spark, Job("state", str(tmp_path / "job")), stream, F.col("price"))
    want = orders.groupBy("key").agg(F.sum("price").cast("bigint"), F.count("*"))
    assert data.rows_of(result, "key", "total", "records") == data.rows_of(want)


def test_tumbling_windows(spark, tmp_path, orders):
    stream = data.streamed(job_session(spark), orders, tmp_path / "in", 4)
    result = streaming.run_tumbling(spark, Job("tumbling", str(tmp_path / "job")), stream, F.col("price"), 60)
    columns = ("key", "start", "end", "records", "total")
    assert data.rows_of(result, *columns) == data.rows_of(tumbling_sum(orders, F.col("price"), 60), *columns)


def test_samples_ten_minutes_late_still_count(spark, tmp_path):
    """Later ones do not, once the watermark has passed their window."""
    session = job_session(spark)
    schema = "metric string, labels map<string,string>, ts timestamp, value double"
    batches = [[(0, 1.0), (30, 2.0)], [(21, 4.0)], [(5, 8.0)]]
    folder = str(tmp_path / "in")
    for rows in batches:
        samples = [("m", {"kind": "a"}, data.at(minute, 1), value) for minute, value in rows]
        spark.createDataFrame(samples, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    result = streaming.run_rollup(spark, Job("rollup", str(tmp_path / "job")), stream, ("kind",))
    assert [v for _, v in data.rows_of(result, "tick", "value")] == [1.0, 4.0, 2.0]
    everything = windowed_rollup(spark.read.parquet(folder), ("kind",))
    assert everything.count() == 4


def test_good_and_bad_records(spark, tmp_path):
    df = data.envelope(spark, [("k", "x-1"), ("k", "x-y"), ("k", "x-2")])
    stream = data.streamed(job_session(spark), df, tmp_path / "in", 3)
    good, bad = streaming.run_split(spark, Job("split", str(tmp_path / "job")), stream)
    assert data.rows_of(good, "number") == [(1,), (2,)]
    assert data.rows_of(bad, "value", "reason") == [("x-y", "not a whole number")]


def test_strict_parse_fails_the_query(spark, tmp_path):
    df = data.envelope(spark, [("k", "orderNumber-x")])
    stream = data.streamed(job_session(spark), df, tmp_path / "in")
    with pytest.raises(StreamingQueryException):
        finish(Job("strict", str(tmp_path / "job")).append(order_numbers(stream, strict=True)))


def test_stop_is_timely(spark, tmp_path):
    df = data.envelope(spark, [("k", "orderNumber-2000")])
    stream = data.streamed(job_session(spark), df, tmp_path / "in")
    query = Job("endless", str(tmp_path / "job")).append(order_numbers(stream), available_now=False)
    assert query.isActive
    query.processAllAvailable()
    stop(query, 0.2)
    assert not query.isActive


def test_rows_of_a_hot_key_are_summed_before_the_shuffle(spark):
    rows = spark.range(20_000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 100 as string)) key", "1L amount")
    sums = rows.coalesce(1).mapInArrow(partial_totals, "key string, total bigint, records bigint")
    assert sums.where("key = 'hot'").count() <= 3
    assert sums.groupBy().sum("total", "records").first() == (20_000, 20_000)


def test_taps_of_a_stream(spark, tmp_path):
    session, log = job_session(spark), TapLog()
    session.streams.addListener(log)
    try:
        stream = tap(data.streamed(session, data.text_records(spark), tmp_path / "in", 3), "seen")
        finish(Job("tapped", str(tmp_path / "job")).append(tap(order_numbers(stream), "sent")))
        for _ in range(100):  # listeners are told a little later
            if log.records == {"seen": 7, "sent": 4}:
                break
            time.sleep(0.1)
    finally:
        session.streams.removeListener(log)
    assert log.records == {"seen": 7, "sent": 4}


def test_sessions_of_a_stream(spark, tmp_path, orders):
    """All but the sessions still open at the end."""
    stream = data.streamed(job_session(spark), orders, tmp_path / "in", 4)
    result = streaming.run_sessions(spark, Job("sessions", str(tmp_path / "job")), stream, F.col("price"), 20)
    columns = ("key", "start", "end", "records", "total")
    closed = session_sum(orders, F.col("price"), 20).where(F.col("end") <= F.lit(data.at((N - 1) * 4 - 10)))
    assert data.rows_of(result, *columns) == data.rows_of(closed, *columns)
    assert result.count() > 50


def test_running_totals_reach_a_topic_row_by_row(spark, tmp_path):
    rows = [("a", 3, "1.10", 1), ("a", 1, "2.20", 2), (None, 2, "9.00", 3), ("a", 2, None, 4), ("b", 5, "4.00", 5), ("a", 3, "0.05", 6), ("z", 90, "1.00", 7)]
    rows = [(key, data.at(minutes=m), price and Decimal(price), n) for key, m, price, n in rows]
    df = spark.createDataFrame(rows, "key string, timestamp timestamp, price decimal(18,2), offset bigint")
    stream = data.streamed(job_session(spark), df, tmp_path / "in", 3)
    sink = Topic(str(tmp_path / "topic"))
    got = streaming.run_running_totals(spark, Job("totals", str(tmp_path / "job")), stream, sink, delay="10 minutes")
    want = [("a", "2.20", 2), ("a", "3.30", 1), ("a", "3.35", 6), ("b", "4.00", 5)]
    assert sorted(map(tuple, got.select("key", "value", "offset").collect())) == sorted(want)


def test_running_totals_without_records(spark, tmp_path):
    df = spark.createDataFrame([], "key string, timestamp timestamp, price double, offset bigint")
    stream = data.streamed(job_session(spark), df, tmp_path / "in", 1)
    assert streaming.run_running_totals(spark, Job("none", str(tmp_path / "job")), stream, Topic(str(tmp_path / "topic"))).count() == 0


class _Held:
    """A state of Spark's that counts its calls."""

    def __init__(self, calls: list) -> None:
        self.calls, self.items = calls, []

    def _note(self, items=None):
        self.calls.append(1)
        if items is not None:
            self.items = items

    def exists(self):
        self._note()
        return bool(self.items)

    def get(self):
        self._note()
        return iter(self.items) if isinstance(self.items, list) else self.items

    def put(self, items):
        self._note(list(items))

    def update(self, item):
        self._note(item)

    def appendList(self, items):
        self._note([*self.items, *items])

    def clear(self):
        self._note([])


class _Handle:
    def __init__(self) -> None:
        self.calls = []

    def getListState(self, name, schema):
        return _Held(self.calls)

    getValueState = getListState

    def registerTimer(self, at_ms):
        self.calls.append(1)

    deleteTimer = registerTimer


class _Watermark:
    def getCurrentWatermarkInMs(self):
        return 1_000


def test_calls_of_the_state_do_not_grow_with_the_keys(spark):
    """All keys of a group are handled in one call; each key has its own state and order."""
    names = ("at_us", "side", "offset", "key", "amount")
    schema = T.StructType([T.StructField(n, T.StringType() if n == "key" else T.LongType()) for n in names])
    step = Fold("amount", (0,), "total bigint", lambda state, amount: (state[0] * 10 + amount,))
    processor, handle = InOrder(step, schema), _Handle()
    processor.init(handle)
    row = Row(*names)
    rows = [row(at * 1_000, 0, k, f"k{k}", at) for at in (3, 1, 2, 5_000) for k in range(100)]
    list(processor.handleInputRows((0,), iter(rows), _Watermark()))
    sent = list(processor.handleExpiredTimer((0,), _Watermark(), None))
    assert {(r.key, r.total) for r in sent if r.at_us == 3_000} == {(f"k{k}", 123) for k in range(100)}
    assert len(sent) == 300  # what the watermark has not passed waits
    assert len(handle.calls) < 25


@pytest.mark.parametrize("files", [1, 4])
def test_staged_events_of_many_files_are_as_many_batches(spark, tmp_path, files):
    """Each file has events of all times: cut by files, a part's later batches would come after its watermark."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    events = spark.range(1000).selectExpr(
        "id event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id * 7) ts", "id % 9 user_id", "'click' event_type",
        "double(id) value", "'{\"k\": 1}' props",
    )
    events.repartition(files).write.parquet(str(tmp_path / "events.parquet"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")  # each file is a partition of its own
    try:
        stream = ev.staged_events(spark, job_session(spark), str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    seen = []

    def write(batch, number):
        rows = batch.select(F.min("ts"), F.max("ts"), F.count("*")).first()
        seen.append(tuple(rows))

    finish(Job("staged", str(tmp_path / "job")).for_each_batch(stream, write, "append"))
    assert len(seen) == ev.STAGES
    assert sum(rows for _, _, rows in seen) == 1000
    for (_, newest, _), (oldest, _, _) in zip(seen, seen[1:]):
        assert oldest >= newest - datetime.timedelta(minutes=ev.LATE_MINUTES)
