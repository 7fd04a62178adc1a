"""Hot keys: cutting them changes where the work is done, never the results."""

import random

import pytest
from pyspark.sql import functions as F

from keyrill.operators.joins import enrich_asof
from keyrill.operators.slices import sliced
from keyrill.operators.totals import ordered_fold, running_total
from keyrill.operators.windows import session_sum, session_sum_stream
from keyrill.plans import registry
from tests import data

ROWS = 3_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows on one key, in a burst with many equal times; the rest over 40 keys and some outliers."""
    rnd = random.Random(5)
    rows = []
    for i in range(ROWS):
        if i % 3 == 0:
            rows.append(("hot", rnd.randrange(100), data.at(seconds=rnd.randrange(40)), i))
        else:
            rows.append((f"k{rnd.randrange(40)}", rnd.randrange(100), data.at(rnd.randrange(60 * 24)), i))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, v bigint, timestamp timestamp, offset bigint").repartition(7)
    return df, sorted(rows, key=lambda r: (r[0], r[2], r[3]))


def test_slices_are_small_and_in_order(skewed):
    df, _ = skewed
    cut = sliced(df, rows_per_slice=100)
    sizes = cut.rows.groupBy("key", "slice").agg(
        F.count("*").alias("n"),
        F.min(F.struct("timestamp", "offset")).alias("first"),
        F.max(F.struct("timestamp", "offset")).alias("last"),
    )
    by_key = {}
    for r in sizes.orderBy("key", "slice").collect():
        by_key.setdefault(r.key, []).append(r)
    assert len(by_key["hot"]) == 10
    assert max(r.n for r in by_key["hot"]) <= 200  # even though the hot key has only 40 different times
    assert all(len(parts) == 1 for key, parts in by_key.items() if key != "hot")
    for before, after in zip(by_key["hot"], by_key["hot"][1:]):
        assert before.last < after.first


def test_short_slices_do_not_cost_a_task_each(skewed, spark):
    df, _ = skewed
    cut = sliced(df, rows_per_slice=2)
    assert cut.slices.count() >= ROWS // 2
    files = sum("/hot-rows-" in name for name in cut.rows.inputFiles())
    assert 1 <= files <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert cut.rows.groupBy("key", "slice").count().agg(F.max("count")).first()[0] == 2


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_hot_keys_are_not_gathered_by_key(skewed, spark):
    """A join hashed by key would put all rows of a hot key into one task."""
    df, _ = skewed
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sliced(df, rows_per_slice=100).rows._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_few_rows_do_not_cost_many_tasks(skewed, spark):
    df, _ = skewed
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        files = sum("/hot-rows-" in name for name in sliced(df, rows_per_slice=10).rows.inputFiles())
        assert 1 < files <= 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_both_sums_of_doubles_are_carried_at_once(skewed):
    df, _ = skewed
    assert _plan(running_total(df.withColumn("v", F.col("v") / 8), "v", rows_per_slice=100)).count("LeftOuter") == 1


def test_running_totals_write_no_columns_they_do_not_use(spark, tmp_path):
    events = spark.range(200).selectExpr(
        "id event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id * 7) ts", "id % 4 user_id", "'click' event_type",
        "double(id) value", "'{\"k\": 1}' props",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    for name in ("running_total_split", "running_total_double_split", "running_total_extremes"):
        rows = [f for f in registry.QUERIES[name](spark, str(tmp_path)).inputFiles() if "/hot-rows-" in f]
        assert rows and "order_id" not in spark.read.parquet(*rows).columns


def test_sessions_of_slices_are_summed_once(skewed):
    df, rows = skewed
    sums = session_sum(df, F.col("v").cast("decimal(18,2)"), 10, rows_per_slice=100)
    assert any("/session-parts-" in name for name in sums.inputFiles())
    assert sums.schema["total"].dataType == session_sum(df, F.col("v").cast("decimal(18,2)"), 10).schema["total"].dataType
    assert sums.agg(F.sum("records")).first()[0] == len(rows)


def test_plain_plan_without_hot_keys(skewed):
    df, _ = skewed
    assert sliced(df).slices is None


@pytest.mark.parametrize("rows_per_slice", [10, 100, 10_000])
def test_running_total(skewed, rows_per_slice):
    df, rows = skewed
    want, total, last = [], 0, None
    for key, v, _, offset in rows:
        total = v + (total if key == last else 0)
        last = key
        want.append((offset, total))
    got = running_total(df, "v", rows_per_slice=rows_per_slice)
    assert sorted(tuple(r) for r in got.select("offset", "total").collect()) == sorted(want)


def test_running_total_keeps_its_type(skewed):
    df, _ = skewed
    priced = df.withColumn("price", F.col("v").cast("decimal(18,2)"))
    plain, cut = running_total(priced), running_total(priced, rows_per_slice=50)
    assert plain.schema["total"].dataType == cut.schema["total"].dataType
    assert set(plain.columns) == set(cut.columns)


@pytest.mark.parametrize("rows_per_slice", [20, 10_000])
def test_ordered_fold(skewed, rows_per_slice):
    """Text concatenation: any change of order would show."""
    df, rows = skewed
    want = {}
    for key, v, _, _ in rows:
        want[key] = want.get(key, "") + f"{v},"

    def joined(a, b):
        return F.concat(a, b)

    text = F.concat(F.col("v").cast("string"), F.lit(","))
    got = ordered_fold(df, text, F.lit(""), joined, joined, rows_per_slice=rows_per_slice, block=3)
    assert {r.key: r.result for r in got.collect()} == want


@pytest.mark.parametrize("rows_per_slice", [15, 10_000])
def test_asof(spark, skewed, rows_per_slice):
    df, rows = skewed
    # few updates, so that most slices have none of their own and live on what is carried into them
    updates = [r for r in rows if r[3] % 97 == 0]
    names = [(key, None if v % 5 == 0 else f"n{offset}", ts, offset) for key, v, ts, offset in updates]
    changes = spark.createDataFrame(names, data.USER)
    want = []
    for key, _, ts, offset in rows:
        past = [n for n in names if n[0] == key and n[2] <= ts]
        newest = max(past, key=lambda n: (n[2], n[3]))[1] if past else None
        want.append((offset, newest or ""))
    got = enrich_asof(df, changes, {"name": ""}, "name", rows_per_slice=rows_per_slice)
    assert sorted(tuple(r) for r in got.select("offset", "name").collect()) == sorted(want)


@pytest.mark.parametrize("gap", [1, 10, 200])
@pytest.mark.parametrize("rows_per_slice", [15, 10_000])
def test_sessions_equal_the_built_in_ones(skewed, gap, rows_per_slice):
    df, _ = skewed
    columns = ("key", "start", "end", "records", "total")
    ours = session_sum(df, F.col("v"), gap, rows_per_slice=rows_per_slice)
    assert data.rows_of(ours, *columns) == data.rows_of(session_sum_stream(df, F.col("v"), gap), *columns)


def test_measuring_the_inputs_instead(skewed, spark):
    df, _ = skewed
    changes = spark.createDataFrame([("hot", "n", data.at(), 0)], data.USER)
    plain = enrich_asof(df, changes, {"name": ""})
    measured = enrich_asof(df, changes, {"name": ""}, rows_per_slice=50, measure=df.where("key = 'hot'"))
    assert data.rows_of(plain, "offset", "name") == data.rows_of(measured, "offset", "name")
