"""Edge cases of parsing, keys, deletes, windows and enrichment."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from keyrill.functions.text import after_first_dash, number_text, whole_number
from keyrill.operators import quality
from keyrill.operators.joins import enrich_asof, enrich_left
from keyrill.operators.records import keep_containing, keep_number_above, map_after_dash, route_by_prefix, with_defaults
from keyrill.operators.tables import latest_by_key
from keyrill.operators.totals import running_total, total_by_key
from keyrill.operators.windows import hopping_sum, session_sum, tumbling_sum, with_event_time
from keyrill.plans.pipelines import combined_orders, join_orders, large_updates, order_numbers
from keyrill.schemas import ELECTRONIC_ORDER, ELECTRONIC_ORDER_DEFAULTS, USER, avro_schema
from keyrill.sources.codecs import decode_json, encode_json
from tests import data

EDGE_TEXTS = [
    ("nodash", "nodash", None),
    ("a-b-3", "b-3", None),
    ("x- 7", " 7", None),
    ("x-12.5", "12.5", None),
    ("x-+7", "+7", 7),
    ("x--7", "-7", -7),
    ("x-", "", None),
    ("x-7\n", "7\n", None),
    ("x-9223372036854775807", "9223372036854775807", 9223372036854775807),
    ("x-9223372036854775808", "9223372036854775808", None),
    (None, None, None),
]


def test_edge_texts(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in EDGE_TEXTS], "value string")
    text = after_first_dash(F.col("value"))
    got = [tuple(r) for r in df.select("value", text, whole_number(text)).collect()]
    assert got == EDGE_TEXTS


def test_number_texts(spark):
    df = spark.createDataFrame([(4500.0,), (9000.21,), (1e7,), (0.0,)], "v double")
    assert [r[0] for r in df.select(number_text(F.col("v"))).collect()] == ["4500.0", "9000.21", "1.0E7", "0.0"]


def test_contains_is_not_starts_with(spark):
    df = data.envelope(spark, [("k", "my orderNumber-2000"), ("k", "order-2000"), ("k", None)])
    assert data.rows_of(order_numbers(df), "value") == [("2000",)]


def test_limit_is_strict(spark):
    df = data.envelope(spark, [("k", "orderNumber-1000"), ("k", "orderNumber-1001")])
    assert data.rows_of(order_numbers(df), "value") == [("1001",)]


def test_bad_numbers_are_dropped_or_fail(spark):
    df = data.envelope(spark, [("k", "orderNumber-x"), ("k", "bogus-y"), ("k", "orderNumber-2000")])
    assert data.rows_of(order_numbers(df), "value") == [("2000",)]
    with pytest.raises(PySparkException, match="not a whole number"):
        order_numbers(df, strict=True).collect()


def test_strict_parse_sees_only_marked_records(spark):
    df = data.envelope(spark, [("k", "bogus-y"), ("k", "orderNumber-2000")])
    assert data.rows_of(order_numbers(df, strict=True), "value") == [("2000",)]


def test_null_keys(spark):
    df = data.envelope(spark, [(None, "orderNumber-2000"), ("k", "orderNumber-3000")])
    assert data.rows_of(order_numbers(df), "value") == [("2000",), ("3000",)]  # stateless: kept
    assert data.rows_of(latest_by_key(df), "key") == [("k",)]
    assert data.rows_of(large_updates(df), "key") == [("k",)]
    priced = df.withColumn("price", F.lit(1.0))
    assert data.rows_of(total_by_key(priced)) == [("k", 1.0)]
    assert data.rows_of(running_total(priced), "key") == [("k",)]
    assert data.rows_of(enrich_left(priced, data.users(spark), {"name": ""}), "key") == [("k",)]


def test_null_value_deletes_from_a_table(spark):
    df = data.envelope(spark, [("a", "x-1"), ("b", "x-2"), ("a", None), ("c", None), ("c", "x-3")])
    assert data.rows_of(latest_by_key(df), "key", "value") == [("b", "x-2"), ("c", "x-3")]


def test_null_value_is_skipped_by_totals(spark):
    rows = [("a", 1.0, data.at(0), 0), ("a", None, data.at(1), 1), ("b", None, data.at(2), 2)]
    df = spark.createDataFrame(rows, "key string, price double, timestamp timestamp, offset bigint")
    assert data.rows_of(total_by_key(df)) == [("a", 1.0)]
    assert data.rows_of(running_total(df), "key", "total") == [("a", 1.0)]


def test_latest_breaks_time_ties_by_offset(spark):
    rows = [("a", "old", data.at(), 0, 1), ("a", "new", data.at(), 0, 2)]
    df = spark.createDataFrame(rows, "key string, value string, timestamp timestamp, partition int, offset bigint")
    assert data.rows_of(latest_by_key(df), "value") == [("new",)]


@pytest.mark.parametrize("salts", [1, 3])
def test_join_window_is_closed_at_both_ends(spark, salts):
    left = data.appliances(spark, [("u", "a", "x", data.at(100), 0), (None, "n", "x", data.at(100), 1)])
    right = data.electronics(
        spark,
        [
            ("u", "at -31", "y", data.at(69), 0),
            ("u", "at -30", "y", data.at(70), 1),
            ("u", "at 0", "y", data.at(100), 2),
            ("u", "at +30", "y", data.at(130), 3),
            ("u", "at +30 and a bit", "y", data.at(130, 0.000001), 4),
            ("v", "other user", "y", data.at(100), 5),
            (None, "no user", "y", data.at(100), 6),
            ("u", None, None, data.at(100), 7),
        ],
    )
    joined = join_orders(left, right, salts=salts)
    assert data.rows_of(joined, "electronic_order_id") == [("at +30",), ("at -30",), ("at 0",)]


def test_join_keeps_every_pair(spark):
    left = data.appliances(spark, [("u", f"l{i}", "x", data.at(i * 7), i) for i in range(40)])
    right = data.electronics(spark, [("u", f"r{i}", "y", data.at(i * 11 - 60), i) for i in range(40)])
    want = sorted(
        (f"l{i}", f"r{j}") for i in range(40) for j in range(40) if abs(i * 7 - (j * 11 - 60)) <= 30
    )
    assert data.rows_of(join_orders(left, right), "appliance_order_id", "electronic_order_id") == want


def test_enrichment_sees_the_table_as_of_the_record(spark):
    orders = [("u", "first", "x", data.at(10), 0), ("u", "second", "x", data.at(20), 1), ("v", "third", "x", data.at(5), 2)]
    names = [
        ("u", "Ann", data.at(1), 0),
        ("u", "Anna", data.at(20), 1),  # at the same instant: before the record
        ("v", "Late", data.at(6), 2),
    ]
    result = combined_orders(data.appliances(spark, orders), data.electronics(spark, orders), data.users(spark, names))
    assert data.rows_of(result, "appliance_order_id", "electronic_order_id", "user_name") == [
        ("first", "first", "Ann"),
        ("first", "second", "Anna"),
        ("second", "first", "Anna"),
        ("second", "second", "Anna"),
        ("third", "third", ""),
    ]


def test_enrichment_sees_deletes(spark):
    names = [("u", "Ann", data.at(1), 0), ("u", None, data.at(2), 1)]
    orders = data.appliances(spark, [("u", "a", "x", data.at(1), 0), ("u", "b", "x", data.at(3), 1)])
    result = enrich_asof(orders, data.users(spark, names), {"name": ""}, deleted_when_null="name")
    assert data.rows_of(result, "order_id", "name") == [("a", "Ann"), ("b", "")]


def test_enrich_left_on_a_stream(spark, tmp_path):
    stream = data.streamed(spark, data.appliances(spark), tmp_path / "in")
    users = data.users(spark, [("10261998", "Elizabeth Jones", data.at(-1), 0)])
    query = (
        enrich_left(stream, users, {"name": ""})
        .writeStream.format("memory")
        .queryName("enriched")
        .trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "c"))
        .start()
    )
    query.awaitTermination()
    assert data.rows_of(spark.table("enriched"), "key", "name") == [("10261998", "Elizabeth Jones"), ("10261999", "")]


def test_dead_letters(spark):
    df = data.envelope(spark, [("k", text) for text, _, _ in EDGE_TEXTS])
    parsed = quality.with_parse_result(df)
    assert data.rows_of(quality.dead_letters(parsed), "value", "reason") == [
        ("a-b-3", "not a whole number"),
        ("nodash", "not a whole number"),
        ("x-", "empty number"),
        ("x- 7", "not a whole number"),
        ("x-12.5", "not a whole number"),
        ("x-7\n", "not a whole number"),
        ("x-9223372036854775808", "out of range"),
        (None, "no value"),
    ]
    assert data.rows_of(quality.good_records(parsed), "number") == [(-7,), (7,), (9223372036854775807,)]


def test_decoding_defaults(spark):
    values = ['{"order_id":"a","electronic_id":"e","user_id":"u","time":1}', '{"order_id":"b","price":2.5}', None]
    df = data.envelope(spark, [("k", v) for v in values])
    decoded = decode_json(df, ELECTRONIC_ORDER, ELECTRONIC_ORDER_DEFAULTS)
    assert data.rows_of(decoded, "order_id", "price") == [("a", 0.0), ("b", 2.5), (None, None)]
    again = decode_json(encode_json(decoded, ELECTRONIC_ORDER.names), ELECTRONIC_ORDER, ELECTRONIC_ORDER_DEFAULTS)
    assert data.rows_of(again.where("order_id = 'a'"), "price", "time") == [(0.0, 1)]


def test_defaults_and_routes(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "key string, user_name string")
    assert data.rows_of(with_defaults(df, {"user_name": ""})) == [("a", ""), ("b", "x")]
    routed = route_by_prefix(
        data.envelope(spark, [(None, v) for _, v, _ in data.TEXT]), [("order", "order", 0)], ("bogus", 1)
    )
    assert data.rows_of(routed, "key", "value", "partition") == sorted(data.TEXT)
    keys = route_by_prefix(
        data.envelope(spark, [(None, v) for _, v in data.UPSERTS]),
        [("orderNumber", "orderNumberKey", None), ("bogus", "bogusKey", None)],
        ("transactionKey", None),
    )
    assert data.rows_of(keys, "key", "value") == sorted(data.UPSERTS)


def test_avro_schema():
    import json

    schema = json.loads(avro_schema(ELECTRONIC_ORDER, "ElectronicOrder", ELECTRONIC_ORDER_DEFAULTS))
    assert schema["fields"][3] == {"name": "price", "type": "double", "default": 0.0}
    assert [f["name"] for f in json.loads(avro_schema(USER, "User"))["fields"]] == ["name", "address", "user_id"]


def test_event_time(spark):
    ms = int(data.at(5).timestamp() * 1000)
    df = spark.createDataFrame([("a", ms, data.at(1)), ("b", None, data.at(2))], "key string, time bigint, timestamp timestamp")
    assert data.rows_of(with_event_time(df), "key", "timestamp") == [("a", data.at(5)), ("b", data.at(2))]


def test_windows(spark):
    rows = [("k", 1, data.at(0), 0), ("k", 2, data.at(59, 59.9), 1), ("k", 4, data.at(60), 2), (None, 8, data.at(0), 3)]
    df = spark.createDataFrame(rows, "key string, v int, timestamp timestamp, offset bigint")
    assert data.rows_of(tumbling_sum(df, F.col("v"), 60), "start", "records", "total") == [
        (data.at(0), 2, 3),
        (data.at(60), 1, 4),
    ]
    panes = data.rows_of(hopping_sum(df, F.col("v"), 60, 30), "start", "records", "total")
    assert panes == [(data.at(-30), 1, 1), (data.at(0), 2, 3), (data.at(30), 2, 6), (data.at(60), 1, 4)]
    uneven = data.rows_of(hopping_sum(df, F.col("v"), 50, 40), "start", "total")
    assert sum(total for _, total in uneven) >= 7 and len(uneven) == len({s for s, _ in uneven})


def test_sessions_touch_at_the_gap(spark):
    rows = [("k", 1, data.at(0), 0), ("k", 2, data.at(30), 1), ("k", 4, data.at(60, 0.000001), 2)]
    df = spark.createDataFrame(rows, "key string, v int, timestamp timestamp, offset bigint")
    built_in = (
        df.groupBy("key", F.session_window("timestamp", "30 minutes").alias("w"))
        .agg(F.sum("v").alias("total"))
        .select("w.start", "w.end", "total")
    )
    ours = session_sum(df, F.col("v"), 30)
    assert data.rows_of(ours, "start", "end", "total") == data.rows_of(built_in)
    assert data.rows_of(ours, "total") == [(3,), (4,)]


def test_helpers_compose(spark):
    df = data.envelope(spark, [("k", "view-2000"), ("k", "click-5")])
    out = df.transform(keep_containing, "view").transform(map_after_dash).transform(keep_number_above, 1)
    assert data.rows_of(out, "value") == [("2000",)]
