"""Topics in directories, layouts, settings, and the optional connectors."""

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from keyrill.schemas import ENVELOPE, USER
from keyrill.sources.codecs import decode_avro, decode_text, encode_text
from keyrill.sources.settings import load_settings, with_prefix
from keyrill.sources.topics import PARTITIONS, Topic, kafka_sink, laid_out, partition_of
from keyrill.streaming.jobs import finish
from tests import data


def test_load_once_and_read_back(spark, tmp_path):
    topic = Topic(str(tmp_path / "topic"))
    records = data.text_records(spark)
    for _ in range(2):
        topic.load(records, "seed")
    assert data.rows_of(topic.read(spark)) == data.rows_of(records)
    topic.load(records.withColumn("offset", F.col("offset") + 100), "more")
    assert topic.read(spark).count() == 2 * len(data.TEXT)
    topic.load(records.limit(1), "more", replace=True)
    assert topic.read(spark).count() == len(data.TEXT) + 1
    assert topic.read(spark).columns == ENVELOPE.names


def test_explicit_partitions_are_kept_and_pruned(spark, tmp_path):
    topic = Topic(str(tmp_path / "topic"))
    topic.load(data.text_records(spark), "seed")
    one = topic.read(spark).where("partition = 1")
    assert data.rows_of(one, "value") == [("bogus-1",), ("bogus-2",)]
    assert "PartitionFilters: [isnotnull(partition" in one._jdf.queryExecution().executedPlan().toString()


def test_keys_choose_their_partition(spark):
    df = spark.range(1000).select((F.col("id") % 50).cast("string").alias("key"))
    placed = df.withColumn("p", partition_of(F.col("key"), PARTITIONS))
    assert placed.select("key", "p").distinct().count() == 50
    assert {r.p for r in placed.select("p").distinct().collect()} <= set(range(PARTITIONS))
    assert "RebalancePartitions" in laid_out(df)._jdf.queryExecution().analyzed().toString()


def test_topic_as_stream_source_and_sink(spark, tmp_path):
    source, sink = Topic(str(tmp_path / "in")), Topic(str(tmp_path / "out"))
    source.load(data.text_records(spark), "a")
    stream = source.read(spark, streaming=True)
    finish(sink.write_stream(stream, str(tmp_path / "c"), "copy"))
    source.load(data.text_records(spark).withColumn("offset", F.col("offset") + 100), "b")
    finish(sink.write_stream(source.read(spark, streaming=True), str(tmp_path / "c"), "copy"))
    assert data.rows_of(sink.read(spark)) == data.rows_of(source.read(spark))


def test_text_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"k"), bytearray("größer-1".encode()))], "key binary, value binary")
    assert data.rows_of(decode_text(df)) == [("k", "größer-1")]
    assert data.rows_of(decode_text(encode_text(decode_text(df)))) == [("k", "größer-1")]
    assert kafka_sink(data.text_records(spark)).columns == ["key", "value", "partition"]


def test_settings(tmp_path):
    path = tmp_path / "streams.properties"
    path.write_text("# comment\nbasic.input.topic=in-topic\n\nurl = http://host:1/?a=b\n!x\nread.maxFilesPerTrigger=1\n")
    settings = load_settings(str(path))
    assert settings == {"basic.input.topic": "in-topic", "url": "http://host:1/?a=b", "read.maxFilesPerTrigger": "1"}
    assert with_prefix(settings, "read.") == {"maxFilesPerTrigger": "1"}


def test_connectors_that_are_not_installed_say_so(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        Topic("t", servers="host:9092").read(spark)
    df = spark.createDataFrame([("k", bytearray(b"\0"))], "key string, value binary")
    with pytest.raises((PySparkException, TypeError, Exception), match="(?i)avro"):
        decode_avro(df, USER, "User").collect()
