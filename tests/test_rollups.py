"""Metric rollups against the fixture and against a plain evaluation, tick by tick."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from keyrill.operators import rollups
from keyrill.operators.rollups import Rule
from keyrill.plans.rules import BROKER, CLUSTER, PARTITION, PROMOTED_ATTRIBUTES, TOPIC, recording_rules
from keyrill.schemas import METRIC_SAMPLE
from keyrill.streaming.jobs import Job, job_session
from keyrill.streaming.pipelines import run_rules
from tests import data


def labels(cluster, broker, topic=None, partition=None):
    pairs = {CLUSTER: cluster, BROKER: broker, TOPIC: topic, PARTITION: partition}
    return {k: v for k, v in pairs.items() if v is not None}


FIXTURE = [
    ("log_size", labels("c1", "1", "a", "0"), 10, 10.0),
    ("log_size", labels("c1", "1", "a", "0"), 50, 12.0),
    ("log_size", labels("c1", "2", "a", "0"), 20, 7.0),
    ("log_size", labels("c1", "1", "__cluster_metadata", "0"), 20, 99.0),
    ("log_size", labels("c1", "1"), 30, 5.0),
    ("log_tier_size", labels("c1", "1", "a", "0"), 10, 4.0),
    ("log_tier_size", labels("c1", "2", "a", "0"), 10, 6.0),
    ("log_tier_size", labels("c1", "1", "a", "1"), 10, 3.0),
    ("partition_replicas_count", labels("c1", "1", "a", "0"), 10, 3.0),
    ("partition_replicas_count", labels("c1", "1", "a", "1"), 10, 0.0),
]


@pytest.fixture(scope="module")
def fixture_samples(spark):
    rows = [(metric, lab, data.at(seconds=s), value) for metric, lab, s, value in FIXTURE]
    return spark.createDataFrame(rows, METRIC_SAMPLE)


def results(df, tick):
    """{(metric, labels)} -> value at one tick."""
    rows = df.where(F.col("ts") == F.lit(tick)).collect()
    return {(r.metric, tuple(sorted(r.labels.items()))): r.value for r in rows}


def named(record, **by):
    full = {"cluster": CLUSTER, "broker": BROKER, "topic": TOPIC}
    return (f"code:{record}:total", tuple(sorted((full[k], v) for k, v in by.items())))


def test_fixture(fixture_samples):
    df = rollups.evaluate_rules(rollups.valid_samples(fixture_samples), recording_rules())
    got = results(df, data.at(1))
    assert got[named("log_size_by_broker", cluster="c1", broker="1")] == 17
    assert got[named("log_size_by_broker", cluster="c1", broker="2")] == 7
    assert got[named("log_size_by_topic", cluster="c1", topic="a")] == 19
    assert got[named("log_size_by_topic", cluster="c1")] == 5  # the series without a topic
    assert got[named("log_tier_size_by_cluster", cluster="c1")] == 9
    assert got[named("log_tier_size_by_topic", cluster="c1", topic="a")] == 9
    assert got[named("partition_count_by_topic", cluster="c1", topic="a")] == 1
    assert got[named("partition_replicas_count_by_topic", cluster="c1", topic="a")] == 3
    # at 00:05:00 every sample is still within its five minutes, so nothing has changed
    assert results(df, data.at(5)) == got
    assert results(df, data.at(6)) == {}


def test_fifteen_rules():
    rules = recording_rules("p_")
    assert len(rules) == 15 and len({r.record for r in rules}) == 15
    assert all(r.metric.startswith("p_") for r in rules)
    assert {r.record for r in rules if r.not_equal} == {
        "code:p_log_size_by_broker:total",
        "code:p_log_size_by_topic:total",
        "code:p_log_tier_size_by_broker:total",
    }
    assert [r.agg for r in rules].count("count") == 1
    assert {r.by for r in rules if r.inner_by} == {(CLUSTER,), (CLUSTER, TOPIC)}


def random_samples(seed, n=400):
    rnd = random.Random(seed)
    metrics = sorted({r.metric for r in recording_rules()})[:4] + ["log_tier_size"]
    rows, seen = [], set()
    for _ in range(n):
        lab = labels(
            rnd.choice("xy"),
            rnd.choice("12"),
            rnd.choice(["a", "b", "__cluster_metadata", None]),
            rnd.choice(["0", "1"]),
        )
        # around the edges of ticks and stretches of ticks
        ts = data.at(rnd.choice([0, 1, 2, 56, 59, 60, 64, 119, 120]), rnd.choice([0, 0.000001, 30, 59.999999]))
        key = (rnd.choice(metrics), tuple(sorted(lab.items())), ts)
        if key not in seen:
            seen.add(key)
            rows.append((key[0], lab, ts, float(rnd.randrange(0, 50))))
    return rows


def plain_instants(rows):
    """Newest sample of each series in (tick - 5 min, tick], for every tick."""
    ticks = [data.at(m) for m in range(-2, 140)]
    out = {}
    for tick in ticks:
        newest = {}
        for metric, lab, ts, value in rows:
            if tick - timedelta(minutes=5) < ts <= tick:
                series = (metric, tuple(sorted(lab.items())))
                if series not in newest or ts > newest[series][0]:
                    newest[series] = (ts, value)
        for series, (_, value) in newest.items():
            out[(*series, tick)] = value
    return out


def plain_rule(instants, rule):
    def group(rows, by, agg):
        groups = {}
        for lab, tick, value in rows:
            groups.setdefault((tuple(lab.get(n, "") for n in by), tick), []).append(value)
        fold = {"sum": sum, "max": max, "count": len}[agg]
        return [({n: v for n, v in zip(by, k[0]) if v}, k[1], fold(vs)) for k, vs in groups.items()]

    rows = [(dict(lab), tick, value) for (metric, lab, tick), value in instants.items() if metric == rule.metric]
    if rule.not_equal:
        rows = [r for r in rows if r[0].get(rule.not_equal[0], "") != rule.not_equal[1]]
    if rule.above is not None:
        rows = [r for r in rows if r[2] > rule.above]
    if rule.inner_by:
        rows = group(rows, rule.inner_by, rule.inner_agg)
    return {(rule.record, tuple(sorted(lab.items())), tick): float(v) for lab, tick, v in group(rows, rule.by, rule.agg)}


def collected(df, time="tick"):
    return {(r.metric, tuple(sorted(r.labels.items())), r[time]): r.value for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_a_plain_evaluation(spark, seed):
    rows = random_samples(seed)
    valid = rollups.valid_samples(spark.createDataFrame(rows, METRIC_SAMPLE))
    plain = plain_instants(rows)
    assert collected(rollups.at_ticks(valid)) == plain
    want = {}
    for rule in recording_rules():
        want |= plain_rule(plain, rule)
    assert collected(rollups.evaluate_rules(valid, recording_rules()), "ts") == want


def test_one_rule_equals_the_same_rule_among_all(spark):
    valid = rollups.valid_samples(spark.createDataFrame(random_samples(9), METRIC_SAMPLE))
    every = collected(rollups.evaluate_rules(valid, recording_rules()), "ts")
    for rule in recording_rules()[::4] + recording_rules()[11:12]:
        alone = collected(rollups.evaluate_rule(valid, rule), "ts")
        assert alone == {k: v for k, v in every.items() if k[0] == rule.record}


def test_busy_series_is_one_row_per_interval(spark):
    """Ten thousand samples of one series within two minutes."""
    samples = spark.range(10_000).select(
        F.lit("m").alias("metric"),
        F.create_map(F.lit("a"), F.lit("b")).alias("labels"),
        F.timestamp_micros(F.col("id") * 12_000).alias("ts"),
        F.col("id").cast("double").alias("value"),
    )
    got = rollups.instant_samples(samples).orderBy("tick").collect()
    assert [(r.tick.minute, r.value) for r in got] == [(0, 0.0), (1, 5000.0)] + [(m, 9999.0) for m in (2, 3, 4, 5, 6)]


def test_empty_labels_do_not_make_a_series(spark):
    rows = [("m", {"a": "b"}, data.at(0, 1), 1.0), ("m", {"c": "", "a": "b"}, data.at(0, 2), 2.0), ("m", {}, data.at(0, 3), 4.0)]
    instants = rollups.instant_samples(spark.createDataFrame(rows, METRIC_SAMPLE)).where(F.col("tick") == data.at(1))
    assert sorted((tuple(r.labels.items()), r.value) for r in instants.collect()) == [((), 4.0), ((("a", "b"),), 2.0)]


def test_rules_without_labels_and_max(spark):
    valid = rollups.valid_samples(spark.createDataFrame(random_samples(4), METRIC_SAMPLE))
    rules = [Rule("all", "log_tier_size", ()), Rule("top", "log_tier_size", (TOPIC,), agg="max")]
    plain = plain_instants(random_samples(4))
    want = plain_rule(plain, rules[0]) | plain_rule(plain, rules[1])
    assert collected(rollups.evaluate_rules(valid, rules), "ts") == want
    assert collected(rollups.evaluate_rule(valid, rules[0]), "ts") == plain_rule(plain, rules[0])


def test_recorded_rule_can_be_read_as_samples(fixture_samples):
    valid = rollups.valid_samples(fixture_samples)
    recorded = rollups.evaluate_rule(valid, recording_rules()[0])
    both = fixture_samples.unionByName(recorded)
    assert both.where("metric like 'code:%'").count() == recorded.count() > 0


def test_promoted_labels(spark):
    rows = [({"type": "own", "x": "1"}, {"type": "broker", "kafka.broker.id": "7", "process.pid": "3"})]
    df = spark.createDataFrame(rows, "labels map<string,string>, attributes map<string,string>")
    got = rollups.promote_labels(df, "attributes", PROMOTED_ATTRIBUTES).first().labels
    assert got == {"type": "own", "x": "1", "kafka_broker_id": "7"}


@pytest.mark.parametrize("batches", [1, 4])
def test_rules_on_a_stream(spark, tmp_path, batches):
    """Every tick once, from samples cut by time into micro-batches; the last tick waits for a sample past it."""
    rows = sorted(random_samples(6), key=lambda r: r[2])
    samples = spark.createDataFrame(rows, METRIC_SAMPLE)
    stream = data.streamed(job_session(spark), samples, tmp_path / "in", batches, order="ts")
    got = run_rules(spark, Job("rules", str(tmp_path / "job")), stream, recording_rules())
    newest = max(r[2] for r in rows)
    plain, want = plain_instants(rows), {}
    for rule in recording_rules():
        want |= plain_rule(plain, rule)
    assert got.count() == len(collected(got, "ts"))
    assert collected(got, "ts") == {k: v for k, v in want.items() if k[2] < newest}


def test_rules_on_a_stream_out_of_order(spark, tmp_path):
    """Samples up to ten minutes late, in five micro-batches: every tick that the watermark has passed, once; state of one look-back."""
    rows = [r for r in random_samples(6) if r[3] is not None]
    newest = max(r[2] for r in rows)
    arriving = spark.createDataFrame(rows, METRIC_SAMPLE).withColumn("late", F.pmod(F.xxhash64("metric", "ts", "value"), F.lit(600)))
    arriving = arriving.withColumn("at", F.unix_micros("ts") + F.col("late") * 1_000_000)
    stream = data.streamed(job_session(spark), arriving, tmp_path / "in", 5, order="at").select(*METRIC_SAMPLE.names)
    job = Job("rules", str(tmp_path / "job"))
    got = run_rules(spark, job, stream, recording_rules(), "10 minutes")
    plain, want = plain_instants(rows), {}
    for rule in recording_rules():
        want |= plain_rule(plain, rule)
    until = newest - timedelta(minutes=10)
    assert got.count() == len(collected(got, "ts")) > 0
    assert collected(got, "ts") == {k: v for k, v in want.items() if k[2] <= until}


def test_rules_on_a_stream_without_samples(spark, tmp_path):
    rows = [("log_size", labels("c1", "1", "a", "0"), None, 1.0), ("log_size", None, data.at(seconds=5), None)]
    stream = data.streamed(job_session(spark), spark.createDataFrame(rows, METRIC_SAMPLE), tmp_path / "in", order="metric")
    assert run_rules(spark, Job("rules", str(tmp_path / "job")), stream, recording_rules()).count() == 0
