"""Recording rules over a stream of samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyrill.operators.rollups import LOOKBACK_TICKS, TICK_US, Rule, evaluate_rules
from keyrill.streaming.jobs import Job
from keyrill.streaming.ordered import AtTicks, in_order

_SERIES = "struct<metric: string, series: array<struct<key: string, value: string>>>"


def ticks_of(samples: DataFrame) -> DataFrame:
    """`instant_samples` over a stream with a watermark on `ts`: the value of every series at every tick that the watermark has passed.

    Each series keeps its newest sample in Spark's state, for one look-back at most, and a timer at its next tick. All values of a tick are
    sent in one micro-batch. Samples without a time or value count for nothing.
    """
    # maps can be neither grouped nor compared; empty labels do not make a series
    series = F.sort_array(F.map_entries(F.map_filter("labels", lambda _, v: v != "")))
    rows = samples.where("ts is not null and value is not null").select(
        F.col("ts").alias("timestamp"),
        F.to_json(F.struct("metric", series.alias("series"))).alias("key"),
        F.lit(0).cast("bigint").alias("offset"),
        "value",
    )
    found = in_order(rows, AtTicks(TICK_US, LOOKBACK_TICKS * TICK_US))
    of = F.from_json("key", _SERIES)
    return found.select(of["metric"].alias("metric"), F.map_from_entries(of["series"]).alias("labels"), "tick_us", "value")


def start_rules(job: Job, samples: DataFrame, rules: Sequence[Rule], delay: str, available_now: bool = True):
    """Start evaluating the rules at every tick; recorded samples go to `job.output`, one folder per micro-batch.

    A tick is evaluated once, when the watermark, the newest time less `delay`, has passed it; samples that come in the meantime count.
    """
    watched = samples.withWatermark("ts", delay).where(F.col("metric").isin(sorted({rule.metric for rule in rules})))

    def write(batch: DataFrame, number: int) -> None:
        valid = batch.withColumnsRenamed({"tick_us": "from_us"}).withColumn("to_us", F.col("from_us"))
        evaluate_rules(valid, rules).write.mode("overwrite").parquet(f"{job.output}/batch={number}")

    return job.for_each_batch(ticks_of(watched), write, "append", available_now)
