"""Rollups of metric samples at fixed evaluation ticks.

A sample is (metric, labels, ts, value); a series is one metric with one set of labels. A label that is missing is the same
as an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyrill.functions.instants import MINUTE_US, ceil_to, floor_to

# Rules are evaluated every 60 seconds; a sample counts for 5 minutes; samples may come 10 minutes late.
TICK_US = MINUTE_US
LOOKBACK_TICKS = 5
LATENESS = "10 minutes"
# Series are worked on in stretches of this many ticks.
STRETCH_TICKS = 60


def label(name: str) -> Column:
    return F.coalesce(F.col("labels").getItem(name), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """`agg by (labels)` over one metric, optionally over a finer `inner_agg by (inner_by)`, recorded as a new metric."""

    record: str
    metric: str
    by: tuple[str, ...]
    agg: str = "sum"  # sum, count or max
    not_equal: tuple[str, str] | None = None  # (label, value): leave out samples whose label has that value
    above: float | None = None  # keep samples above this value
    inner_by: tuple[str, ...] | None = None
    inner_agg: str = "max"

    def keeps(self) -> Column:
        kept = F.col("metric") == self.metric
        if self.not_equal is not None:
            kept = kept & (label(self.not_equal[0]) != self.not_equal[1])
        if self.above is not None:
            kept = kept & (F.col("value") > self.above)
        return kept


def valid_samples(samples: DataFrame) -> DataFrame:
    """The samples that are a series' newest within the look-back `(tick - 5 min, tick]` of some tick, with the
    first and last such tick, `from_us` and `to_us`.

    Steps: the newest sample of each series and tick interval, reduced before the shuffle, so that a series sampled often
    costs one row per interval; the stretches of ticks that each of these reaches into; and, inside a stretch, as many
    ticks for a sample as there are until the next one takes over. No sample is paired with another, and no
    (series, stretch) holds more than 65 rows.
    """
    span = LOOKBACK_TICKS * TICK_US
    stretch = STRETCH_TICKS * TICK_US
    at = F.unix_micros("ts")
    newest = (
        samples.where(F.col("value").isNotNull())
        .select(
            "metric",
            # maps can be neither compared nor sorted, sorted entries can; empty labels do not make a series
            F.sort_array(F.map_entries(F.map_filter("labels", lambda _, v: v != ""))).alias("series"),
            ceil_to(at, TICK_US).alias("first_tick"),
            at.alias("at"),
            "value",
        )
        .groupBy("metric", "series", "first_tick")
        .agg(F.max("at").alias("at"), F.max_by("value", "at").alias("value"))
    )
    last_tick = ceil_to(F.col("at") + span, TICK_US) - TICK_US
    reach = newest.withColumn("last_tick", last_tick).withColumn(
        "stretch",
        F.explode(
            F.array_distinct(F.array(floor_to(F.col("first_tick"), stretch), floor_to(F.col("last_tick"), stretch)))
        ),
    )
    next_tick = F.lead("first_tick").over(Window.partitionBy("metric", "series", "stretch").orderBy("first_tick"))
    first = F.greatest("first_tick", "stretch")
    last = F.least(
        F.col("last_tick"), F.col("stretch") + (stretch - TICK_US), F.coalesce(next_tick - TICK_US, F.col("last_tick"))
    )
    valid = reach.withColumns({"from_us": first, "to_us": last}).where("from_us <= to_us")
    return valid.select("metric", F.map_from_entries("series").alias("labels"), "from_us", "to_us", "value")


def at_ticks(valid: DataFrame) -> DataFrame:
    """One row per sample and tick it is valid at. Whatever is computed from labels is cheaper before than after."""
    others = [c for c in valid.columns if c not in ("from_us", "to_us")]
    ticks = F.explode(F.sequence("from_us", "to_us", F.lit(TICK_US).cast("bigint"))).alias("tick")
    return valid.select(*others, ticks).withColumn("tick", F.timestamp_micros("tick"))


def instant_samples(samples: DataFrame) -> DataFrame:
    """The value of every series at every tick."""
    return at_ticks(valid_samples(samples))


def without_label(df: DataFrame, name: str, value: str) -> DataFrame:
    """Samples whose label differs from `value`; a missing label counts as empty and stays."""
    return df.where(label(name) != value)


def _aggregate(kind: str) -> Column:
    return {"sum": F.sum("value"), "max": F.max("value"), "count": F.count("value").cast("double")}[kind]


def aggregate_by(df: DataFrame, by: Sequence[str], agg: str = "sum") -> DataFrame:
    """`agg by (labels)` at each tick, over valid samples or an earlier result; the result has only the labels grouped by.

    Groups without samples are absent.
    """
    time = ["tick"] if "tick" in df.columns else ["from_us", "to_us"]
    rows = df.select(*time, *[label(name).alias(name) for name in by], "value")
    if "tick" not in df.columns:
        rows = at_ticks(rows)
    grouped = rows.groupBy("tick", *by).agg(_aggregate(agg).alias("value"))
    return grouped.select("tick", _labels(by), "value")


def _labels(by: Sequence[str]) -> Column:
    """The label map of a group; empty labels are left out."""
    if not by:
        return F.create_map().cast("map<string,string>").alias("labels")
    pairs = F.create_map(*[part for name in by for part in (F.lit(name), F.col(name))])
    return F.map_filter(pairs, lambda _, v: v != "").alias("labels")


def evaluate_rule(valid: DataFrame, rule: Rule) -> DataFrame:
    """One rule over the valid samples, as samples of the recorded metric."""
    df = valid.where(rule.keeps())
    if rule.inner_by is not None:
        df = aggregate_by(df, rule.inner_by, rule.inner_agg)
    return record_as(aggregate_by(df, rule.by, rule.agg), rule.record)


def record_as(df: DataFrame, metric: str) -> DataFrame:
    """Name a rollup, so that it can be appended to the samples it came from."""
    return df.select(F.lit(metric).alias("metric"), "labels", F.col("tick").alias("ts"), "value")


def evaluate_rules(valid: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rules in one pass over the valid samples, as samples of the recorded metrics.

    Each sample is tagged with the rules it belongs to and grouped once by (rule, tick, labels used), the inner ones
    where a rule has an inner aggregation. A second grouping, of what is left, makes the outer one.
    """
    names = sorted({name for rule in rules for name in (*rule.by, *(rule.inner_by or ()))})
    flat = valid.select("metric", "labels", "from_us", "to_us", "value", *[label(n).alias(n) for n in names])
    tags = None
    for metric in sorted({rule.metric for rule in rules}):
        structs = []
        for rule in rules:
            if rule.metric == metric:
                used = rule.inner_by or rule.by
                labels = [(F.col(n) if n in used else F.lit("")).alias(n) for n in names]
                structs.append(F.when(rule.keeps(), F.struct(F.lit(rule.record).alias("record"), *labels)))
        test = F.col("metric") == metric
        tags = F.when(test, F.array(*structs)) if tags is None else tags.when(test, F.array(*structs))
    rows = flat.where(F.col("metric").isin([rule.metric for rule in rules]))
    rows = at_ticks(rows.select("from_us", "to_us", "value", F.inline(tags)).where("record is not null"))

    def pick(kind) -> Column:
        chosen = None
        for agg in sorted({kind(rule) for rule in rules}):
            test = F.col("record").isin([rule.record for rule in rules if kind(rule) == agg])
            value = _aggregate(agg)
            chosen = F.when(test, value) if chosen is None else chosen.when(test, value)
        return chosen.alias("value")

    result = rows.groupBy("record", "tick", *names).agg(pick(lambda r: r.inner_agg if r.inner_by else r.agg))
    if any(rule.inner_by for rule in rules):
        kept = []
        for n in names:
            dropping = [rule.record for rule in rules if rule.inner_by and n not in rule.by]
            kept.append(F.when(F.col("record").isin(dropping), F.lit("")).otherwise(F.col(n)).alias(n) if dropping else F.col(n))
        # a rule without an inner aggregation has one row a group here, which passes through
        outer = result.select("record", "tick", *kept, "value").groupBy("record", "tick", *names)
        result = outer.agg(pick(lambda r: r.agg if r.inner_by else "max"))
    return result.select(F.col("record").alias("metric"), _labels(names), F.col("tick").alias("ts"), "value")


def promote_labels(df: DataFrame, attributes: str, promoted: Sequence[str]) -> DataFrame:
    """Copy the named resource attributes into the labels, dots turned into underscores. Labels already there win."""
    chosen = F.map_filter(attributes, lambda k, _: k.isin(list(promoted)))
    renamed = F.transform_keys(chosen, lambda k, _: F.translate(k, ".", "_"))
    added = F.map_filter(renamed, lambda k, _: ~F.map_contains_key("labels", k))
    return df.withColumn("labels", F.map_concat("labels", added)).drop(attributes)


def windowed_rollup(df: DataFrame, by: Sequence[str], agg: str = "sum") -> DataFrame:
    """Aggregate the samples of each tick interval by labels; for streams, where look-back selection has no counterpart."""
    window = F.window("ts", f"{TICK_US // 1_000_000} seconds")
    grouped = df.groupBy(window.alias("w"), *[label(name).alias(name) for name in by])
    return grouped.agg(_aggregate(agg).alias("value")).select(F.col("w.end").alias("tick"), *by, "value")


def windowed_sum_of_max(df: DataFrame, inner_by: Sequence[str], by: Sequence[str]) -> DataFrame:
    """`sum_of_max` over the samples of each tick interval: two aggregations, the second over the windows of the first."""
    length = f"{TICK_US // 1_000_000} seconds"
    greatest = df.groupBy(F.window("ts", length).alias("w"), *[label(name).alias(name) for name in inner_by]).agg(F.max("value").alias("value"))
    closed = greatest.select(F.window_time("w").alias("at"), *by, "value")
    sums = closed.groupBy(F.window("at", length).alias("w"), *by).agg(F.sum("value").alias("value"))
    return sums.select(F.col("w.end").alias("tick"), *by, "value")
