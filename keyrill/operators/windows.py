"""Event-time windows per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.folders import written
from keyrill.functions.instants import payload_time
from keyrill.operators.records import keyed
from keyrill.operators.slices import ROWS_PER_SLICE, sliced


def with_event_time(df: DataFrame, time_ms: str = "time") -> DataFrame:
    """Take the record time from a payload field, keeping the record's own where the field is null."""
    return df.withColumn("timestamp", payload_time(F.col(time_ms), F.col("timestamp")))


def _window_sum(df: DataFrame, window: Column, records: Column, total: Column, name: str) -> DataFrame:
    grouped = df.groupBy("key", window.alias("w")).agg(records.alias("records"), total.alias(name))
    return grouped.select("key", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "records", name)


def tumbling_sum(df: DataFrame, value: Column, minutes: int, name: str = "total") -> DataFrame:
    """Count and sum per key and window `[start, start + minutes)`."""
    window = F.window("timestamp", f"{minutes} minutes")
    return _window_sum(keyed(df), window, F.count(F.lit(1)), F.sum(value), name)


def hopping_sum(df: DataFrame, value: Column, minutes: int, slide: int, name: str = "total") -> DataFrame:
    """Count and sum per key and overlapping window, one starting every `slide` minutes.

    In batch, rows are first summed into panes one slide wide, and only the panes are copied into the windows that cover
    them. Streams, and windows that are no multiple of their slide, take the direct form.
    """
    window = F.window("timestamp", f"{minutes} minutes", f"{slide} minutes")
    if df.isStreaming or minutes % slide:
        return _window_sum(keyed(df), window, F.count(F.lit(1)), F.sum(value), name)
    panes = tumbling_sum(df, value, slide, name).withColumnRenamed("start", "timestamp")
    return _window_sum(panes, window, F.sum("records"), F.sum(name), name)


def session_sum(
    df: DataFrame, value: Column, gap_minutes: int, name: str = "total", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Count and sum per key and session; a pause of more than the gap starts a new one.

    The same sessions as `session_window`, whose streaming form is `session_sum_stream`; here a hot key is cut, and a
    session is summed in each slice before the shuffle that gathers it.
    """
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(gap_minutes))
    rows = keyed(df).select("key", "timestamp", "offset", value.alias("_value"))
    cut = sliced(rows, rows_per_slice=rows_per_slice)
    cut = cut.running_last(F.col("timestamp"), "_previous", before_current=True)
    opens = F.col("_previous").isNull() | (F.col("timestamp") > F.col("_previous") + gap)
    start = F.last(F.when(opens, F.col("timestamp")), ignorenulls=True).over(cut.window())
    parts = (
        cut.rows.withColumn("start", start)
        .groupBy(*cut.group, "start")
        .agg(F.max("timestamp").alias("_newest"), F.count(F.lit(1)).alias("records"), F.sum("_value").alias(name))
    )
    if cut.slices is None:
        return parts.select("key", "start", (F.col("_newest") + gap).alias("end"), "records", name)
    kind = parts.schema[name].dataType
    # sums of a slice; those of rows before the slice's first start belong to the session that came into it
    parts = cut.carry_start(written(parts, "session-parts"), "start")
    return (
        parts.groupBy("key", "start")
        .agg(
            (F.max("_newest") + gap).alias("end"),
            F.sum("records").alias("records"),
            F.sum(name).cast(kind).alias(name),
        )
    )


def session_sum_stream(df: DataFrame, value: Column, gap_minutes: int, name: str = "total") -> DataFrame:
    """Sessions of a stream with a watermark."""
    window = F.session_window("timestamp", f"{gap_minutes} minutes")
    return _window_sum(keyed(df), window, F.count(F.lit(1)), F.sum(value), name)
