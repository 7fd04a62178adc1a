"""Ordered computations over keys of any size.

A running total, a carried-forward value or a session needs the rows of a key in order. One window per key
does that with a single shuffle, but puts each key into one task. `sliced()` therefore looks for keys with more
rows than one task should hold, and lays out the rows of those (only those) by ranges of key and position, as a sort would.
Each range of a key is then windowed by itself and completed with a value carried over from the ranges before it. Without such
keys the plan is the plain one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyrill.folders import written

ROWS_PER_SLICE = 5_000_000
# fewer rows than this are not worth a task of their own, unless there would be fewer than RANGES
ROWS_PER_RANGE, RANGES = 100_000, 8
# so many hot keys are sent to every executor (some 50 MB); a join by key would gather a hot key in one task
SENT_KEYS = 1_000_000


@dataclass(frozen=True)
class Sliced:
    """Rows with a `slice` number per key, rising with the order columns; -1 for the keys that are not cut."""

    rows: DataFrame
    order: tuple[str, ...]
    slices: DataFrame | None = None  # (key, slice) of the keys that were cut; None: no key was, `rows` has no slice

    @property
    def group(self) -> list[str]:
        return ["key"] if self.slices is None else ["key", "slice"]

    def window(self):
        """All rows of the group up to and including the current one."""
        return Window.partitionBy(*self.group).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, 0)

    def _replace(self, rows: DataFrame) -> Sliced:
        return Sliced(rows, self.order, self.slices)

    def _carried(self, rows: DataFrame, of_slice: dict[str, Column], over_slices: Callable[[str], Column]) -> DataFrame:
        """What the slices before each slice of a cut key carry into it, as (key, slice, _carry_NAME for each name): one row per slice.

        `rows` must be all rows: a slice with nothing of its own still gets a carried value.
        """
        parts = rows.where("slice >= 0").groupBy("key", "slice").agg(*[part.alias(f"_part_{name}") for name, part in of_slice.items()])
        before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        return parts.select("key", "slice", *[over_slices(f"_part_{name}").over(before).alias(f"_carry_{name}") for name in of_slice])

    def running_sum(self, value: Column, name: str) -> Sliced:
        """Add the sum of `value` over the key's rows so far."""
        return self.running_sums({name: value})

    def running_sums(self, values: dict[str, Column]) -> Sliced:
        """Add, under each name, the sum of its value over the key's rows so far."""
        window = self.window()
        rows = self.rows.withColumns({name: F.sum(value).over(window) for name, value in values.items()})
        if self.slices is None:
            return self._replace(rows)
        kinds = {name: rows.schema[name].dataType for name in values}
        # both sides are hashed on (key, slice), which the window needs in any case
        carry = self._carried(self.rows, {name: F.sum(value) for name, value in values.items()}, F.sum)
        rows = rows.join(carry, ["key", "slice"], "left")
        totals = {}
        for name, kind in kinds.items():
            parts = [F.col(name), F.col(f"_carry_{name}")]
            if isinstance(kind, T.DecimalType):
                # one digit less, or the sum would lose one of its decimal places
                parts = [part.cast(T.DecimalType(min(kind.precision, 37), kind.scale)) for part in parts]
            totals[name] = F.coalesce(parts[0] + parts[1], name, f"_carry_{name}").cast(kind)
        return self._replace(rows.withColumns(totals).drop(*[f"_carry_{name}" for name in values]))

    def running_last(self, value: Column, name: str, before_current: bool = False) -> Sliced:
        """Add the last non-null `value` among the key's rows so far, the current one included unless
        `before_current`."""
        window = self.window()
        if before_current:
            window = window.rowsBetween(Window.unboundedPreceding, -1)
        inside = F.last(value, ignorenulls=True).over(window)
        if self.slices is None:
            return self._replace(self.rows.withColumn(name, inside))
        newest = F.max_by(value, F.when(value.isNotNull(), F.struct(*self.order)))
        carry = self._carried(self.rows, {name: newest}, lambda part: F.last(part, ignorenulls=True))
        rows = self.rows.join(carry, ["key", "slice"], "left").withColumn(name, F.coalesce(inside, F.col(f"_carry_{name}")))
        return self._replace(rows.drop(f"_carry_{name}"))

    def carry_start(self, parts: DataFrame, name: str) -> DataFrame:
        """`parts`, some rows of each slice by (key, slice, `name`), with the greatest `name` of the slices before where it is null."""
        carry = self._carried(parts, {name: F.max(name)}, lambda part: F.last(part, ignorenulls=True))
        parts = parts.join(carry, ["key", "slice"], "left").withColumn(name, F.coalesce(name, f"_carry_{name}"))
        return parts.drop(f"_carry_{name}")

    def result(self) -> DataFrame:
        return self.rows if self.slices is None else self.rows.drop("slice")


def sliced(
    df: DataFrame,
    order: Sequence[str] = ("timestamp", "offset"),
    rows_per_slice: int = ROWS_PER_SLICE,
    measure: DataFrame | None = None,
) -> Sliced:
    """Prepare `df` (with a non-null `key`) for ordered computations, cutting keys of more than `rows_per_slice` rows.

    Costs one aggregation over the key column of `measure`, of which two numbers come back; nothing is written where no key is hot. `measure` is `df` unless given: pass the inputs of an expensive
    `df` instead, with the same key column, so that it is not computed twice. Where there are hot keys, their rows are
    written once to the shared folder in order of key and position. A task lays out one range of them, whatever the
    length of a slice: a slice is so many rows of a key by their place in it, which is that in the range and the number of
    the key's rows in the ranges before. The order columns must together be
    unique within a key: equal positions cannot be told apart, here as in any ordered window.
    """
    order = tuple(order)
    measure = df if measure is None else measure
    counts = measure.groupBy("key").count().where(F.col("count") > rows_per_slice)
    number, parts, hot = counts.agg(F.count(F.lit(1)), F.sum(F.ceil(F.col("count") / rows_per_slice)), F.sum("count")).first()
    if not parts:
        return Sliced(df, order)

    def small(by_key: DataFrame) -> DataFrame:
        return F.broadcast(by_key) if number <= SENT_KEYS else by_key

    keys = small(written(counts.select("key"), "hot-keys"))
    # short slices must not cost a task each: no more ranges than the session's tasks, or than their rows fill
    tasks = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), max(RANGES, -(-hot // ROWS_PER_RANGE)))
    ranges = min(int(parts), max(tasks, -(-hot // ROWS_PER_SLICE)))
    ranged = df.join(keys, "key", "left_semi").repartitionByRange(ranges, "key", *order).sortWithinPartitions("key", *order)
    # the number of a row: its range in the bits from 33 on, its place in the range below
    laid = written(ranged.withColumn("_row", F.monotonically_increasing_id()), "hot-rows")
    laid = laid.withColumn("_range", F.shiftright("_row", 33))
    first = laid.groupBy("key", "_range").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = first.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    first = written(first, "hot-ranges")
    place = F.col("_row") - F.col("_first") + F.col("_before")
    cut = laid.join(small(first.drop("_rows")), ["key", "_range"]).withColumn("slice", F.floor(place / rows_per_slice))
    last = F.floor((F.sum("_rows") - 1) / rows_per_slice)
    slices = first.groupBy("key").agg(last.alias("_last")).select("key", F.explode(F.sequence(F.lit(0).cast("bigint"), "_last")).alias("slice"))
    rest = df.join(keys, "key", "left_anti").withColumn("slice", F.lit(-1).cast("bigint"))
    return Sliced(cut.select(*rest.columns).unionByName(rest), order, slices)
