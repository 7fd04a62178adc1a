"""Grouped totals, running totals and ordered folds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyrill.operators.records import keyed
from keyrill.operators.slices import ROWS_PER_SLICE, sliced

FOLD_BLOCK = 1_000
DIGITS = 10
EXACT_UP_TO = 1e16


def total_by_key(df: DataFrame, value: str | Column = "price", name: str = "total") -> DataFrame:
    """Sum per key. Rows are summed before the shuffle, so a hot key costs one row per map task."""
    column = F.col(value) if isinstance(value, str) else value
    return keyed(df).where(column.isNotNull()).groupBy("key").agg(F.sum(column).alias(name))


def running_total(
    df: DataFrame, value: str | Column = "price", name: str = "total", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """The total of a key after each of its records, in (timestamp, offset) order.

    A floating-point value is added in two parts: as a decimal of DIGITS places, and what that leaves of it as a double. So totals
    of values that are such decimals do not depend on where a key was cut, and others are totals of doubles: NaN and
    infinities stay what they are, tiny and huge values are not lost.
    """
    column = F.col(value) if isinstance(value, str) else value
    rows = keyed(df).where(column.isNotNull())
    inexact = rows.select(column.alias("v")).schema["v"].dataType.typeName() in ("double", "float")
    if not inexact:
        return sliced(rows, rows_per_slice=rows_per_slice).running_sum(column, name).result()
    column = column.cast("double")
    # larger doubles have no decimal places left, smaller ones none but those beyond DIGITS
    exact = F.when(F.abs(column).between(10.0**-DIGITS, EXACT_UP_TO), column.cast(f"decimal(38,{DIGITS})")).otherwise(F.lit(0).cast(f"decimal(38,{DIGITS})"))
    rest = column - exact.cast("double")
    found = sliced(rows, rows_per_slice=rows_per_slice).running_sums({"_exact": exact, "_rest": rest}).result()
    return found.withColumn(name, F.col("_exact").cast("double") + F.col("_rest")).drop("_exact", "_rest")


def ordered_fold(
    df: DataFrame,
    value: Column,
    init: Column,
    step: Callable[[Column, Column], Column],
    merge: Callable[[Column, Column], Column],
    name: str = "result",
    rows_per_slice: int = ROWS_PER_SLICE,
    block: int = FOLD_BLOCK,
) -> DataFrame:
    """Fold the values of each key in (timestamp, offset) order with `step(acc, value)`.

    `merge(earlier, later)` joins the results of two neighbouring runs and must be associative, with `init` as its
    neutral value. That is what lets a fold be cut: rows are folded in blocks, blocks in blocks of blocks, and hot
    keys in slices, so no array ever holds more than `block` elements times the number of levels needed. Use
    `running_total` or a built-in aggregate where one fits.
    """
    cut = sliced(keyed(df).where(value.isNotNull()), rows_per_slice=rows_per_slice)
    group = cut.group
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*cut.order)) - 1
    level = cut.rows.select(*group, place.cast("bigint").alias("at"), value.alias("acc"))

    # Three levels of blocks cover block^3 rows of a key slice; all of them use the partitioning of the row number.
    for combine in (step, merge, merge):
        level = _fold_runs(level, [*group, F.floor(F.col("at") / block).alias("at")], "at", init, combine)
    level = _fold_runs(level, group, "at", init, merge)
    if cut.slices is not None:
        level = _fold_runs(level, ["key"], "slice", init, merge)
    return level.select("key", F.col("acc").alias(name))


def _fold_runs(rows: DataFrame, by: list, order: str, init: Column, combine) -> DataFrame:
    """Fold `acc` over the rows of each group, in the given order."""
    run = F.array_sort(F.collect_list(F.struct(order, "acc")))
    return rows.groupBy(*by).agg(F.aggregate(run, init, lambda acc, item: combine(acc, item["acc"])).alias("acc"))
