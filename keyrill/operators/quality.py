"""Good and bad records of a parse step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyrill.functions.text import after_first_dash, whole_number


def with_parse_result(df: DataFrame, column: str = "value") -> DataFrame:
    """Add the parsed `number` and, where there is none, the `reason`."""
    text = after_first_dash(F.col(column))
    number = whole_number(text)
    reason = (
        F.when(F.col(column).isNull(), F.lit("no value"))
        .when(text == "", F.lit("empty number"))
        .when(~text.rlike(r"^[+-]?[0-9]+\z"), F.lit("not a whole number"))
        .when(number.isNull(), F.lit("out of range"))
    )
    return df.withColumns({"number": number, "reason": reason})


# Records have either a number or a reason; the number is the cheaper one to test.


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("number").isNotNull()).drop("reason")


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("number").isNull()).drop("number")
