"""Text parsing used by the record pipelines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def after_first_dash(text: Column) -> Column:
    """Text after the first `-`; the whole text where there is none."""
    return F.substring(text, F.instr(text, "-") + 1, F.lit(2**31 - 1))


def whole_number(text: Column) -> Column:
    """The text as a bigint, or null where it is not exactly an optional sign and digits, or overflows.

    `try_cast` alone would trim blanks, so `" 7"` would pass; the pattern guards against that, and leaves an empty text,
    which is no number either. `try_cast` also keeps the parse safe when the optimizer evaluates it before
    a neighbouring filter.
    """
    return F.regexp_extract(text, r"^[+-]?[0-9]+\z", 0).try_cast("bigint")


def decimal_number(text: Column) -> Column:
    """The text as a double, or null."""
    return text.try_cast("double")


def number_text(number: Column) -> Column:
    """A number in its Java text form, e.g. `4500.0` or `1.0E7`."""
    return number.cast("string")
