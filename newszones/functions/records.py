"""Whole-record helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_of_list(col: Column) -> Column:
    """First element of a list value, NULL if the list is empty or missing."""
    return F.try_element_at(col, F.lit(1))


def to_json_line(*names: str) -> Column:
    """The named columns as one JSON object; keys with NULL values are kept, and non-ASCII text as it is."""
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def run_stamp(as_of: Column) -> Column:
    return F.date_format(as_of, "yyyyMMdd_HHmmss")
