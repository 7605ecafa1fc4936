"""Timestamp expressions."""

from pyspark.sql import Column, functions as F


def truncate_ms(c: Column) -> Column:
    """A timestamp without zone, cut to milliseconds (towards the past)."""
    return F.date_trunc("MILLISECOND", c).cast("timestamp_ntz")


def between(c: Column, start, end) -> Column:
    """Time range, both ends included."""
    return (c >= F.lit(start).cast("timestamp_ntz")) & (c <= F.lit(end).cast("timestamp_ntz"))


def as_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS``"""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
