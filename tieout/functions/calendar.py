"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def business_days(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Weekdays in [start, end] for each bounds row (explode of a date sequence;
    the row count is the calendar span, independent of data volume)."""
    days = bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("business_day"))
    return days.filter(~F.dayofweek("business_day").isin(1, 7))
