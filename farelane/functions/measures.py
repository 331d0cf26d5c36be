"""Aggregate expressions shared by all reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(value: Column | str) -> Column:
    """Sum as double; a decimal column is summed exactly first."""
    return F.sum(value).cast("double")


def mean(value: Column | str) -> Column:
    """Sum over the number of known values, null when there is none."""
    return F.try_divide(total(value), F.count(value))


def mean_minutes(seconds: Column) -> Column:
    """Mean length in minutes from whole seconds; the sum stays an integer."""
    return F.try_divide(F.sum(seconds).cast("double"), F.count(seconds) * 60)
