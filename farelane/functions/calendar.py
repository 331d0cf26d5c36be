"""Calendar columns of a trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# First hour, first hour after, label; other hours are night.
DAY_PARTS = ((5, 12, "Sáng"), (12, 18, "Chiều"), (18, 23, "Tối"))
NIGHT = "Đêm"


def part_of_day(ts: Column | str, parts=DAY_PARTS, otherwise: str | int = NIGHT) -> Column:
    """Label of the part of the day; a missing time counts as ``otherwise``."""
    hour = F.hour(ts)
    (start, stop, name), *others = parts
    label = F.when((hour >= start) & (hour < stop), F.lit(name))
    for start, stop, name in others:
        label = label.when((hour >= start) & (hour < stop), F.lit(name))
    return label.otherwise(F.lit(otherwise))


# Names of the days, in the order of the names; a day's code is its place here.
WEEKDAYS = ("Friday", "Monday", "Saturday", "Sunday", "Thursday", "Tuesday", "Wednesday")
#: Code of each weekday from Monday on.
WEEKDAY_CODES = (1, 5, 6, 4, 0, 2, 3)
#: Labels of the parts of the day in their order as text.
PART_LABELS = tuple(sorted([*(part[2] for part in DAY_PARTS), NIGHT]))


def _listed(values, place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(value) for value in values]), place)


def weekday_code(ts: Column | str) -> Column:
    """A small number for the weekday that sorts as its name does; null for a missing time."""
    return _listed(WEEKDAY_CODES, F.weekday(ts) + 1)


def weekday_of_code(code: Column | str) -> Column:
    return _listed(WEEKDAYS, F.col(code) + 1 if isinstance(code, str) else code + 1)


def part_code(ts: Column | str) -> Column:
    """A small number for the part of the day that sorts as its label does."""
    parts = [(start, stop, PART_LABELS.index(label)) for start, stop, label in DAY_PARTS]
    return part_of_day(ts, parts, PART_LABELS.index(NIGHT))


def part_of_code(code: Column | str) -> Column:
    return _listed(PART_LABELS, F.col(code) + 1 if isinstance(code, str) else code + 1)


def weekday_name(ts: Column | str) -> Column:
    return F.date_format(ts, "EEEE")


def month_name(ts: Column | str) -> Column:
    return F.date_format(ts, "MMM")


def first_of_month(day: Column | str) -> Column:
    return F.trunc(day, "MM")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds, each end cut to the second first."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    return seconds_between(start, end) / 60


def time_from_micros(micros: Column | str) -> Column:
    """Exact: no detour over a floating-point number of seconds."""
    return F.timestamp_micros(micros)


def with_habit_columns(trips: DataFrame) -> DataFrame:
    """Adds ``pickup_day`` (weekday name) and ``pickup_time_of_day``."""
    return trips.withColumns(
        {
            "pickup_day": weekday_name("pickup_datetime"),
            "pickup_time_of_day": part_of_day("pickup_datetime"),
        }
    )


def with_habit_codes(trips: DataFrame) -> DataFrame:
    """As ``with_habit_columns`` with codes in place of names, for counting."""
    return trips.withColumns({"pickup_day": weekday_code("pickup_datetime"), "pickup_time_of_day": part_code("pickup_datetime")})


def with_habit_names(df: DataFrame) -> DataFrame:
    """Names in place of the codes, in those habit columns that are there."""
    names = {"pickup_day": weekday_of_code, "pickup_time_of_day": part_of_code}
    return df.withColumns({name: named(name) for name, named in names.items() if name in df.columns})


def with_calendar_columns(trips: DataFrame) -> DataFrame:
    """Adds year, month, weekday, hour, date and month number of the pick-up."""
    at = F.col("pickup_datetime")
    return trips.withColumns(
        {
            "year": F.year(at),
            "month": month_name(at),
            "dow": weekday_name(at),
            "pickup_hour": F.hour(at),
            "pickup_date": F.to_date(at),
            "pickup_month": F.month(at),
        }
    )
