"""Date and time expressions. The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from areaday.fixed import READING_TIME
from areaday.functions.text import first_match


def french_date(text: Column) -> Column:
    return F.to_date(text, "dd/MM/yyyy")


def reading_time(dt_iso: Column) -> Column:
    """The time in a reading's text, without its offset and zone name; null if there is none."""
    return F.to_timestamp(first_match(dt_iso, READING_TIME))


def utc_instant(text: Column) -> Column:
    """An ISO text as an instant: its offset applies, and without one it is UTC."""
    return F.to_timestamp(text)


def date_of_parts(year: Column, month: Column, day: Column) -> Column:
    """A date from its parts; parts that are no date raise an error."""
    return F.make_date(year.cast("int"), month.cast("int"), day.cast("int"))


def date_of_parts_or_null(year: Column, month: Column, day: Column) -> Column:
    zero = F.lit(0)
    return F.to_date(F.try_make_timestamp(year, month, day, zero, zero, zero))


def days_between(first: Column, last: Column) -> Column:
    """All days from ``first`` to ``last`` as an array; empty if ``first`` is later."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def first_midnight(instant: Column) -> Column:
    """The first day whose midnight is not before ``instant``."""
    day = F.to_date(instant)
    return F.when(instant > day.cast("timestamp"), F.date_add(day, 1)).otherwise(day)


def calendar_parts(date: Column) -> dict[str, Column]:
    return {"jour": F.dayofmonth(date), "mois": F.month(date), "an": F.year(date)}


def calendar_features(date: Column) -> dict[str, Column]:
    """Year, month, day, weekday (Monday is 0) and weekend flag."""
    weekday = F.weekday(date)
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "weekday": weekday,
        "weekend": (weekday >= 5).cast("int"),
    }


def years_around(year: int, span: tuple[int, int]) -> tuple[int, int]:
    """First and last year of a span given relative to ``year``."""
    return year + span[0], year + span[1]
