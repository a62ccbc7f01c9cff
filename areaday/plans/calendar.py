"""The calendar: one row per day, with holiday flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaday.fixed import ZONES
from areaday.functions.dates import calendar_parts
from areaday.functions.text import snake
from areaday.operators.intervals import flag_days


def date_spine(bounds: DataFrame) -> DataFrame:
    """Every day from ``lo`` to ``hi`` of the one row of ``bounds``."""
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))


def calendar(bounds: DataFrame, public_holidays: DataFrame, school_holidays: DataFrame) -> DataFrame:
    """``date``, its parts, the public-holiday flag, and one school-holiday flag per zone.

    A range counts for each zone whose key its own zone text contains; a range without one for none.
    Public holidays are ranges of one day, so that one grouping by day gives all flags.
    """
    holiday = F.to_date("date").cast("timestamp")
    ranges = (
        public_holidays.select(holiday.alias("start_date"), holiday.alias("end_date"))
        .withColumns({"zone": F.lit(None).cast("string"), "public": F.lit(True)})
        .unionByName(school_holidays.select("start_date", "end_date", "zone", F.lit(False).alias("public")))
    )
    zones = {zone: snake(F.col("zone")).contains(zone) for zone in ZONES}
    days = date_spine(bounds).withColumns(calendar_parts(F.col("date")))
    return flag_days(days, ranges, {"public_holidays": F.col("public"), **zones}, bounds)
