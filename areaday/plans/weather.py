"""Daily weather from hourly readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaday.fixed import DAILY_MEAN, WEATHER
from areaday.functions.dates import reading_time


def daily_measures() -> list[Column]:
    """The day's mean of each measure, but its lowest ``temp_min`` and highest ``temp_max``."""
    measures = {c: F.avg(c) for c in DAILY_MEAN}
    measures.update(temp_min=F.min("temp_min"), temp_max=F.max("temp_max"))
    return [measures[c].alias(c) for c in WEATHER]


def weather_daily(hourly: DataFrame) -> DataFrame:
    """One row per day; readings whose text holds no time are left out."""
    dated = hourly.withColumn("date", F.to_date(reading_time(F.col("dt_iso"))))
    return dated.filter(F.col("date").isNotNull()).groupBy("date").agg(*daily_measures())
