"""The data of a day's map: flagged communes, the extent, and the day's summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaday.fixed import COLOUR_CLEAR, COLOUR_FLAGGED, LABEL_NO, LABEL_YES
from areaday.operators.aggregates import bounding_box
from areaday.operators.joins import membership_flag
from areaday.operators.ranking import first_rows


def of_day(predictions: DataFrame, year: int, month: int, day: int) -> DataFrame:
    return predictions.filter((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))


def colour(flagged: Column) -> Column:
    return F.when(flagged, COLOUR_FLAGGED).otherwise(COLOUR_CLEAR)


def commune_flags(features: DataFrame, day_rows: DataFrame, predicted_only: bool = False) -> DataFrame:
    """Features with ``accident`` (0 or 1) and a colour.

    A commune is flagged if it has any row that day, or with ``predicted_only`` a row whose own
    ``accident`` is 1.
    """
    rows = day_rows.filter(F.col("accident") == 1) if predicted_only else day_rows
    flagged = membership_flag(features, rows.select(F.col("com").cast("string")), "code", "accident")
    return flagged.withColumns(
        {
            "accident": F.col("accident").cast("int"),
            "colour": colour(F.col("accident")),
        }
    )


def map_extent(features: DataFrame) -> DataFrame:
    """Extent and centre of all polygons."""
    points = F.flatten(F.flatten("polygons"))
    return bounding_box(
        features, F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    )


def yes_no(flag: Column) -> Column:
    return F.when(flag == 1, LABEL_YES).otherwise(LABEL_NO)


def day_summary(day_rows: DataFrame, flags: list[str], order: list[str]) -> DataFrame:
    """The first row of the day, with its flags as labels."""
    return first_rows(day_rows, order).withColumns({c: yes_no(F.col(c)) for c in flags})
