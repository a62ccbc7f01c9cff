"""Accident counts per day and commune."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaday.fixed import COUNT, COUNT_KEYS
from areaday.operators.aggregates import count_by


def accident_counts(accidents: DataFrame, dep: str | None = None) -> DataFrame:
    """Accidents per day, department and commune, of one department or of all.

    Day, month and year are numbers, so that ``1`` and ``01`` are one day; department and commune
    codes stay text. The department is filtered before the rows are grouped.
    """
    chosen = accidents if dep is None else accidents.filter(F.col("dep") == dep)
    numbers = {c: F.col(c).cast("int") for c in ("jour", "mois", "an")}
    return count_by(chosen.select(*COUNT_KEYS).withColumns(numbers), COUNT_KEYS, COUNT)
