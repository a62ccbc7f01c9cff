"""From a resource catalogue to the files to fetch, and their completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaday.fixed import FILE_SUFFIX, FILES_PER_YEAR, RESOURCE_FORMAT, TITLE_EXCLUDED, TITLE_KEYWORDS
from areaday.functions.text import contains_any, contains_none, part, snake, with_suffix
from areaday.operators.aggregates import count_by
from areaday.operators.joins import not_in_store


def data_files(resources: DataFrame) -> DataFrame:
    """The resources that are data files, with the file name each is stored under."""
    title = F.lower("title")
    wanted = (
        contains_any(title, TITLE_KEYWORDS)
        & contains_none(title, TITLE_EXCLUDED)
        & (F.col("format") == RESOURCE_FORMAT)
    )
    return resources.filter(wanted).withColumn("name", with_suffix(snake(F.col("title")), FILE_SUFFIX))


def files_to_fetch(resources: DataFrame, stored: DataFrame) -> DataFrame:
    """The data files that the store, a table with a ``name`` column, does not have yet."""
    return not_in_store(data_files(resources), stored, "name")


def files_per_year(files: DataFrame, name: str = "name") -> DataFrame:
    """How many files each year has; the year is the last piece of the name before its suffix."""
    piece = F.when(F.col(name).contains("_"), part(F.col(name), "_", -1)).when(
        F.col(name).contains("-"), part(F.col(name), "-", -1)
    )
    year = F.nullif(part(piece, ".", 1), F.lit(""))
    return count_by(files.select(year.alias("year")), ["year"], "files")


def incomplete_years(files: DataFrame, name: str = "name", expected: int = FILES_PER_YEAR) -> DataFrame:
    """The years that do not have the expected number of files."""
    return files_per_year(files, name).filter(F.col("files") != expected)
