"""From landed files to the loaded training table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from areaday.fixed import FILES_READ, PUBLIC_HOLIDAY_YEARS
from areaday.functions.dates import years_around
from areaday.plans.counts import accident_counts
from areaday.plans.panel import department_communes, training_set
from areaday.plans.weather import weather_daily
from areaday.sinks.files import write_csv
from areaday.sinks.tables import Audit, LoadResult, load
from areaday.sources import documents, files
from areaday.sources.quarantine import Quarantine


def training_set_from_files(
    spark: SparkSession,
    landing: str,
    dep: str,
    year: int,
    n_files: int = FILES_READ,
    quarantine: Quarantine | None = None,
) -> DataFrame:
    """The training set of one department, as one plan over the files below ``landing``.

    ``accidents`` holds one file per year, of which the ``n_files`` latest are read; ``communes``,
    ``public_holidays`` (named by year) and ``school_holidays`` hold JSON documents, ``weather_history``
    CSV. ``year`` is the year that the holidays are chosen around. With ``quarantine`` documents of communes and school
    holidays that cannot be read are put there, and the others used.
    """
    return training_set(
        department_communes(documents.read_communes(spark, f"{landing}/communes", quarantine=quarantine), dep),
        accident_counts(files.read_accidents(spark, f"{landing}/accidents", n_files), dep),
        documents.read_public_holidays(spark, f"{landing}/public_holidays", *years_around(year, PUBLIC_HOLIDAY_YEARS)),
        documents.read_school_holidays(spark, f"{landing}/school_holidays", year, quarantine=quarantine),
        weather_daily(files.read_weather_hourly(spark, f"{landing}/weather_history")),
    )


def run(
    spark: SparkSession,
    landing: str,
    table: str,
    audit: Audit,
    dep: str,
    year: int,
    path: str | None = None,
    n_files: int = FILES_READ,
    publish: str | None = None,
    quarantine: Quarantine | None = None,
) -> LoadResult:
    """Build the training set and replace ``table`` with it; ``path`` is where a new table's files go.

    With ``publish`` the loaded rows are also written there as CSV.
    """
    rows = training_set_from_files(spark, landing, dep, year, n_files, quarantine)
    loaded = load(rows, table, audit, path=path, partition_by=["an"])
    if publish:
        write_csv(spark.table(table), publish)
    return loaded
