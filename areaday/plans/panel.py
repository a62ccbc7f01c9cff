"""The dense panel, one row per commune and day, and the training set made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areaday.fixed import COUNT, PANEL, WEATHER, YEARS, ZONES
from areaday.functions.dates import date_of_parts, date_of_parts_or_null
from areaday.functions.text import zero_pad
from areaday.operators.aggregates import year_bounds
from areaday.plans.calendar import calendar
from areaday.schemas import require_columns
from areaday.session import wide_partitions


def department_communes(communes: DataFrame, dep: str) -> DataFrame:
    """The communes of one department as the panel takes them."""
    return communes.select(F.lit(dep).alias("dep"), F.col("code").alias("com"), "population")


def communes_by_code(communes: DataFrame) -> DataFrame:
    """One row per department and commune code."""
    return communes.groupBy("dep", "com").agg(F.max("population").alias("population"))


def count_bounds(counts: DataFrame, allowed: tuple[int, int] = YEARS) -> DataFrame:
    """One row: first and last day of the years that have accidents, as ``lo`` and ``hi``; all must be ``allowed``.

    Asking for positive counts keeps the grouped counts as they are in this plan, so that Spark runs
    their aggregation once for the bounds and for the panel.
    """
    return year_bounds(counts.filter(F.col(COUNT) > 0), allowed=allowed)


def dense_counts(communes: DataFrame, counts: DataFrame, bounds: DataFrame) -> DataFrame:
    """``com, population, dep, date`` and the count, 0 on days without accidents.

    Only the counted days are joined to the communes and shuffled. Each of them is then stretched up
    to the day before the commune's next one, and the first also back to the start, so the dense rows
    come out of a map step. A commune has at most one counted row per day of the bounds, so its stretches
    stay in one partition: what is grouped by commune afterwards needs no shuffle of the dense rows.
    """
    n = wide_partitions(communes.sparkSession)
    limit = bounds.select(F.struct("lo", "hi")).scalar()
    day = date_of_parts_or_null(F.col("an"), F.col("mois"), F.col("jour"))
    area = communes_by_code(communes)
    counted = (
        counts.select("dep", "com", COUNT, F.when(F.col(COUNT) > 0, day).alias("day"))
        .filter(F.col("day").isNotNull())
    )
    in_area = Window.partitionBy("dep", "com").orderBy("day")
    stretches = (
        area.join(counted, ["dep", "com"], "left")
        .withColumns({"_before": F.lag("day").over(in_area), "_next": F.lead("day").over(in_area)})
        .withColumn("_limit", limit)
        .withColumns(
            {
                "_from": F.when(F.col("_before").isNull(), F.col("_limit.lo")).otherwise(F.col("day")),
                "_to": F.coalesce(F.date_sub("_next", 1), F.col("_limit.hi")),
            }
        )
    )
    spread = stretches.repartition(n, "com", "dep")
    days = spread.select(
        "com", "population", "dep", "day", COUNT, F.explode(F.sequence("_from", "_to")).alias("date")
    )
    filled = F.when(F.col("date") == F.col("day"), F.col(COUNT)).otherwise(0).cast("int")
    return days.select("com", "population", "dep", "date", filled.alias(COUNT))


def join_days(dense: DataFrame, days: DataFrame) -> DataFrame:
    """The dense rows with what ``days`` has for their date; only whole numbers as keys are found without hashing a row."""
    numbered = days.withColumn("_day", F.unix_date("date")).drop("date")
    return dense.join(F.broadcast(numbered), F.unix_date(dense["date"]) == F.col("_day")).drop("_day")


def panel(days: DataFrame, communes: DataFrame, counts: DataFrame, bounds: DataFrame) -> DataFrame:
    """Communes by days of the calendar, with flags and counts; the month is two-digit text."""
    padded = days.withColumn("mois", zero_pad(F.col("mois").cast("string")))
    return join_days(dense_counts(communes, counts, bounds), padded).select(*PANEL)


def count_calendars(counts: DataFrame) -> DataFrame:
    """One row per department and commune: its counts as a map of years to maps of days (``100 * mois + jour``).

    Rows are bounded: a commune has at most one count per day of the years. Two counts of a day raise an error.
    """
    numbers = {name: F.col(name).cast("int") for name in ("jour", "mois", "an")}
    known = counts.select("dep", "com", COUNT, *[c.alias(name) for name, c in numbers.items()]).dropna(subset=list(numbers))
    day = F.struct((100 * F.col("mois") + F.col("jour")).alias("day"), F.col(COUNT).alias("n"))
    years = known.groupBy("dep", "com", "an").agg(F.map_from_entries(F.collect_list(day)).alias("days"))
    return years.groupBy("dep", "com").agg(F.map_from_entries(F.collect_list(F.struct("an", "days"))).alias("calendar"))


def join_counts(spine: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts for the rows of a ready panel by its five keys, which are not null, 0 where there is none.

    The counts are first put together per commune, so the join needs the panel by department and commune only: a panel
    that is partitioned or bucketed by these is not shuffled, and none is sorted. For a panel that is not there yet,
    ``dense_counts`` gives the same.
    """
    calendars = count_calendars(counts).withColumnsRenamed({"dep": "_dep", "com": "_com", "calendar": "_calendar"})
    same = (F.col("dep") == F.col("_dep")) & (F.col("com") == F.col("_com"))
    joined = spine.join(calendars.hint("shuffle_hash"), same, "left")
    days = F.try_element_at("_calendar", F.col("an").cast("int"))
    found = F.try_element_at(days, (100 * F.col("mois") + F.col("jour")).cast("int"))
    return joined.select(*spine.columns, F.coalesce(found, F.lit(0)).cast("int").alias(COUNT))


def with_weather(ready: DataFrame, weather: DataFrame) -> DataFrame:
    """A ready panel with its date and the day's weather, which has one row per day.

    Days outside the allowed years match no row, so what is broadcast has a bound.
    """
    require_columns(ready, ["jour", "mois", "an"])
    numbers = {c: F.col(c).cast("int") for c in ("jour", "mois", "an")}
    dated = ready.withColumns(numbers).withColumn("date", date_of_parts(F.col("an"), F.col("mois"), F.col("jour")))
    per_day = weather.filter(F.year("date").between(*YEARS)).select("date", *WEATHER)
    return dated.join(F.broadcast(per_day), "date", "left").select(*dated.columns, *WEATHER)


def training_set(
    communes: DataFrame,
    counts: DataFrame,
    public_holidays: DataFrame,
    school_holidays: DataFrame,
    weather: DataFrame,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Panel, date and weather as one plan.

    Flags and weather are first put together per day; that table has one row per day of the bounds and
    is the only one broadcast to the panel.
    """
    bounds = count_bounds(counts) if bounds is None else bounds
    flags = calendar(bounds, public_holidays, school_holidays)
    days = flags.join(weather.select("date", *WEATHER), "date", "left")
    dense = join_days(dense_counts(communes, counts, bounds), days)
    return dense.select(
        "com", "population", "jour", "mois", "an", "public_holidays", *ZONES, "dep", COUNT, "date", *WEATHER
    )
