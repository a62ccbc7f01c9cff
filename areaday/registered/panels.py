"""Counts, calendar, panel, weather and training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaday.functions.text import zero_pad
from areaday.operators.aggregates import year_bounds
from areaday.operators.intervals import flag_days
from areaday.plans import calendar as cal
from areaday.plans import panel as pan
from areaday.plans.counts import accident_counts as count_accidents
from areaday.plans.weather import weather_daily as daily
from areaday.registered import given
from areaday.session import wide_partitions


def order_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return year_bounds(given.table(spark, sf, "orders").select(F.year("o_orderdate").alias("an")))


def department_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_accidents(given.accidents(spark, sf), given.DEPARTMENT)


def accident_counts(spark, sf):
    return department_counts(spark, sf)


def group_count_keys(spark, sf):
    return count_accidents(given.accidents(spark, sf))


def year_bounds_of_orders(spark, sf):
    return order_bounds(spark, sf)


def date_spine(spark, sf):
    return cal.date_spine(order_bounds(spark, sf))


def calendar_flags(spark, sf):
    return cal.calendar(order_bounds(spark, sf), given.public_holidays(spark, sf), given.school_holidays(spark, sf))


def interval_exists(spark, sf):
    """Days of the orders that lie in any range at all, and in one of zone A."""
    bounds = order_bounds(spark, sf)
    flags = {"any_zone": F.col("zone").isNotNull(), "zone_a": F.col("zone") == "Zone A"}
    return flag_days(cal.date_spine(bounds), given.school_holidays(spark, sf), flags, bounds)


def weather_daily(spark, sf):
    return given.rounded(daily(given.weather_hourly(spark, sf)))


def panel_dense(spark, sf):
    counts = department_counts(spark, sf)
    return pan.dense_counts(given.communes(spark, sf, given.DEPARTMENT), counts, pan.count_bounds(counts))


def panel(spark, sf):
    counts = department_counts(spark, sf)
    bounds = pan.count_bounds(counts)
    days = cal.calendar(bounds, given.public_holidays(spark, sf), given.school_holidays(spark, sf))
    return pan.panel(days, given.communes(spark, sf, given.DEPARTMENT), counts, bounds)


def commune_days(spark: SparkSession, sf: str, dep: str | None) -> DataFrame:
    """A ready panel without counts: every commune on every day of the orders."""
    day = F.struct(F.dayofmonth("date").alias("jour"), F.month("date").alias("mois"), F.year("date").alias("an"))
    days = cal.date_spine(order_bounds(spark, sf)).agg(F.collect_list(day)).scalar()
    spread = given.communes(spark, sf, dep).repartition(wide_partitions(spark), "dep", "com")
    return spread.select("dep", "com", F.inline(days)).select("jour", "mois", "an", "dep", "com")


def panel_cross(spark, sf):
    return commune_days(spark, sf, given.DEPARTMENT)


def panel_counts(spark, sf):
    return pan.join_counts(commune_days(spark, sf, given.DEPARTMENT), department_counts(spark, sf))


def panel_counts_by_commune(spark, sf):
    """The five-key join for all departments, summed up per commune and year."""
    joined = pan.join_counts(commune_days(spark, sf, None), count_accidents(given.accidents(spark, sf)))
    return joined.groupBy("dep", "com", "an").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("nombre_d_accidents").alias("accidents"),
        F.count_if(F.col("nombre_d_accidents") > 0).alias("days_with_accidents"),
    )


def left_join_date(spark, sf):
    daily_counts = count_accidents(given.accidents(spark, sf))
    per_day = daily_counts.groupBy("jour", "mois", "an").agg(F.sum("nombre_d_accidents").alias("nombre_d_accidents"))
    return pan.with_weather(per_day, weather_daily(spark, sf))


def training(spark: SparkSession, sf: str, dep: str | None) -> DataFrame:
    return pan.training_set(
        given.communes(spark, sf, dep),
        count_accidents(given.accidents(spark, sf), dep),
        given.public_holidays(spark, sf),
        given.school_holidays(spark, sf),
        weather_daily(spark, sf),
    )


def training_set(spark, sf):
    return training(spark, sf, given.DEPARTMENT)


def training_set_by_month(spark, sf):
    """The training set of all departments, summed up per department and month."""
    per_month = training(spark, sf, None).groupBy("dep", "an", "mois").agg(
        F.count(F.lit(1)).alias("area_days"),
        F.sum("nombre_d_accidents").alias("accidents"),
        F.count_if("public_holidays").alias("public_holidays"),
        F.count_if(F.col("zone_a") | F.col("zone_b") | F.col("zone_c")).alias("school_holidays"),
        F.count("temp").alias("with_weather"),
        F.min("temp_min").alias("temp_min"),
    )
    return per_month.withColumn("mois", zero_pad(F.col("mois").cast("string")))


def panel_by_commune(spark, sf):
    """The panel of all departments, summed up per commune and year."""
    counts = count_accidents(given.accidents(spark, sf))
    bounds = pan.count_bounds(counts)
    days = cal.calendar(bounds, given.public_holidays(spark, sf), given.school_holidays(spark, sf))
    whole = pan.panel(days, given.communes(spark, sf), counts, bounds)
    # The least of texts would sort all rows of the panel; that of numbers does not.
    per_year = whole.groupBy("dep", "com", "population", "an").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("nombre_d_accidents").alias("accidents"),
        F.count_if("public_holidays").alias("public_holidays"),
        F.count_if("zone_b").alias("zone_b"),
        F.min(F.col("mois").cast("int")).alias("first_month"),
    )
    return per_year.withColumn("first_month", zero_pad(F.col("first_month").cast("string")))


DEP = given.DEPARTMENT
DEP_COUNTS = f"SELECT * FROM ({given.COUNTS}) WHERE dep = '{DEP}'"
DEP_COMMUNES = f"SELECT * FROM ({given.COMMUNES}) WHERE dep = '{DEP}'"
PANEL = f"""
WITH cal AS ({given.calendar_sql(given.DEP_SPINE)}), n AS ({DEP_COUNTS}), c AS ({DEP_COMMUNES})
SELECT c.com, c.population, cal.jour, cal.mois, cal.an, cal.public_holidays, cal.zone_a, cal.zone_b, cal.zone_c, c.dep,
       CAST(coalesce(n.nombre_d_accidents, 0) AS INTEGER) AS nombre_d_accidents, cal.date
FROM c CROSS JOIN cal
LEFT JOIN n ON n.com = c.com AND n.dep = c.dep AND n.jour = cal.jour AND n.mois = cal.mois AND n.an = cal.an"""

QUERIES = {
    "accident_counts": (accident_counts, DEP_COUNTS),
    "group_count_keys": (group_count_keys, given.COUNTS),
    "year_bounds": (
        year_bounds_of_orders,
        """SELECT make_date(CAST(min(year(o_orderdate)) AS INTEGER), 1, 1) AS lo,
                  make_date(CAST(max(year(o_orderdate)) AS INTEGER), 12, 31) AS hi FROM orders""",
    ),
    "date_spine": (date_spine, given.SPINE),
    "calendar_flags": (calendar_flags, given.calendar_sql(given.SPINE)),
    "interval_exists": (
        interval_exists,
        f"""SELECT d.date,
                   EXISTS (SELECT 1 FROM ({given.SCHOOL}) s
                           WHERE CAST(d.date AS TIMESTAMP) BETWEEN s.start_date AND s.end_date) AS any_zone,
                   EXISTS (SELECT 1 FROM ({given.SCHOOL}) s WHERE s.zone = 'Zone A'
                           AND CAST(d.date AS TIMESTAMP) BETWEEN s.start_date AND s.end_date) AS zone_a
            FROM ({given.SPINE}) d""",
    ),
    "weather_daily": (weather_daily, given.DAILY),
    "panel_zero_fill": (panel_dense, f"SELECT com, population, dep, date, nombre_d_accidents FROM ({PANEL})"),
    "panel": (
        panel,
        f"SELECT * EXCLUDE (date) REPLACE (lpad(CAST(mois AS VARCHAR), 2, '0') AS mois) FROM ({PANEL})",
    ),
    "panel_by_commune": (
        panel_by_commune,
        f"""WITH cal AS ({given.calendar_sql(given.SPINE)}),
                 y AS (SELECT an, count(*) AS days, CAST(count_if(public_holidays) AS BIGINT) AS public_holidays,
                              CAST(count_if(zone_b) AS BIGINT) AS zone_b FROM cal GROUP BY 1),
                 n AS (SELECT dep, com, an, CAST(sum(nombre_d_accidents) AS BIGINT) AS accidents FROM ({given.COUNTS}) GROUP BY ALL)
            SELECT c.dep, c.com, c.population, y.an, y.days, coalesce(n.accidents, 0) AS accidents, y.public_holidays,
                   y.zone_b, '01' AS first_month
            FROM ({given.COMMUNES}) c CROSS JOIN y LEFT JOIN n ON n.dep = c.dep AND n.com = c.com AND n.an = y.an""",
    ),
    "panel_cross": (
        panel_cross,
        f"""SELECT CAST(day(date) AS INTEGER) AS jour, CAST(month(date) AS INTEGER) AS mois,
                   CAST(year(date) AS INTEGER) AS an, dep, com FROM ({DEP_COMMUNES}) CROSS JOIN ({given.SPINE})""",
    ),
    "panel_counts": (
        panel_counts,
        f"""WITH p AS (SELECT CAST(day(date) AS INTEGER) AS jour, CAST(month(date) AS INTEGER) AS mois,
                              CAST(year(date) AS INTEGER) AS an, dep, com
                       FROM ({DEP_COMMUNES}) CROSS JOIN ({given.SPINE}))
            SELECT p.*, CAST(coalesce(n.nombre_d_accidents, 0) AS INTEGER) AS nombre_d_accidents
            FROM p LEFT JOIN ({DEP_COUNTS}) n USING (jour, mois, an, dep, com)""",
    ),
    "panel_counts_by_commune": (
        panel_counts_by_commune,
        f"""WITH y AS (SELECT CAST(year(date) AS INTEGER) AS an, count(*) AS days FROM ({given.SPINE}) GROUP BY 1),
                 n AS (SELECT dep, com, an, CAST(sum(nombre_d_accidents) AS BIGINT) AS accidents, count(*) AS busy
                       FROM ({given.COUNTS}) GROUP BY ALL)
            SELECT c.dep, c.com, y.an, y.days, coalesce(n.accidents, 0) AS accidents,
                   coalesce(n.busy, 0) AS days_with_accidents
            FROM ({given.COMMUNES}) c CROSS JOIN y LEFT JOIN n ON n.dep = c.dep AND n.com = c.com AND n.an = y.an""",
    ),
    "left_join_date": (
        left_join_date,
        f"""WITH d AS (SELECT jour, mois, an, CAST(count(*) AS BIGINT) AS nombre_d_accidents
                       FROM ({given.ACCIDENTS}) GROUP BY ALL)
            SELECT d.*, make_date(an, mois, jour) AS date, w.* EXCLUDE (date)
            FROM d LEFT JOIN ({given.DAILY}) w ON w.date = make_date(an, mois, jour)""",
    ),
    "training_set": (
        training_set,
        f"SELECT p.*, w.* EXCLUDE (date) FROM ({PANEL}) p LEFT JOIN ({given.DAILY}) w ON w.date = p.date",
    ),
    "training_set_by_month": (
        training_set_by_month,
        f"""WITH cal AS ({given.calendar_sql(given.SPINE)}), w AS ({given.DAILY}),
                 c AS (SELECT dep, count(*) AS communes FROM ({given.COMMUNES}) GROUP BY 1),
                 n AS (SELECT dep, mois, an, sum(nombre_d_accidents) AS accidents FROM ({given.COUNTS}) GROUP BY ALL),
                 m AS (SELECT an, mois, count(*) AS days, count_if(public_holidays) AS public_holidays,
                              count_if(zone_a OR zone_b OR zone_c) AS school_holidays, count(temp) AS with_weather,
                              min(temp_min) AS temp_min FROM cal LEFT JOIN w USING (date) GROUP BY 1, 2)
            SELECT c.dep, m.an, lpad(CAST(m.mois AS VARCHAR), 2, '0') AS mois, CAST(days * communes AS BIGINT) AS area_days,
                   CAST(coalesce(n.accidents, 0) AS BIGINT) AS accidents,
                   CAST(public_holidays * communes AS BIGINT) AS public_holidays,
                   CAST(school_holidays * communes AS BIGINT) AS school_holidays,
                   CAST(with_weather * communes AS BIGINT) AS with_weather, round(temp_min, 9) AS temp_min
            FROM c CROSS JOIN m LEFT JOIN n ON n.dep = c.dep AND n.an = m.an AND n.mois = m.mois""",
    ),
}
