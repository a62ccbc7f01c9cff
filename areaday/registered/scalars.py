"""Scalar functions over whole columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from areaday.fixed import PUBLIC_HOLIDAY_YEARS, READING_TIME, SCHOOL_HOLIDAY_YEARS
from areaday.functions import dates, text
from areaday.plans.catalogue import data_files, files_to_fetch
from areaday.registered import given


def text_functions(spark, sf):
    name = F.col("p_name")
    key = F.col("p_partkey").cast("string")
    return given.table(spark, sf, "part").select(
        "p_partkey",
        F.lower("p_brand").alias("lower"),
        text.snake(F.upper(name)).alias("snake"),
        text.with_suffix(name, "ring").alias("suffixed"),
        text.contains_any(name, ["ring", "red"]).alias("any_of"),
        text.contains_none(name, ["ring", "red"]).alias("none_of"),
        text.zero_pad(key).alias("padded"),
        text.strip(F.concat(F.lit(" \t"), name, F.lit("\n "))).alias("stripped"),
        text.part(name, " ", 1).alias("first_part"),
        text.part(name, " ", -1).alias("last_part"),
        text.base_name(F.concat(F.lit("a/b/"), key)).alias("base_name"),
        F.concat_ws("-", "p_brand", "p_type").alias("joined"),
        key.cast("bigint").alias("back"),
        F.round(F.col("p_retailprice") / 7, 4).alias("shown"),
    )


def regex_extract(spark, sf):
    """The last four-digit run after ``car``, and the first part of the text before a full stop, if any."""
    names = given.file_names(spark, sf).distinct()
    return names.select(
        "name",
        text.first_match(F.col("name"), r"car.*(\d{4})").cast("int").alias("year"),
        text.first_match(F.col("name"), r"_(en|fr)_").alias("lang"),
    )


def document_words(spark, sf):
    """The first run of digits in each whole text, null where there is none."""
    return given.table(spark, sf, "documents").select(
        "doc_id", text.first_match(F.col("text"), r"([0-9]+)").alias("digits"), F.length("text").cast("bigint").alias("n")
    )


def regex_timestamp(spark, sf):
    time = dates.reading_time(F.col("dt_iso"))
    return given.weather_hourly(spark, sf).select(
        "dt_iso",
        F.date_format(time, "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.to_date(time).alias("date"),
    )


def calendar_features(spark, sf):
    day = F.to_date("o_orderdate")
    features = dates.calendar_features(day)
    return given.table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in features.items()])


def date_functions(spark, sf):
    day = F.to_date("o_orderdate")
    french = F.date_format(day, "dd/MM/yyyy")
    iso = F.date_format(day, "yyyy-MM-dd'T'00:30:00+02:00")
    instant = dates.utc_instant(iso)
    return given.table(spark, sf, "orders").select(
        "o_orderkey",
        dates.french_date(french).alias("parsed"),
        dates.date_of_parts(F.year(day), F.month(day), F.dayofmonth(day)).alias("built"),
        dates.date_of_parts_or_null(F.year(day), F.month(day), F.lit(31)).alias("end_of_month"),
        F.date_format(instant, "yyyy-MM-dd HH:mm:ss").alias("utc"),
        dates.first_midnight(instant).alias("midnight"),
        F.concat_ws("-", F.year(day).cast("string"), F.month(day).cast("string")).alias("year_month"),
        *[c.alias(n) for n, c in dates.calendar_parts(day).items()],
    )


def year_windows(spark, sf):
    """Orders in the years that holidays are fetched for, seen from 1999."""
    public, school = dates.years_around(2015, PUBLIC_HOLIDAY_YEARS), dates.years_around(1999, SCHOOL_HOLIDAY_YEARS)
    year = F.year("o_orderdate")
    return given.table(spark, sf, "orders").select(
        "o_orderkey", year.between(*public).alias("public"), year.between(*school).alias("school")
    )


def json_field_default(spark, sf):
    value = F.get_json_object("props", "$.k").cast("int")
    none = F.get_json_object("props", "$.none")
    return given.table(spark, sf, "events").select(
        "event_id", F.coalesce(value, F.lit(0)).alias("k"), F.coalesce(none, F.lit("noname")).alias("title")
    )


def struct_columns(spark, sf):
    info = F.struct(*[c.alias(n) for n, c in dates.calendar_parts(F.to_date("o_orderdate")).items()])
    nested = given.table(spark, sf, "orders").select("o_orderkey", info.alias("date_info"))
    return nested.select("o_orderkey", "date_info.*")


def resources(spark, sf):
    """Documents as catalogue resources of six kinds and two formats."""
    kinds = ["Usagers", "Vehicules", "Lieux", "Caracteristiques", "Description des usagers", "vehicules-immatricules-baac"]
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("doc_id") % 6 + 1).cast("int"))
    year = (2000 + F.col("doc_id") % 20).cast("string")
    title = F.concat_ws(" ", kind, "source", "lang", year)
    return given.table(spark, sf, "documents").select(
        F.when(F.col("doc_id") % 7 == 0, F.concat(title, F.lit(".csv"))).otherwise(title).alias("title"),
        F.concat(F.lit("u/"), F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("doc_id") % 5 == 0, "pdf").otherwise("csv").alias("format"),
        "lang",
    )


def catalogue_filter(spark, sf):
    return data_files(resources(spark, sf)).drop("lang")


def catalogue_files(spark, sf):
    rows = resources(spark, sf)
    stored = data_files(rows.filter(F.col("lang") == "en"))
    return files_to_fetch(rows, stored).select("name", "title", "url", "format")


RESOURCES = """
SELECT CASE WHEN doc_id % 7 = 0 THEN t || '.csv' ELSE t END AS title, 'u/' || CAST(doc_id AS VARCHAR) AS url,
       CASE WHEN doc_id % 5 = 0 THEN 'pdf' ELSE 'csv' END AS format, lang
FROM (SELECT doc_id, lang, list_extract(['Usagers', 'Vehicules', 'Lieux', 'Caracteristiques', 'Description des usagers',
             'vehicules-immatricules-baac'], CAST(doc_id % 6 + 1 AS BIGINT)) || ' ' || source || ' ' || lang || ' '
             || CAST(2000 + doc_id % 20 AS VARCHAR) AS t FROM documents)"""
DATA_FILES = f"""
SELECT *, CASE WHEN ends_with(n, '.csv') THEN n ELSE n || '.csv' END AS name
FROM (SELECT *, replace(lower(title), ' ', '_') AS n FROM ({RESOURCES}))
WHERE (contains(lower(title), 'usa') OR contains(lower(title), 'vehi') OR contains(lower(title), 'lieu')
       OR contains(lower(title), 'car'))
  AND NOT contains(lower(title), 'vehicules-immatricules-baac') AND NOT contains(lower(title), 'description')
  AND format = 'csv'"""

QUERIES = {
    "text_functions": (
        text_functions,
        """SELECT p_partkey, lower(p_brand) AS lower, replace(lower(p_name), ' ', '_') AS snake,
                  CASE WHEN ends_with(p_name, 'ring') THEN p_name ELSE p_name || 'ring' END AS suffixed,
                  contains(p_name, 'ring') OR contains(p_name, 'red') AS any_of,
                  NOT (contains(p_name, 'ring') OR contains(p_name, 'red')) AS none_of,
                  CASE WHEN p_partkey < 10 THEN '0' ELSE '' END || CAST(p_partkey AS VARCHAR) AS padded,
                  trim(p_name) AS stripped, split_part(p_name, ' ', 1) AS first_part,
                  split_part(p_name, ' ', -1) AS last_part, CAST(p_partkey AS VARCHAR) AS base_name,
                  p_brand || '-' || p_type AS joined, p_partkey AS back, round(p_retailprice / 7, 4) AS shown FROM part""",
    ),
    "regex_extract": (
        regex_extract,
        f"""SELECT DISTINCT name, CAST(nullif(regexp_extract(name, 'car.*(\\d{{4}})', 1), '') AS INTEGER) AS year,
                   nullif(regexp_extract(name, '_(en|fr)_', 1), '') AS lang FROM ({given.FILES})""",
    ),
    "document_digits": (
        document_words,
        """SELECT doc_id, nullif(regexp_extract(text, '([0-9]+)', 1), '') AS digits, length(text) AS n FROM documents""",
    ),
    "regex_timestamp": (
        regex_timestamp,
        f"""SELECT dt_iso, substr(dt_iso, 1, 19) AS time, CAST(substr(dt_iso, 1, 10) AS DATE) AS date
            FROM ({given.HOURLY})""",
    ),
    "calendar_features": (
        calendar_features,
        """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
                  CAST(day(o_orderdate) AS INTEGER) AS day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday,
                  CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS weekend FROM orders""",
    ),
    "date_functions": (
        date_functions,
        """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed, CAST(o_orderdate AS DATE) AS built,
                  CASE WHEN day(last_day(o_orderdate)) = 31 THEN last_day(o_orderdate) END AS end_of_month,
                  strftime(o_orderdate - INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S') AS utc,
                  CAST(o_orderdate AS DATE) AS midnight,
                  CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(month(o_orderdate) AS VARCHAR) AS year_month,
                  CAST(day(o_orderdate) AS INTEGER) AS jour, CAST(month(o_orderdate) AS INTEGER) AS mois,
                  CAST(year(o_orderdate) AS INTEGER) AS an FROM orders""",
    ),
    "year_windows": (
        year_windows,
        """SELECT o_orderkey, year(o_orderdate) BETWEEN 1995 AND 2020 AS public,
                  year(o_orderdate) BETWEEN 1995 AND 2000 AS school FROM orders""",
    ),
    "json_field_default": (
        json_field_default,
        """SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS k,
                  coalesce(json_extract_string(props, '$.none'), 'noname') AS title FROM events""",
    ),
    "struct_columns": (
        struct_columns,
        """SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS jour, CAST(month(o_orderdate) AS INTEGER) AS mois,
                  CAST(year(o_orderdate) AS INTEGER) AS an FROM orders""",
    ),
    "catalogue_filter": (catalogue_filter, f"SELECT title, url, format, name FROM ({DATA_FILES})"),
    "catalogue_files": (
        catalogue_files,
        f"""SELECT name, title, url, format FROM ({DATA_FILES})
            WHERE name NOT IN (SELECT name FROM ({DATA_FILES}) WHERE lang = 'en')""",
    ),
}
