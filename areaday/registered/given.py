"""The given tables in the roles of the pipeline's datasets, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areaday.fixed import WEATHER

# Month and day of the public holidays.
HOLIDAYS = {
    "01-01": "New Year",
    "05-01": "Labour Day",
    "05-08": "Victory Day",
    "07-14": "National Day",
    "08-15": "Assumption",
    "11-01": "All Saints",
    "11-11": "Armistice",
    "12-25": "Christmas",
}
DEPARTMENT = "7"

# The schemas of the given tables, so that no job has to read them from the files.
SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
    " l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def accidents(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as accidents: the customer is the commune, the customer's nation the department."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("Num_Acc"),
        F.dayofmonth("o_orderdate").alias("jour"),
        F.month("o_orderdate").alias("mois"),
        F.year("o_orderdate").alias("an"),
        F.col("c_nationkey").cast("string").alias("dep"),
        F.col("o_custkey").cast("string").alias("com"),
    )


def communes(spark: SparkSession, sf: str, dep: str | None = None) -> DataFrame:
    customer = table(spark, sf, "customer")
    chosen = customer if dep is None else customer.filter(F.col("c_nationkey") == int(dep))
    return chosen.select(
        F.col("c_nationkey").cast("string").alias("dep"),
        F.col("c_custkey").cast("string").alias("com"),
        F.floor("c_acctbal").cast("int").alias("population"),
    )


def public_holidays(spark: SparkSession, sf: str) -> DataFrame:
    dates = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    names = F.create_map(*[F.lit(x) for pair in HOLIDAYS.items() for x in pair])
    named = dates.withColumn("public_holiday", F.try_element_at(names, F.date_format("date", "MM-dd")))
    return named.filter(F.col("public_holiday").isNotNull())


def school_range(key: Column) -> dict[str, Column]:
    """Two weeks from a day that the key gives, both ends at 23:00 UTC of the day before."""
    offset = ((key * 23) % 2557).cast("int")
    start = F.date_add(F.to_date(F.lit("1995-01-01")), offset)
    hour = F.expr("INTERVAL 1 HOUR")
    return {
        "start_date": start.cast("timestamp") - hour,
        "end_date": F.date_add(start, 14).cast("timestamp") - hour,
    }


def school_holidays(spark: SparkSession, sf: str) -> DataFrame:
    letter = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    ranges = school_range(F.col("s_suppkey"))
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("Zone "), letter).alias("zone"),
        F.col("s_name").alias("type"),
        *[c.alias(name) for name, c in ranges.items()],
    )


def weather_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Events as readings, moved into the years of the orders."""
    time = F.date_format(F.expr("ts - INTERVAL 23 YEARS"), "yyyy-MM-dd HH:mm:ss")
    value, user = F.col("value"), F.col("user_id")
    measures = {
        "temp": value,
        "feels_like": value - 1,
        "temp_min": value - 5,
        "temp_max": value + 5,
        "pressure": 1000 + user,
        "humidity": user % 100,
        "wind_speed": value / 10,
        "clouds_all": F.col("event_id") % 101,
    }
    return table(spark, sf, "events").select(
        F.concat(time, F.lit(" +0000 UTC")).alias("dt_iso"),
        *[measures[c].cast("double").alias(c) for c in WEATHER],
    )


def file_names(spark: SparkSession, sf: str) -> DataFrame:
    """One file name per document group: ``car_<source>_<lang>_<year>.csv``."""
    year = (2000 + F.col("doc_id") % 20).cast("string")
    name = F.concat(F.concat_ws("_", F.lit("car"), "source", "lang", year), F.lit(".csv"))
    return table(spark, sf, "documents").select(name.alias("name"))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select(
        "doc_id", F.col("quality").alias("truth"), F.col("toxic").alias("prediction")
    )


def dated_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as predicted rows: urgent ones are accidents."""
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.col("o_custkey").cast("string").alias("com"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("accident"),
        (F.weekday(day) >= 5).cast("int").alias("jour_ferie"),
        F.col("o_totalprice").alias("temp"),
    )


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles without the noise that the order of additions leaves in their last bits."""
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})


ACCIDENTS = """
SELECT o_orderkey AS Num_Acc, CAST(day(o_orderdate) AS INTEGER) AS jour, CAST(month(o_orderdate) AS INTEGER) AS mois,
       CAST(year(o_orderdate) AS INTEGER) AS an, CAST(c_nationkey AS VARCHAR) AS dep, CAST(o_custkey AS VARCHAR) AS com
FROM orders JOIN customer ON o_custkey = c_custkey"""

COUNTS = f"""
SELECT jour, mois, an, dep, com, count(*) AS nombre_d_accidents FROM ({ACCIDENTS}) GROUP BY ALL"""

COMMUNES = """
SELECT CAST(c_nationkey AS VARCHAR) AS dep, CAST(c_custkey AS VARCHAR) AS com,
       CAST(floor(c_acctbal) AS INTEGER) AS population FROM customer"""

SPINE = """
SELECT CAST(unnest(generate_series(make_date(CAST(min(year(o_orderdate)) AS INTEGER), 1, 1),
       make_date(CAST(max(year(o_orderdate)) AS INTEGER), 12, 31), INTERVAL 1 DAY)) AS DATE) AS date FROM orders"""

DEP_SPINE = f"""
SELECT CAST(unnest(generate_series(make_date(min(an), 1, 1), make_date(max(an), 12, 31), INTERVAL 1 DAY)) AS DATE) AS date
FROM ({ACCIDENTS}) WHERE dep = '{DEPARTMENT}'"""

PUBLIC = f"""
SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders
WHERE strftime(o_orderdate, '%m-%d') IN ({", ".join(f"'{d}'" for d in HOLIDAYS)})"""

SCHOOL = """
SELECT 'Zone ' || substr('ABC', CAST(s_suppkey % 3 + 1 AS INTEGER), 1) AS zone, s_name AS type,
       DATE '1995-01-01' + to_days(CAST((s_suppkey * 23) % 2557 AS INTEGER)) - INTERVAL 1 HOUR AS start_date,
       DATE '1995-01-01' + to_days(CAST((s_suppkey * 23) % 2557 AS INTEGER) + 14) - INTERVAL 1 HOUR AS end_date
FROM supplier"""


def calendar_sql(spine: str) -> str:
    zones = ", ".join(
        f"EXISTS (SELECT 1 FROM ({SCHOOL}) s WHERE CAST(d.date AS TIMESTAMP) BETWEEN s.start_date AND s.end_date"
        f" AND contains(replace(lower(s.zone), ' ', '_'), '{z}')) AS {z}"
        for z in ("zone_a", "zone_b", "zone_c")
    )
    return f"""
SELECT d.date, CAST(day(d.date) AS INTEGER) AS jour, CAST(month(d.date) AS INTEGER) AS mois,
       CAST(year(d.date) AS INTEGER) AS an, d.date IN ({PUBLIC}) AS public_holidays, {zones}
FROM ({spine}) d"""


HOURLY = """
SELECT strftime(ts - INTERVAL 23 YEAR, '%Y-%m-%d %H:%M:%S') || ' +0000 UTC' AS dt_iso, value AS temp,
       value - 1 AS feels_like, value - 5 AS temp_min, value + 5 AS temp_max, CAST(1000 + user_id AS DOUBLE) AS pressure,
       CAST(user_id % 100 AS DOUBLE) AS humidity, value / 10 AS wind_speed, CAST(event_id % 101 AS DOUBLE) AS clouds_all
FROM events"""

DAILY = f"""
SELECT CAST(regexp_extract(dt_iso, '(\\d{{4}}-\\d{{2}}-\\d{{2}}) ', 1) AS DATE) AS date,
       round(avg(temp), 9) AS temp, round(avg(feels_like), 9) AS feels_like, round(min(temp_min), 9) AS temp_min,
       round(max(temp_max), 9) AS temp_max, round(avg(pressure), 9) AS pressure, round(avg(humidity), 9) AS humidity,
       round(avg(wind_speed), 9) AS wind_speed, round(avg(clouds_all), 9) AS clouds_all
FROM ({HOURLY}) GROUP BY 1"""

FILES = """
SELECT 'car_' || source || '_' || lang || '_' || CAST(2000 + doc_id % 20 AS VARCHAR) || '.csv' AS name FROM documents"""

DATED_PREDICTIONS = """
SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day, CAST(o_custkey AS VARCHAR) AS com,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS accident,
       CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS jour_ferie, o_totalprice AS temp
FROM orders"""
