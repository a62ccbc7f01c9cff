"""Trained models over the given tables. Fitted trees have no SQL form; their inputs do."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaday.fixed import COUNT, ROWS_FOR_TRAINING, WEATHER
from areaday.functions.dates import calendar_parts
from areaday.ml import features, training
from areaday.operators.aggregates import year_bounds
from areaday.operators.ranking import latest_rows
from areaday.plans.calendar import calendar
from areaday.plans.counts import accident_counts
from areaday.plans.panel import with_weather
from areaday.plans.weather import weather_daily
from areaday.registered import given
from areaday.session import new_path
from areaday.sinks.tables import Audit, load

FLAGS = ["public_holidays", "zone_a", "zone_b", "zone_c"]
COMPONENTS = 64


def one_hot(spark, sf):
    """The vector place and length that each order's priority gets."""
    orders = given.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    fitted = Pipeline(stages=features.preprocessing(orders, [], ["o_orderpriority"])).fit(orders)
    vector = vector_to_array("features")
    return fitted.transform(orders).select(
        "o_orderkey",
        (F.array_position(vector, 1.0) - 1).cast("int").alias("place"),
        F.size(vector).alias("length"),
    )


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    parts = [F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(COMPONENTS)]
    return given.table(spark, sf, "embeddings").select("vec_id", "label", *parts)


def rf_score(spark, sf):
    """A forest trained on all vectors, saved, loaded again, and applied to all of them."""
    rows = vectors(spark, sf)
    trained = training.train_forest(rows, "vec_id", "label", weighted=True)
    path = training.save_model(trained, new_path(spark, "forest"), spark)
    model, signature = training.load_model(path, spark)
    return training.score(model, rows.drop("vec_id", "label"), signature.fieldNames(), "predicted")


STATUS_CLASS = {"F": 0, "O": 70, "P": 700}


def forest_known(spark, sf):
    """A forest that learns the class of each order from its status, saved, loaded again, and applied to all orders."""
    classes = F.create_map(*[F.lit(x) for pair in STATUS_CLASS.items() for x in pair])
    rows = given.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", classes[F.col("o_orderstatus")].alias("class"))
    trained = training.train_forest(rows, "o_orderkey", "class", weighted=True)
    model, signature = training.load_model(training.save_model(trained, new_path(spark, "forest"), spark), spark)
    return training.score(model, rows.drop("o_orderkey", "class"), signature.fieldNames(), "predicted")


def boosted_known(spark: SparkSession, sf: str) -> training.Trained:
    rows = given.table(spark, sf, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("rank"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("accident"),
    )
    return training.train_boosted(rows, "o_orderkey", rounds=3)


def boosted_held_out(spark, sf):
    """The held-out orders with the class that boosted trees find from the rank of their priority."""
    return boosted_known(spark, sf).predictions.select("o_orderkey", "accident", "prediction")


def boosted_metrics(spark, sf):
    return training.metric_rows(boosted_known(spark, sf).scores, "boosted_known")


def train_from_table_test_rows(spark, sf):
    """The rows that training from a loaded table keeps for its test, out of the latest ones."""
    table = f"areaday_train_{uuid.uuid4().hex}"
    load(accident_counts(given.accidents(spark, sf)), table, Audit(datetime(2025, 3, 8), "elt", "load"), path=new_path(spark, "table"))
    return training.train_from_table(spark, table).predictions.select("row_key", COUNT)


def daily_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Accidents per day with the day's weather, as text-keyed rows to train on."""
    counts = accident_counts(given.accidents(spark, sf))
    per_day = counts.groupBy("jour", "mois", "an").agg(F.sum(COUNT).cast("int").alias(COUNT))
    return with_weather(per_day, weather_daily(given.weather_hourly(spark, sf)))


def forest_latest_days(spark, sf):
    """Scores of a forest trained on the 100 latest days, as one row per metric."""
    latest = latest_rows(daily_totals(spark, sf), ROWS_FOR_TRAINING)
    keyed = latest.withColumn("day_key", F.date_format("date", "yyyy-MM-dd"))
    trained = training.train_forest(keyed, "day_key", weighted=True)
    return training.metric_rows(trained.scores, "forest_latest_days")


def rows_to_boost(spark: SparkSession, sf: str) -> DataFrame:
    """Every order with its day's flags and weather; its count is 1 if it is urgent."""
    day = F.to_date("o_orderdate")
    orders = given.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("com"),
        "o_totalprice",
        day.alias("date"),
        *[c.alias(n) for n, c in calendar_parts(day).items()],
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias(COUNT),
    )
    days = calendar(year_bounds(orders), given.public_holidays(spark, sf), given.school_holidays(spark, sf))
    weather = weather_daily(given.weather_hourly(spark, sf))
    dated = days.select("date", *FLAGS).join(weather, "date", "left")
    return orders.join(F.broadcast(dated), "date").select(*orders.columns, *FLAGS, *WEATHER)


def boosting_features(spark, sf):
    numbered, _ = training.imbalanced_features(rows_to_boost(spark, sf), FLAGS, "o_orderkey")
    return given.rounded(numbered)


def gbt_threshold_score(spark, sf):
    """The held-out orders with probability and class from boosted trees."""
    numbered, _ = training.imbalanced_features(rows_to_boost(spark, sf), FLAGS, "o_orderkey")
    return training.train_boosted(numbered, "o_orderkey").predictions


def imbalanced_known(spark: SparkSession, sf: str) -> training.Trained:
    """The whole imbalanced training where the label is known: an order counts as an accident on Saturdays and Sundays."""
    planted = rows_to_boost(spark, sf).withColumn(COUNT, (F.weekday("date") >= 5).cast("int"))
    numbered, _ = training.imbalanced_features(planted, FLAGS, "o_orderkey")
    return training.train_boosted(numbered, "o_orderkey")


def imbalanced_held_out(spark, sf):
    """The held-out orders with the class that probability and threshold give, and on which side of a half each lies."""
    likelier = (F.col("probability") > 0.5).cast("int").alias("likelier")
    return imbalanced_known(spark, sf).predictions.select("o_orderkey", "accident", "prediction", likelier)


def imbalanced_confusion(spark, sf):
    return training.confusion(imbalanced_known(spark, sf), "accident")


IMBALANCED = """
    SELECT o_orderkey, CAST(isodow(CAST(o_orderdate AS DATE)) >= 6 AS INTEGER) AS accident FROM orders QUALIFY
    row_number() OVER (PARTITION BY isodow(CAST(o_orderdate AS DATE)) >= 6 ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '42'), o_orderkey)
    <= ceil(0.2 * count(*) OVER (PARTITION BY isodow(CAST(o_orderdate AS DATE)) >= 6))"""

QUERIES = {
    "imbalanced_held_out": (imbalanced_held_out, f"SELECT *, accident AS prediction, accident AS likelier FROM ({IMBALANCED})"),
    "imbalanced_confusion": (
        imbalanced_confusion,
        f"""SELECT CAST(t AS DOUBLE) AS truth, CAST(p AS DOUBLE) AS predicted, count(accident) FILTER (accident = t AND t = p) AS n
            FROM ({IMBALANCED}) CROSS JOIN (SELECT unnest([0, 1]) AS t) CROSS JOIN (SELECT unnest([0, 1]) AS p) GROUP BY t, p""",
    ),
    "one_hot": (
        one_hot,
        """WITH p AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS place
                      FROM orders GROUP BY 1)
           SELECT o_orderkey, CAST(place AS INTEGER) AS place, CAST((SELECT count(*) FROM p) AS INTEGER) AS length
           FROM orders JOIN p USING (o_orderpriority)""",
    ),
    "boosting_features": (
        boosting_features,
        f"""WITH cal AS ({given.calendar_sql(given.SPINE)}), w AS ({given.DAILY}),
                 ids AS (SELECT o_custkey, row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS id
                         FROM orders GROUP BY 1)
            SELECT o_orderkey, id AS com, round(o_totalprice, 9) AS o_totalprice,
                   CAST(public_holidays AS INTEGER) AS public_holidays, CAST(zone_a AS INTEGER) AS zone_a,
                   CAST(zone_b AS INTEGER) AS zone_b, CAST(zone_c AS INTEGER) AS zone_c, w.* EXCLUDE (date),
                   CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS accident, cal.an AS year, cal.mois AS month,
                   cal.jour AS day, CAST(isodow(cal.date) - 1 AS INTEGER) AS weekday,
                   CAST(isodow(cal.date) >= 6 AS INTEGER) AS weekend
            FROM orders JOIN ids USING (o_custkey) JOIN cal ON cal.date = CAST(o_orderdate AS DATE)
            LEFT JOIN w ON w.date = cal.date""",
    ),
    "forest_known": (
        forest_known,
        "SELECT o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 70 ELSE 700 END AS predicted FROM orders",
    ),
    "boosted_held_out": (
        boosted_held_out,
        """WITH r AS (SELECT o_orderkey, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS accident FROM orders)
           SELECT *, accident AS prediction FROM r QUALIFY
           row_number() OVER (PARTITION BY accident ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '42'), o_orderkey)
           <= ceil(0.2 * count(*) OVER (PARTITION BY accident))""",
    ),
    "boosted_metrics": (
        boosted_metrics,
        """SELECT 'boosted_known' AS run_id, metric, CAST(1 AS DOUBLE) AS value
           FROM (SELECT unnest(['accuracy', 'f1']) AS metric)""",
    ),
    "train_from_table_test_rows": (
        train_from_table_test_rows,
        f"""WITH l AS (SELECT * FROM ({given.COUNTS}) ORDER BY an DESC, mois DESC, jour DESC, dep, com LIMIT 100),
                 k AS (SELECT concat_ws('-', dep, com, an, mois, jour) AS row_key,
                              CAST(nombre_d_accidents AS DOUBLE) AS nombre_d_accidents FROM l)
            SELECT * FROM k QUALIFY
            row_number() OVER (PARTITION BY nombre_d_accidents ORDER BY md5(row_key || '42'), row_key)
            <= ceil(0.2 * count(*) OVER (PARTITION BY nombre_d_accidents))""",
    ),
    "rf_score": (rf_score, None),
    "forest_latest_days": (forest_latest_days, None),
    "gbt_threshold_score": (gbt_threshold_score, None),
}
