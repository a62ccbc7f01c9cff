"""Incremental loads over the given tables."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaday.fixed import WEATHER
from areaday.functions.dates import reading_time
from areaday.registered import given
from areaday.session import new_path
from areaday.sinks.files import write_csv
from areaday.sinks.tables import Audit
from areaday.streaming.ingest import csv_stream, ingest_once, stream_daily, stream_load

AUDIT = Audit(datetime(2025, 3, 8, 6, 30), "elt", "stream_accidents")
EVENTS = "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def stream_ingest_once(spark, sf):
    """Purchases arrive after the other events; a run between them finds nothing new."""
    landing, out, checkpoint = (new_path(spark, name) for name in ("landing", "ingested", "checkpoint"))
    events = given.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("string"))
    write_csv(events.filter(F.col("event_type") != "purchase"), landing, mode="append")
    ingest_once(csv_stream(spark, landing, EVENTS), out, checkpoint)
    ingest_once(csv_stream(spark, landing, EVENTS), out, checkpoint)
    write_csv(events.filter(F.col("event_type") == "purchase"), landing, mode="append")
    ingest_once(csv_stream(spark, landing, EVENTS), out, checkpoint)
    return spark.read.parquet(out)


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a stream; written as a pattern, the path may be one file or a folder of them."""
    return spark.readStream.schema(given.SCHEMAS["events"]).parquet(f"{sf}/event[s].parquet")


def stream_append_audit(spark, sf):
    """Two sources with checkpoints of their own go into one table, and each is run again without new rows."""
    table, path = f"areaday_stream_{uuid.uuid4().hex}", new_path(spark, "loaded")
    events = event_stream(spark, sf).select("event_id", "user_id", "event_type", "props")
    sources = [events.filter("event_type = 'purchase'"), events]
    for stream in sources:
        checkpoint = new_path(spark, "checkpoint")
        for _ in range(2):
            stream_load(stream, table, checkpoint, AUDIT, path)
    return spark.table(table).drop("load_id")


def stream_daily_window(spark, sf):
    """Readings land as text in two parts, as for the batch form, and arrive through two runs."""
    landing, out, checkpoint = (new_path(spark, name) for name in ("readings", "daily", "checkpoint"))
    hourly = given.weather_hourly(spark, sf)
    schema = "dt_iso STRING, " + ", ".join(f"{c} DOUBLE" for c in WEATHER)
    for part in (F.col("temp") < 20, F.col("temp") >= 20):
        write_csv(hourly.filter(part), landing, mode="append")
        readings = csv_stream(spark, landing, schema).withColumn("dt", reading_time(F.col("dt_iso")))
        stream_daily(readings, out, checkpoint)
    return given.rounded(spark.read.parquet(out))


QUERIES = {
    "stream_ingest_once": (stream_ingest_once, "SELECT * REPLACE (CAST(ts AS VARCHAR) AS ts) FROM events"),
    "stream_append_audit": (
        stream_append_audit,
        """SELECT event_id, user_id, event_type, props, '2025-03-08 06:30:00' AS execution_date, 'elt' AS dag_id,
                  'stream_accidents' AS task_id, 0 AS batch_id
           FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'purchase')""",
    ),
    "stream_daily_window": (
        stream_daily_window,
        f"""SELECT d.*, n.readings FROM ({given.DAILY}) d JOIN (
              SELECT CAST(substr(dt_iso, 1, 10) AS DATE) AS date, count(*) AS readings FROM ({given.HOURLY}) GROUP BY 1) n
            USING (date)""",
    ),
}
