"""Incremental loads: what arrived since the last run, then stop.

Checkpoints and outputs belong in a folder that survives executors and drivers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from areaday.plans.weather import daily_measures
from areaday.sinks.tables import Audit, with_audit
from areaday.sources.files import CSV_DIALECT


def csv_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    sep: str = ",",
    files_per_batch: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """The files of a folder as a stream; with ``files_per_batch`` a large backlog comes in several batches."""
    options = {**CSV_DIALECT, "sep": sep, "multiLine": multi_line, "enforceSchema": False}
    reader = spark.readStream.schema(schema).options(**options)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).csv(folder)


def ingest_once(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of files not read before to the Parquet dataset ``out``."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start(out)
    query.awaitTermination()
    return query


def load_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream and keeps in its checkpoint: another checkpoint has another one."""
    return spark.read.schema("id STRING").json(f"{checkpoint}/metadata").first().id


def stream_load(stream: DataFrame, table: str, checkpoint: str, audit: Audit, path: str | None = None) -> StreamingQuery:
    """Append new rows to ``table`` with audit columns, the id of the load and their batch number.

    Each batch owns the partition of its load and number and overwrites it, so a repeated batch adds nothing, and
    loads with checkpoints of their own leave each other alone. ``path`` is where a new table's files go.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = {"load_id": F.lit(load_id(spark, checkpoint)), "batch_id": F.lit(batch_id)}
        numbered = with_audit(batch, audit).withColumns(marks)
        if not spark.catalog.tableExists(table):
            creator = numbered.limit(0).write.partitionBy(*marks)
            (creator.option("path", path) if path else creator).saveAsTable(table)
        # The session of the batch is the stream's own: only the partitions of the batch are overwritten.
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        numbered.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)

    query = _run(stream, write, checkpoint)
    if stream.sparkSession.catalog.tableExists(table):
        stream.sparkSession.catalog.refreshTable(table)
    return query


def stream_daily(hourly: DataFrame, out: str, checkpoint: str, watermark: str | None = None) -> StreamingQuery:
    """Daily weather kept up to date from a stream of readings with an instant ``dt``.

    Whenever readings of a day arrive, its row is written again. The state is one row per day, so by
    default it is kept and a reading counts however late it comes. With a watermark, days further
    behind the newest reading are forgotten, and readings for them are not counted any more.
    """
    readings = hourly.withWatermark("dt", watermark) if watermark else hourly
    daily = (
        readings.filter(F.col("dt").isNotNull())
        .groupBy(F.window("dt", "1 day"))
        .agg(*daily_measures(), F.count(F.lit(1)).alias("readings"))
        .select(F.to_date("window.start").alias("date"), "*")
        .drop("window")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("date").parquet(out)

    return _run(daily, write, checkpoint)


def _run(df: DataFrame, write, checkpoint: str) -> StreamingQuery:
    writer = df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
