"""Loads into tables of the session's catalogue, with audit columns and row counts.

Any catalogue that Spark is configured with can hold the tables, so a warehouse is reached by its name:
``warehouse.public.accidents``.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from areaday.fixed import AUDIT_TIME_FORMAT
from areaday.schemas import require_columns
from areaday.session import setting

#: Partitions that a task of a load writes side by side. Each open file buffers up to a row group.
FILES_AT_ONCE = 8


class Audit(NamedTuple):
    execution_date: datetime
    dag_id: str
    task_id: str


class LoadResult(NamedTuple):
    rows_inserted: int
    execution_time: str


def with_audit(df: DataFrame, audit: Audit) -> DataFrame:
    time = F.date_format(F.lit(audit.execution_date).cast("timestamp"), AUDIT_TIME_FORMAT)
    return df.withColumns({"execution_date": time, "dag_id": F.lit(audit.dag_id), "task_id": F.lit(audit.task_id)})


def load(
    df: DataFrame,
    table: str,
    audit: Audit,
    mode: str = "overwrite",
    columns: list[str] | None = None,
    path: str | None = None,
    partition_by: list[str] | None = None,
    bucket_by: tuple[int, list[str]] | None = None,
) -> LoadResult:
    """Write ``df`` with audit columns to ``table`` and count its rows in the same pass.

    ``overwrite`` replaces the table with the schema of the data; ``append`` adds to it by column
    name. ``columns`` names the columns to load; ``path`` puts a new table's files there, and ``partition_by`` lays
    them out by columns of few values, such as the year. ``bucket_by`` deals the rows into that many buckets by columns,
    one file each, so that later joins and groupings by them need no shuffle; Spark keeps to the buckets if they are no
    fewer than its shuffle partitions. A task keeps a file open for each of up to ``FILES_AT_ONCE`` partitions, so that it
    need not sort its rows by them; with more partitions Spark sorts the rest.
    """
    loaded = with_audit(require_columns(df, columns).select(*columns) if columns else df, audit)
    if bucket_by:
        loaded = loaded.repartition(bucket_by[0], *bucket_by[1])
    counted = Observation()
    writer = loaded.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], *bucket_by[1])
    at_once = str(FILES_AT_ONCE) if partition_by and not bucket_by else "0"
    with setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", at_once):
        writer.saveAsTable(table)
    return LoadResult(counted.get["rows"], str(audit.execution_date))


def load_once(
    df: DataFrame, table: str, audit: Audit, load_id: str | None = None, columns: list[str] | None = None, path: str | None = None
) -> LoadResult:
    """Add ``df`` with audit columns to ``table`` so that the same load run again changes nothing.

    A load owns the partition of its ``load_id``, by default the run, task and time of the audit, and replaces it: a
    repeated or resumed load leaves the rows of its last run, and other loads are untouched. A table that is there must be
    partitioned by ``load_id``.
    """
    spark = df.sparkSession
    name = "/".join((audit.dag_id, audit.task_id, audit.execution_date.isoformat())) if load_id is None else load_id
    loaded = with_audit(require_columns(df, columns).select(*columns) if columns else df, audit).withColumn("load_id", F.lit(name))
    if not spark.catalog.tableExists(table):
        creator = loaded.limit(0).write.partitionBy("load_id")
        (creator.option("path", path) if path else creator).saveAsTable(table)
    if not any(c.name == "load_id" and c.isPartition for c in spark.catalog.listColumns(table)):
        raise ValueError(f"{table} is not partitioned by load_id")
    counted = Observation()
    ordered = require_columns(loaded, spark.table(table).columns).select(*spark.table(table).columns)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        ordered.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").insertInto(table)
    if counted.get["rows"] == 0:  # a load without rows writes no partition, so an earlier run's would stay
        quoted = name.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (load_id = '{quoted}')")
    return LoadResult(counted.get["rows"], str(audit.execution_date))
