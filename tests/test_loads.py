import datetime as dt
import uuid

import pytest

from areaday.fixed import WEATHER
from areaday.functions.dates import reading_time
from areaday.plans.weather import weather_daily
from areaday.session import new_path, shared_dir
from areaday.plans import panel as pan
from areaday.sinks.tables import Audit, load, load_once
from areaday.streaming.ingest import csv_stream, ingest_once, stream_daily, stream_load
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

AUDIT = Audit(dt.datetime(2025, 3, 8, 6, 30), "elt", "task")


@pytest.fixture
def target(spark):
    return f"t_{uuid.uuid4().hex}", new_path(spark, "table")


def test_load_replaces_and_counts(spark, target, rows):
    table, path = target
    assert load(spark.range(5), table, AUDIT, path=path) == (5, "2025-03-08 06:30:00")
    assert load(spark.range(2).withColumnRenamed("id", "other"), table, AUDIT, path=path).rows_inserted == 2
    assert rows(spark.table(table)) == [(i, "2025-03-08 06:30:00", "elt", "task") for i in range(2)]


def test_load_by_partition_keeps_files_open_side_by_side(spark, target, monkeypatch):
    table, path = target
    name, during = "spark.sql.maxConcurrentOutputFileWriters", []
    before, write = spark.conf.get(name), DataFrameWriter.saveAsTable
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", lambda *args: (during.append(spark.conf.get(name)), write(*args)))
    frame = spark.range(300).select("id", (F.col("id") % 11).alias("an"))
    assert load(frame, table, AUDIT, path=path, partition_by=["an"]).rows_inserted == 300
    assert during == ["8"] and spark.conf.get(name) == before
    assert {tuple(r) for r in spark.table(table).select("id", "an").collect()} == {(i, i % 11) for i in range(300)}


def test_load_appends_chosen_columns(spark, target):
    table, path = target
    frame = spark.range(3).selectExpr("id", "id AS x", "id AS y")
    for _ in range(2):
        load(frame, table, AUDIT, mode="append", columns=["y", "id"], path=path)
    assert spark.table(table).columns == ["y", "id", "execution_date", "dag_id", "task_id"]
    assert spark.table(table).count() == 6
    with pytest.raises(ValueError, match="nothing"):
        load(frame, table, AUDIT, mode="append", columns=["nothing"])


def test_a_load_that_is_run_again_changes_nothing(spark, target, rows):
    table, path = target
    frame = spark.range(3).selectExpr("id", "id AS x")
    other = AUDIT._replace(task_id="it's another")
    for audit in (AUDIT, other, AUDIT, other):
        assert load_once(frame, table, audit, columns=["x"], path=path).rows_inserted == 3
    assert rows(spark.table(table), "x", "task_id") == sorted([(i, t) for i in range(3) for t in ("task", "it's another")], key=repr)
    load_once(frame.limit(1), table, AUDIT)  # a repeated load with other rows replaces its own
    load_once(frame.limit(0), table, other)  # and one without rows leaves none
    assert rows(spark.table(table), "x", "task_id") == [(0, "task")]
    load_once(frame, table, AUDIT, load_id="by hand")
    assert spark.table(table).count() == 4
    with pytest.raises(ValueError, match="missing columns"):
        load_once(frame.select("id"), table, AUDIT)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_load_once_refuses_tables_without_load_ids(spark, target):
    table, path = target
    load(spark.range(2), table, AUDIT, path=path)
    with pytest.raises(ValueError, match="load_id"):
        load_once(spark.range(2), table, AUDIT)


def exchanges_above_scan(df, scan):
    """How many exchanges lie between the result and the scan whose line of the plan has ``scan``."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if scan in line)
    depth, found = len(lines[at]) - len(lines[at].lstrip(" :+-")), 0
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            depth, found = indent, found + ("Exchange" in line and "Broadcast" not in line)
    return found


def test_a_bucketed_panel_is_joined_and_grouped_without_a_shuffle(spark, target):
    table, path = target
    days = spark.range(400).selectExpr("int(id % 28 + 1) AS jour", "int(id % 12 + 1) AS mois", "int(2000 + id % 2) AS an", "id AS n")
    spine = days.crossJoin(spark.range(5).selectExpr("'77' AS dep", "string(id) AS com")).drop("n").distinct()
    load(spine, table, AUDIT, path=path, bucket_by=(8, ["dep", "com"]))
    counts = spark.createDataFrame([(1, 1, 2000, "77", "3", 7), (2, 2, 2001, "77", "4", 2)], "jour int, mois int, an int, dep string, com string, nombre_d_accidents bigint")
    joined = pan.join_counts(spark.table(table), counts)
    sums = joined.groupBy("dep", "com", "an").agg(F.sum("nombre_d_accidents").alias("n"))
    assert exchanges_above_scan(sums, "Batched") == 0
    want = {("77", str(c), a): 0 for c in range(5) for a in (2000, 2001)} | {("77", "3", 2000): 7, ("77", "4", 2001): 2}
    assert {(r.dep, r.com, r.an): r.n for r in sums.collect()} == want


class OtherSession:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, master, conf):
        self.conf, self.master, self.folder = conf, master, None
        self.sparkContext = self

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_is_the_configured_one():
    cluster = OtherSession("yarn", {"spark.checkpoint.dir": "hdfs://n/cp/"})
    assert new_path(cluster, "a").startswith("hdfs://n/cp/a-")
    assert cluster.folder == "hdfs://n/cp/"


def test_a_cluster_needs_the_setting():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(OtherSession("yarn", {}))
    assert shared_dir(OtherSession("local[2]", {}))


def land(folder, name, lines, header="id,v"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def test_each_file_is_ingested_once(spark, tmp_path):
    folder, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    run = lambda: ingest_once(csv_stream(spark, str(folder), "id INT, v STRING"), target, checkpoint)
    count = lambda: spark.read.parquet(target).count()
    land(folder, "a.csv", ["1,x", "2,y"])
    run()
    assert count() == 2
    run()
    assert count() == 2
    land(folder, "b.csv", ["3,z"])
    run()
    assert count() == 3


def test_stream_load_adds_batches_and_repeats_none(spark, tmp_path, target, rows):
    folder, (table, path), checkpoint = tmp_path / "in", target, str(tmp_path / "cp")
    run = lambda cp: stream_load(csv_stream(spark, str(folder), "id INT, v STRING"), table, cp, AUDIT, path)
    land(folder, "a.csv", ["1,x"])
    run(checkpoint)
    land(folder, "b.csv", ["2,y"])
    run(checkpoint)
    assert rows(spark.table(table), "id", "batch_id", "dag_id") == [(1, 0, "elt"), (2, 1, "elt")]
    # A batch that failed after its write is run again with its number: it replaces its own rows.
    import shutil

    lost = str(tmp_path / "lost")
    shutil.copytree(checkpoint, lost, ignore=lambda folder, names: [n for n in names if folder.endswith("commits") and n in ("1", ".1.crc")])
    run(lost)
    assert rows(spark.table(table), "id", "batch_id") == [(1, 0), (2, 1)]


def test_loads_with_checkpoints_of_their_own_keep_what_is_there(spark, tmp_path, target, rows):
    table, path = target
    for name in "ab":
        land(tmp_path / name, "x.csv", [f"1,{name}"])
        stream_load(csv_stream(spark, str(tmp_path / name), "id INT, v STRING"), table, str(tmp_path / f"cp{name}"), AUDIT, path)
    assert rows(spark.table(table), "id", "v", "batch_id") == [(1, "a", 0), (1, "b", 0)]
    assert spark.table(table).select("load_id").distinct().count() == 2


def readings(day, hour, x):
    return f"2023-01-{day:02} {hour:02}:00:00 +0000 UTC," + ",".join([str(float(x))] * 8)


READINGS = "dt_iso STRING, " + ", ".join(f"{c} DOUBLE" for c in WEATHER)
READINGS_HEADER = "dt_iso," + ",".join(WEATHER)


def run_daily(spark, folder, target, checkpoint, **options):
    stream = csv_stream(spark, str(folder), READINGS).withColumn("dt", reading_time(F.col("dt_iso")))
    stream_daily(stream, target, checkpoint, **options)


@pytest.mark.parametrize("watermark", [None, "10 days"])
def test_daily_stream_equals_batch_with_late_readings(spark, tmp_path, rows, watermark):
    folder, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    land(folder, "a.csv", [readings(1, 0, 1), readings(1, 23, 3), readings(9, 5, 7), "bad" + "," * 8], READINGS_HEADER)
    run_daily(spark, folder, target, checkpoint, watermark=watermark)
    land(folder, "b.csv", [readings(1, 12, 11), readings(10, 1, 2)], READINGS_HEADER)
    run_daily(spark, folder, target, checkpoint, watermark=watermark)
    hourly = spark.read.option("header", True).schema(READINGS).csv(str(folder))
    want = rows(weather_daily(hourly), "date", *WEATHER)
    assert rows(spark.read.parquet(target), "date", *WEATHER) == want
    assert len(want) == 3


def test_readings_behind_the_watermark_are_not_counted(spark, tmp_path, rows):
    folder, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    for name, lines in (("a", [readings(1, 0, 1), readings(9, 5, 7)]), ("b", [readings(1, 12, 11), readings(9, 6, 8)])):
        land(folder, f"{name}.csv", lines, READINGS_HEADER)
        run_daily(spark, folder, target, checkpoint, watermark="1 day")
    assert rows(spark.read.parquet(target), "date", "readings") == [(dt.date(2023, 1, 1), 1), (dt.date(2023, 1, 9), 2)]


def test_a_backlog_comes_in_batches(spark, tmp_path, target, rows):
    folder, (table, path) = tmp_path / "in", target
    for i in range(4):
        land(folder, f"{i}.csv", [f"{i},x"])
    stream_load(csv_stream(spark, str(folder), "id INT, v STRING", files_per_batch=2), table, str(tmp_path / "cp"), AUDIT, path)
    assert sorted(b for _, b in rows(spark.table(table), "id", "batch_id")) == [0, 0, 1, 1]
