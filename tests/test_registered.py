import pytest

import check
from __spark_entry__ import entry, queries
from areaday.registered import all_queries

SQL = {name: sql for name, (_, sql) in all_queries().items() if sql is not None}
NO_SQL = {"rf_score", "forest_latest_days", "gbt_threshold_score"}


@pytest.fixture(scope="module")
def con(sf):
    return check.duck(sf)


def test_all_but_fitted_models_have_sql():
    assert set(all_queries()) - set(SQL) == NO_SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf, con, name):
    assert check.compare(queries()[name](spark, sf), con, SQL[name]) == []


def test_entry_has_a_row_per_customer_and_day(spark):
    assert entry(spark).count() == 150 * 2557


def test_stream_takes_a_folder_of_files_as_well(spark, sf, tmp_path):
    from areaday.registered import given

    given.table(spark, sf, "events").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    events = given.table(spark, sf, "events")
    loaded = queries()["stream_append_audit"](spark, str(tmp_path))
    assert loaded.count() == events.count() + events.filter("event_type = 'purchase'").count()


def test_landed_documents_stay_small(spark):
    """More rows make more documents, not larger ones."""
    from pyspark.sql import functions as F

    from areaday.registered import files

    rows = spark.range(40_000)
    path = files.landed_documents(rows, F.struct("id"), "records", "small")
    found = spark.read.schema("records array<struct<id: long>>").json(path, multiLine=True)
    sizes = [r.n for r in found.select(F.size("records").alias("n")).collect()]
    assert sum(sizes) == 40_000 and len(sizes) == 40 and max(sizes) < 1300
