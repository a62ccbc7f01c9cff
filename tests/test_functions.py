import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from areaday.functions import dates, text


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("value", ["", "1", "12", "123", "0"])
def test_zero_pad_never_cuts(spark, value):
    assert one(spark, text.zero_pad, value) == value.zfill(2)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\xa0ab 　é", max_size=8), min_size=1, max_size=20))
def test_strip_is_that_of_python(spark, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = [r.y for r in frame.select("i", text.strip(F.col("x")).alias("y")).orderBy("i").collect()]
    assert got == [v.strip() for v in values]


@pytest.mark.parametrize(
    "name, year",
    [
        ("carcteristiques-2022.csv", "2022"),
        ("caract-2023.csv", "2023"),
        ("car-2021-2022.csv", "2022"),
        ("car20101.csv", "0101"),
        ("lieux-2022.csv", None),
        ("car.csv", None),
        (None, None),
    ],
)
def test_year_in_name_is_the_last_run_of_four_digits(spark, name, year):
    assert one(spark, lambda c: text.first_match(c, r"car.*(\d{4})"), name) == year


def test_snake_suffix_and_base_name(spark):
    assert one(spark, text.snake, "Zone A B") == "zone_a_b"
    assert one(spark, lambda c: text.with_suffix(c, ".csv"), "a") == "a.csv"
    assert one(spark, lambda c: text.with_suffix(c, ".csv"), "a.csv") == "a.csv"
    assert one(spark, text.base_name, "x/y/z.csv") == "z.csv"


def test_reading_time(spark):
    assert one(spark, dates.reading_time, "2022-01-01 05:00:00 +0000 UTC") == dt.datetime(2022, 1, 1, 5)
    assert one(spark, dates.reading_time, "no time") is None


def test_instants_with_and_without_offset(spark):
    assert one(spark, dates.utc_instant, "2023-02-18T00:00:00+01:00") == dt.datetime(2023, 2, 17, 23)
    assert one(spark, dates.utc_instant, "2023-02-18") == dt.datetime(2023, 2, 18)


def test_first_midnight(spark):
    assert one(spark, dates.first_midnight, dt.datetime(2023, 2, 18), "timestamp") == dt.date(2023, 2, 18)
    assert one(spark, dates.first_midnight, dt.datetime(2023, 2, 17, 23), "timestamp") == dt.date(2023, 2, 18)
    assert one(spark, dates.first_midnight, dt.datetime(2023, 2, 18, 0, 0, 1), "timestamp") == dt.date(2023, 2, 19)


def test_date_of_parts_raises_or_is_null(spark):
    parts = spark.createDataFrame([(2023, 2, 30)], "y int, m int, d int")
    columns = [F.col(c) for c in "ymd"]
    with pytest.raises(Exception, match="(?i)date"):
        parts.select(dates.date_of_parts(*columns)).collect()
    assert parts.select(dates.date_of_parts_or_null(*columns)).first()[0] is None


def test_french_date_and_days_between(spark):
    assert one(spark, dates.french_date, "14/07/2023") == dt.date(2023, 7, 14)
    frame = spark.createDataFrame([(dt.date(2023, 1, 2), dt.date(2023, 1, 1))], "a date, b date")
    up, down = frame.select(dates.days_between(F.col("b"), F.col("a")), dates.days_between(F.col("a"), F.col("b"))).first()
    assert up == [dt.date(2023, 1, 1), dt.date(2023, 1, 2)]
    assert down == []


def test_weekend_is_saturday_and_sunday(spark):
    frame = spark.createDataFrame([(dt.date(2025, 3, 8) + dt.timedelta(i),) for i in range(7)], "date date")
    features = frame.withColumns(dates.calendar_features(F.col("date"))).orderBy("date").collect()
    assert [r.weekday for r in features] == [5, 6, 0, 1, 2, 3, 4]
    assert [r.weekend for r in features] == [1, 1, 0, 0, 0, 0, 0]


def test_years_around():
    assert dates.years_around(2025, (-20, 5)) == (2005, 2030)
