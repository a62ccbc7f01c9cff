"""Grouped and global aggregates. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaday.fixed import YEARS


def count_by(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows per group; rows with a null key are left out."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    return count_by(df, [column], "count").orderBy(F.desc("count"), column)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: how many nulls it has. One pass over the data."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column", "nulls")


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type and how many values it has. One pass over the data."""
    counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return counted.unpivot([], df.columns, "column", "non_null").select(
        "column", types[F.col("column")].alias("type"), "non_null"
    )


def distinct_per_group(df: DataFrame, key: str, value: str) -> DataFrame:
    """The sorted distinct values of each group. For values from a small set, such as days of a month."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias(value))


def last_wins(df: DataFrame, key: str, value: str, order: Column) -> DataFrame:
    """One row per key, with the value that comes last by ``order``."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def bounding_box(df: DataFrame, x: Column, y: Column) -> DataFrame:
    """Extent and centre of points given as arrays of x and y, one pair of arrays per row."""
    box = df.select(x.alias("x"), y.alias("y")).agg(
        F.min(F.array_min("x")).alias("min_x"),
        F.min(F.array_min("y")).alias("min_y"),
        F.max(F.array_max("x")).alias("max_x"),
        F.max(F.array_max("y")).alias("max_y"),
    )
    return box.withColumns(
        {
            "centre_x": (F.col("min_x") + F.col("max_x")) / 2,
            "centre_y": (F.col("min_y") + F.col("max_y")) / 2,
        }
    )


def year_bounds(df: DataFrame, year: str = "an", allowed: tuple[int, int] = YEARS) -> DataFrame:
    """One row: 1 January of the first year to 31 December of the last, as ``lo`` and ``hi``.

    A year outside ``allowed`` raises an error, so no table of days grows beyond those years.
    """
    ends = df.agg(F.min(year).alias("first"), F.max(year).alias("last"))
    outside = (F.col("first") < allowed[0]) | (F.col("last") > allowed[1])
    found = F.concat_ws(" to ", "first", "last")
    wrong = F.raise_error(F.concat(F.lit(f"years outside {allowed[0]} to {allowed[1]}: "), found)).cast("int")
    return ends.select(F.when(outside, wrong).otherwise(F.col("first")).alias("first"), "last").select(
        F.make_date("first", F.lit(1), F.lit(1)).alias("lo"), F.make_date("last", F.lit(12), F.lit(31)).alias("hi")
    )
