"""Joins.

No side carries a hint. Spark knows the size of files and broadcasts them below its threshold; a derived side is written
out first (``materialise``), so that its size is known as well. Larger sides are shuffled, and the adaptive skew join
splits hot partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaday.session import materialise


def left_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """All rows of ``left`` with the matching ones of ``right``; null keys match null keys."""
    keys = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in on]
    added = [f"r.{c}" for c in right.columns if c not in on]
    return left.alias("l").join(right.alias("r"), keys, "left").select("l.*", *added)


def lookup(df: DataFrame, mapping: DataFrame, key: str, mapping_key: str, value: str) -> DataFrame:
    """Replace ``key`` by the value the mapping has for it, null where it has none."""
    pairs = mapping.select(F.col(mapping_key).alias(key), F.col(value).alias("_value"))
    return df.join(pairs, key, "left").withColumn(key, F.col("_value")).drop("_value").select(*df.columns)


def membership_flag(df: DataFrame, members: DataFrame, key: str, flag: str) -> DataFrame:
    """Add a boolean: does ``key`` occur in the one column of ``members``?"""
    known = materialise(members.toDF(key).filter(F.col(key).isNotNull()).distinct())
    marked = known.withColumn(flag, F.lit(True))
    return df.join(marked, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False))).select(*df.columns, flag)


def not_in_store(candidates: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Candidates whose ``key`` the store does not have yet."""
    return candidates.join(stored.select(key), key, "left_anti")
