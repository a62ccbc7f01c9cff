"""Order-dependent steps: top rows, running numbers, splits and samples.

None of them sorts a whole table, or a whole class of it, in one task.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areaday.fixed import SEED, TEST_SHARE
from areaday.session import materialise, wide_partitions


def latest_rows(df: DataFrame, n: int, ties: list[str] | None = None) -> DataFrame:
    """The ``n`` last rows by year, month and day, nulls first; ``ties`` orders rows of one day."""
    newest = [F.col(c).desc_nulls_first() for c in ("an", "mois", "jour")]
    return df.orderBy(*newest, *(ties or [])).limit(n)


def latest_rows_by_year(df: DataFrame, n: int, ties: list[str] | None = None) -> DataFrame:
    """The same as ``latest_rows``, out of only as many of the newest years as hold ``n`` rows.

    Of a table that is partitioned by year the other years are not read; counting rows per year reads no column.
    """
    found, years = 0, []
    for row in df.groupBy("an").count().orderBy(F.desc_nulls_first("an")).collect():
        if found >= n:
            break
        found += row["count"]
        years.append(row["an"])
    known = [year for year in years if year is not None]
    newest = F.col("an").isin(known)
    return latest_rows(df.filter(newest | F.col("an").isNull() if None in years else newest), n, ties)


def first_rows(df: DataFrame, order: list[str], n: int = 1) -> DataFrame:
    return df.orderBy(*order).limit(n)


def hash_of(key: Column, seed: int = SEED) -> Column:
    """A value per key that orders rows as if at random, the same way in every run."""
    return F.md5(F.concat(key.cast("string"), F.lit(str(seed))))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """``n`` rows chosen by the hash of their key: repeatable however the rows are partitioned."""
    return df.orderBy(hash_of(F.col(key), seed), key).limit(n)


def running_index(df: DataFrame, order: str, name: str) -> DataFrame:
    """Number the rows from 0 by the numeric column ``order``, which must be unique and not null.

    Quantiles cut the order into ranges of about equal size; each range is numbered by its own task
    and shifted by the rows of the ranges before it. There are as many ranges as partitions, so the
    table of shifts is small whatever the data.
    """
    kept = materialise(df)
    n = max(2, wide_partitions(df.sparkSession))
    cuts = sorted(set(kept.approxQuantile(order, [i / n for i in range(1, n)], 0.5 / n))) or [0.0]
    ranged = Bucketizer(
        splits=[float("-inf"), *cuts, float("inf")], inputCol="_order", outputCol="_range"
    ).transform(kept.withColumn("_order", F.col(order).cast("double")))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    )
    in_range = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return (
        ranged.withColumn("_place", in_range)
        .join(F.broadcast(shifts), "_range")
        .select(*df.columns, (F.col("_place") + F.col("_shift")).cast("bigint").alias(name))
    )


def first_seen_index(df: DataFrame, category: str, order: str) -> DataFrame:
    """Each category with its place in the order of first appearance, from 0."""
    firsts = df.groupBy(category).agg(F.min(order).alias("_first"))
    return running_index(firsts, "_first", "id").select(category, "id")


def stratified_split(
    df: DataFrame, label: str, key: str, share: float = TEST_SHARE, seed: int = SEED, flag: str = "is_test"
) -> DataFrame:
    """Add a flag that puts ``ceil(share * rows)`` rows of each class into the test part.

    ``key`` must be unique.
    A class takes its rows with the smallest hashes. The hash of the last row it takes is found from counts per hash
    prefix, in two levels of four digits, and only rows with that one prefix, one in 2^32, are ranked; then each row
    compares its own hash with its class's limit. The rows themselves are not shuffled, and a class that holds most of
    the table costs no more than another.
    """
    hashed = df.select(F.col(label).alias("_label"), F.col(key).alias("_key")).withColumn(
        "_hash", hash_of(F.col("_key"), seed)
    )
    sizes = hashed.groupBy("_label").agg(F.count(F.lit(1)).alias("_size"))
    quotas = sizes.select("_label", F.ceil(F.col("_size") * F.lit(share)).alias("_quota"))
    for digits in (4, 8):
        hashed, quotas = _edge(hashed, quotas, F.substring("_hash", 1, digits))
    rank = F.row_number().over(Window.partitionBy("_label").orderBy("_hash", "_key"))
    ranked = hashed.withColumn("_rank", rank).join(
        quotas.select(F.col("_label").alias("_of"), "_quota"), F.col("_label").eqNullSafe(F.col("_of"))
    )
    limits = ranked.filter(F.col("_rank") == F.col("_quota")).select(
        F.col("_label").alias("_limit_label"), F.struct("_hash", "_key").alias("_limit")
    )
    own = F.struct(hash_of(F.col(key), seed).alias("_hash"), F.col(key).alias("_key"))
    return (
        df.join(materialise(limits), F.col(label).eqNullSafe(F.col("_limit_label")), "left")
        .withColumn(flag, F.coalesce(own <= F.col("_limit"), F.lit(False)))
        .select(*df.columns, flag)
    )


def _edge(hashed: DataFrame, quotas: DataFrame, prefix: Column) -> tuple[DataFrame, DataFrame]:
    """Of each class the rows with the prefix in which its quota of smallest hashes ends, and how many of them it takes."""
    counts = hashed.groupBy("_label", prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_rows"))
    upto = F.sum("_rows").over(Window.partitionBy("_label").orderBy("_prefix"))
    asked = quotas.select(F.col("_label").alias("_of"), "_quota")
    edges = (
        counts.withColumn("_upto", upto)
        .join(asked, F.col("_label").eqNullSafe(F.col("_of")))
        .filter((F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_rows") < F.col("_quota")))
    )
    edges = materialise(
        edges.select("_label", "_prefix", (F.col("_quota") - F.col("_upto") + F.col("_rows")).alias("_quota"))
    )
    chosen = edges.select(F.col("_label").alias("_of"), "_prefix")
    on_edge = hashed.join(chosen, F.col("_label").eqNullSafe(F.col("_of")) & (prefix == F.col("_prefix")))
    return on_edge.select(*hashed.columns), edges.select("_label", "_quota")
