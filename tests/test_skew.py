"""A hot key that holds a third of the rows, with sides too large to broadcast."""

import pytest
from pyspark.sql import functions as F

from areaday.operators import joins
from areaday.session import materialise

SMALL_SCALE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "32",
}
ROWS, KEYS = 400_000, 20_000


@pytest.fixture
def large_sides(spark):
    """Sizes at which a test's tables count as too large to broadcast, and a hot partition as hot."""
    before = {k: spark.conf.get(k, None) for k in SMALL_SCALE}
    for key, value in SMALL_SCALE.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hot(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % KEYS).cast("string"))
    return spark.range(0, ROWS, 1, 16).select(key.alias("com"), "id")


@pytest.fixture
def keys(spark):
    return spark.range(KEYS).select(F.col("id").cast("string").alias("com")).union(spark.createDataFrame([("hot",)], "com string"))


def run(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_lookup_splits_the_hot_partition(large_sides, hot, keys):
    mapping = keys.withColumn("id", F.when(F.col("com") == "hot", -1).otherwise(F.col("com").cast("int")))
    mapping = materialise(mapping)
    rows, plan = run(joins.lookup(hot.withColumn("n", F.col("id")), mapping, "com", "com", "id"))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == ROWS
    assert all(r.com == (-1 if r.n % 3 == 0 else r.n % KEYS) for r in rows)


def test_membership_flag_splits_the_hot_partition(large_sides, hot, keys):
    members = keys.filter((F.col("com") == "hot") | F.col("com").endswith("2"))
    rows, plan = run(joins.membership_flag(hot, members, "com", "flag"))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == ROWS
    assert all(r.flag == (r.com == "hot" or r.com.endswith("2")) for r in rows)


def test_null_safe_join_splits_the_hot_partition(large_sides, hot, keys):
    some_null = hot.withColumn("com", F.when(F.col("com") != "hot", F.col("com")))
    right = keys.withColumn("com", F.when(F.col("com") != "hot", F.col("com"))).withColumn("v", F.lit(1))
    rows, plan = run(joins.left_join(some_null, right, ["com"]))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == ROWS and all(r.v == 1 for r in rows)
