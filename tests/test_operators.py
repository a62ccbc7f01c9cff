import datetime as dt
import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from areaday import schemas
from areaday.operators import aggregates, evaluation, joins, ranking
from areaday.operators.intervals import flag_days
from areaday.session import materialise

D = dt.date


def test_count_by_leaves_out_null_keys(spark, rows):
    frame = spark.createDataFrame([("1", "a"), ("1", "a"), (None, "a"), ("2", None)], "k string, l string")
    assert rows(aggregates.count_by(frame, ["k", "l"], "n")) == [("1", "a", 2)]


def test_left_join_matches_nulls_and_keeps_all(spark, rows):
    left = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    right = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    assert rows(joins.left_join(left, right, ["k"])) == [(1, "a"), (3, None), (None, "b")]


def test_membership_flag_with_nulls_and_repeats(spark, rows):
    frame = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k string")
    members = spark.createDataFrame([("a",), ("a",), (None,)], "m string")
    assert rows(joins.membership_flag(frame, members, "k", "f")) == [
        ("a", True), ("a", True), ("b", False), (None, False),
    ]


def test_lookup_keeps_columns_and_gives_null_for_unknown(spark, rows):
    frame = spark.createDataFrame([("a", 1), ("x", 2)], "com string, n int")
    mapping = spark.createDataFrame([("a", 0)], "commune string, id int")
    got = joins.lookup(frame, mapping, "com", "commune", "id")
    assert got.columns == ["com", "n"]
    assert rows(got) == [(0, 1), (None, 2)]


def test_a_written_side_is_broadcast_by_its_size(spark):
    plan = lambda df: spark.range(100).join(df, "id")._jdf.queryExecution().executedPlan().toString()
    kept = materialise(spark.range(10))
    assert "BroadcastHashJoin" in plan(kept)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "BroadcastHashJoin" not in plan(kept)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_years_outside_the_allowed_ones_raise(spark):
    frame = spark.createDataFrame([(2023,), (9999,)], "an int")
    with pytest.raises(Exception, match="years outside 1900 to 2100: 2023 to 9999"):
        aggregates.year_bounds(frame).collect()
    assert aggregates.year_bounds(frame, allowed=(1, 9999)).first().hi == dt.date(9999, 12, 31)


def brute_flags(days, ranges, keys):
    midnight = lambda d: dt.datetime.combine(d, dt.time())
    return [
        (d, *[any(s <= midnight(d) <= e and z is not None and k in z for z, s, e in ranges) for k in keys]) for d in days
    ]


def test_flag_days_equals_the_definition(spark):
    rng = random.Random(7)
    start = dt.datetime(2023, 1, 1)
    ranges = []
    for _ in range(60):
        first = start + dt.timedelta(hours=rng.randrange(-24 * 40, 24 * 120), minutes=rng.choice([0, 0, 1]))
        length = dt.timedelta(hours=rng.choice([0, 1, 23, 24, 25, 100, -30]))
        ranges.append((rng.choice(["zone_a", "zone_b", "zone_a - zone_c", None]), first, first + length))
    days = [D(2023, 1, 1) + dt.timedelta(i) for i in range(90)]
    frame = spark.createDataFrame(ranges, "zone string, start_date timestamp, end_date timestamp")
    spine = spark.createDataFrame([(d,) for d in days], "date date")
    bounds = spark.createDataFrame([(days[0], days[-1])], "lo date, hi date")
    keys = ["zone_a", "zone_b", "zone_c"]
    got = flag_days(spine, frame, {k: F.col("zone").contains(k) for k in keys}, bounds)
    assert sorted(map(tuple, got.collect())) == brute_flags(days, ranges, keys)


def test_long_ranges_are_two_rows_each_and_not_their_days(spark):
    bounds = spark.createDataFrame([(D(1900, 1, 1), D(2100, 12, 31))], "lo date, hi date")
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    ranges = spark.range(200_000).selectExpr(
        "timestamp(date_add(date'1900-06-01', int(id % 30000))) AS start_date", "timestamp(date_add(date'2000-01-01', int(id % 100))) AS end_date"
    )
    got = flag_days(days, ranges, {"any": F.lit(True)}, bounds)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "inline" in plan
    inside = got.groupBy("any").agg(F.min("date"), F.max("date"), F.count("*")).collect()
    first, last = D(1900, 6, 1), D(2000, 4, 9)
    (row,) = [tuple(r)[1:] for r in inside if r["any"]]
    assert row == (first, last, (last - first).days + 1)


def test_ranges_outside_the_bounds_and_none_at_all(spark):
    bounds = spark.createDataFrame([(D(2023, 1, 1), D(2023, 1, 3))], "lo date, hi date")
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    moment = lambda *d: dt.datetime(*d)
    ranges = [(moment(2020, 1, 1), moment(2022, 1, 1), True), (moment(2024, 1, 1), moment(2025, 1, 1), True), (None, moment(2023, 1, 2), True), (moment(2023, 1, 2), moment(2023, 1, 2), None)]
    frame = spark.createDataFrame(ranges, "start_date timestamp, end_date timestamp, f boolean")
    for some in (frame, frame.limit(0)):
        got = flag_days(days, some, {"f": F.col("f")}, bounds).orderBy("date").collect()
        assert [r.f for r in got] == brute_open(days, some)


def brute_open(days, ranges):
    """By SQL's own comparison, where a null start is no start."""
    joined = days.join(ranges, (F.col("date").cast("timestamp") >= F.col("start_date")) & (F.col("date").cast("timestamp") <= F.col("end_date")) & F.col("f"), "left_semi")
    hit = {r.date for r in joined.collect()}
    return [r.date in hit for r in days.orderBy("date").collect()]


def test_running_index_of_uneven_order(spark):
    values = [i if i < 900 else i * 10**9 for i in range(1000)]
    random.Random(1).shuffle(values)
    frame = spark.createDataFrame([(v,) for v in values], "o bigint")
    got = {r.o: r.i for r in ranking.running_index(frame, "o", "i").collect()}
    assert got == {v: i for i, v in enumerate(sorted(values))}


@pytest.mark.parametrize("n", [0, 1, 2])
def test_running_index_of_few_rows(spark, n):
    frame = spark.createDataFrame([(5 * i,) for i in range(n)], "o bigint")
    assert sorted(r.i for r in ranking.running_index(frame, "o", "i").collect()) == list(range(n))


def test_first_seen_index(spark):
    frame = spark.createDataFrame([(i, c) for i, c in enumerate("bbacabd")], "o bigint, c string")
    got = {r.c: r.id for r in ranking.first_seen_index(frame, "c", "o").collect()}
    assert got == {"b": 0, "a": 1, "c": 2, "d": 3}


def test_split_takes_the_share_of_each_class_even_of_a_hot_one(spark):
    data = [(i, "hot" if i % 10 else "rare") for i in range(2000)] + [(9999, "single"), (10000, None)]
    frame = spark.createDataFrame(data, "k bigint, y string")
    split = ranking.stratified_split(frame, "y", "k").collect()
    assert len(split) == len(data)
    taken = {r.k for r in split if r.is_test}
    want = set()
    for label in {y for _, y in data}:
        keys = sorted((hashlib.md5(f"{k}42".encode()).hexdigest(), k) for k, y in data if y == label)
        want |= {k for _, k in keys[: math.ceil(0.2 * len(keys))]}
    assert taken == want


def test_split_does_not_shuffle_the_rows(spark):
    frame = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("y"), F.lit("wide").alias("w"))
    plan = ranking.stratified_split(frame, "y", "k")._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "BroadcastHashJoin" in plan and not shuffles


def test_sample_is_repeatable_across_partitions(spark, rows):
    frame = spark.range(500)
    a = rows(ranking.seeded_sample(frame.repartition(3), "id", 5))
    b = rows(ranking.seeded_sample(frame.repartition(7), "id", 5))
    assert a == b and len(a) == 5


def test_latest_rows_put_nulls_first_and_run_as_top_n(spark):
    frame = spark.createDataFrame(
        [(2023, 1, 1, "a"), (2023, 1, 2, "b"), (None, 1, 1, "c"), (2023, 1, 2, "a")], "an int, mois int, jour int, com string"
    )
    top = ranking.latest_rows(frame, 3, ["com"])
    assert [r.com for r in top.collect()] == ["c", "a", "b"]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_latest_rows_of_a_partitioned_table_read_the_newest_years(spark, tmp_path):
    data = [(y, m, 1, f"{y}{m}") for y in (2019, 2020, 2021) for m in range(1, 7)]
    frame = spark.createDataFrame(data, "an int, mois int, jour int, com string")
    frame.write.partitionBy("an").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    top = ranking.latest_rows_by_year(table, 8, ["com"])
    assert [r.com for r in top.collect()] == [r.com for r in ranking.latest_rows(frame, 8, ["com"]).collect()]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "2021" in plan and "2020" in plan and "2019" not in plan and "PartitionFilters: [an" in plan
    nulls = frame.unionByName(frame.limit(2).withColumn("an", F.lit(None).cast("int")))
    assert [r.an for r in ranking.latest_rows_by_year(nulls, 3, ["com"]).collect()] == [None, None, 2021]


def test_profiles(spark, rows):
    frame = spark.createDataFrame([(1, None), (2, "a"), (None, None)], "n int, s string")
    assert rows(aggregates.null_counts(frame)) == [("n", 1), ("s", 2)]
    assert rows(aggregates.column_profile(frame)) == [("n", "int", 2), ("s", "string", 1)]
    assert rows(aggregates.value_counts(frame, "s")) == [("a", 1)]


def test_last_wins(spark, rows):
    frame = spark.createDataFrame([("d", "old", 1), ("d", "new", 2), ("e", "x", 1)], "k string, v string, o int")
    assert rows(aggregates.last_wins(frame, "k", "v", F.col("o"))) == [("d", "new"), ("e", "x")]


def scores(truth, guess):
    labels = sorted(set(truth) | set(guess))
    accuracy = sum(t == p for t, p in zip(truth, guess)) / len(truth)
    f1 = {}
    for label in labels:
        tp = sum(t == p == label for t, p in zip(truth, guess))
        total = truth.count(label) + guess.count(label)
        f1[label] = 2 * tp / total
    return accuracy, f1, sum(f1[label] * truth.count(label) for label in labels) / len(truth)


def test_scores_equal_their_definitions(spark):
    rng = random.Random(3)
    truth = [rng.randrange(4) for _ in range(200)]
    guess = [rng.choice([t, rng.randrange(5)]) for t in truth]
    frame = spark.createDataFrame(list(zip(truth, guess)), "t int, p int")
    accuracy, f1, weighted = scores(truth, guess)
    got = evaluation.accuracy_weighted_f1(frame, "t", "p").first()
    assert got.accuracy == pytest.approx(accuracy) and got.f1 == pytest.approx(weighted)
    got = evaluation.accuracy_f1(frame, "t", "p").first()
    assert got.accuracy == pytest.approx(accuracy) and got.f1 == pytest.approx(f1[1])


def test_scores_of_a_class_that_never_occurs(spark):
    frame = spark.createDataFrame([(0, 0), (0, 0)], "t int, p int")
    assert tuple(evaluation.accuracy_f1(frame, "t", "p").first()) == (1.0, 0.0)
    assert evaluation.class_ratio(frame, "t").first().ratio is None
    assert [tuple(r) for r in evaluation.confusion_matrix(frame, "t", "p").collect()] == [(0, 0, 2)]


def test_confusion_matrix_has_every_class(spark, rows):
    frame = spark.createDataFrame([(0, 0), (1, 2), (1, 1), (0, 0), (2, 1), (1, 7), (None, 1)], "t int, p int")
    pairs = Counter((t, p) for t, p in [(0, 0), (1, 2), (1, 1), (0, 0), (2, 1), (1, 7)])
    want = sorted((float(t), float(p), pairs[t, p]) for t in (0, 1, 2, 7) for p in (0, 1, 2, 7))
    assert sorted(rows(evaluation.confusion_matrix(frame, "t", "p"))) == want


def test_contracts(spark):
    frame = spark.createDataFrame([(1, 2)], "b int, a int")
    assert schemas.conform(frame, ["a", "b"]).columns == ["a", "b"]
    assert schemas.column_diff(["a", "c"], frame.columns) == (["c"], ["b"])
    with pytest.raises(ValueError, match=r"missing: \['c'\], extra: \['b'\]"):
        schemas.conform(frame, ["a", "c"])
    with pytest.raises(ValueError, match="jour"):
        schemas.require_columns(frame, ["jour"])
    with pytest.raises(ValueError):
        schemas.drop_strict(frame, "z")
    assert schemas.drop_strict(frame, "a").columns == ["b"]
