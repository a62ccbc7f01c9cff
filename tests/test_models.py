import datetime as dt
import random
import uuid

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from areaday.fixed import BOOST_ROUNDS, COUNT
from areaday.ml import features, forest, training
from areaday.registered import models
from areaday.session import new_path
from areaday.sinks.tables import Audit, load


def test_scaling_by_population_deviation_with_nulls_and_constants(spark):
    frame = spark.createDataFrame([(1.0, 5.0, -3.0), (3.0, 5.0, -1.0), (None, 5.0, None)], "a double, b double, c double")
    got = features.standardise(frame, ["a", "b", "c"]).collect()
    assert [tuple(r) for r in got] == [(-1.0, 0.0, -1.0), (1.0, 0.0, 1.0), (None, 0.0, None)]


def test_unknown_and_null_categories_are_all_zeros(spark):
    fit = spark.createDataFrame([("x", True), ("y", False), ("x", True)], "c string, b boolean")
    model = Pipeline(stages=features.preprocessing(fit, [], ["c", "b"])).fit(fit)
    new = spark.createDataFrame([("x", True), ("z", None), (None, False)], "c string, b boolean")
    got = [r.v for r in model.transform(new).select(vector_to_array("features").alias("v")).collect()]
    assert got == [[1.0, 0.0, 1.0, 0.0], [0.0, 0.0, 0.0, 0.0], [0.0, 0.0, 0.0, 1.0]]


def test_columns_by_type(spark):
    frame = spark.createDataFrame([(1, 2.0, "a", True)], "i int, d double, s string, b boolean")
    assert features.numeric_columns(frame) == ["i", "d"]
    assert features.other_columns(frame) == ["s", "b"]
    assert features.integers_as_double(frame).dtypes == [("i", "double"), ("d", "double"), ("s", "string"), ("b", "boolean")]


def test_threshold_includes_itself(spark):
    frame = spark.createDataFrame([(0.8,), (0.79,)], "p double")
    assert [r[0] for r in frame.select(training.at_threshold(F.col("p"))).collect()] == [1, 0]


def panel_rows(spark, n=400, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day = dt.date(2023, 1, 1) + dt.timedelta(i % 365)
        com = rng.choice(["77001", "77002", "77003"])
        hot = com == "77001" and day.weekday() >= 5
        rows.append((i, com, day, day.day, day.month, day.year, bool(i % 7 == 0), rng.uniform(0, 30) if i % 11 else None, int(hot)))
    return spark.createDataFrame(
        rows, f"row bigint, com string, date date, jour int, mois int, an int, public_holidays boolean, temp double, {COUNT} int"
    )


def test_forest_learns_saves_loads_and_scores(spark):
    observed = Observation()
    spark.range(1).observe(observed, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert observed.get == {"n": 1}
    frame = panel_rows(spark).withColumn("weekday", F.weekday("date")).withColumn("dag_id", F.lit("elt"))
    trained = training.train_forest(frame, "row", max_depth=8)
    assert trained.predictions.count() == sum(-(-n // 5) for n in (r["count"] for r in frame.groupBy(COUNT).count().collect()))
    scores = trained.scores.first()
    assert scores.accuracy > 0.9 and scores.f1 > 0.6
    assert set(trained.features) == {"com", "jour", "mois", "an", "public_holidays", "temp", "weekday"}
    assert trained.example.count() == 5
    model, signature = training.load_model(training.save_model(trained, new_path(spark, "model"), spark), spark)
    assert signature == trained.signature
    inputs = features.integers_as_double(frame).select(*trained.features)
    scored = training.score(model, inputs.select(*sorted(trained.features)), signature.fieldNames())
    assert scored.columns == [*signature.fieldNames(), "accident"]
    assert scored.filter("accident = 1").count() > 0
    with pytest.raises(ValueError, match="missing"):
        training.score(model, inputs.drop("temp"), signature.fieldNames())
    assert {r.metric for r in training.metric_rows(trained.scores, "run").collect()} == {"accuracy", "f1"}


def test_forest_of_many_classes(spark):
    rows = spark.range(1500).select("id", (F.col("id") % 150).cast("string").alias("kind"), (F.col("id") % 150 * 3 + 7).alias("class"))
    trained = training.train_forest(rows, "id", "class", trees=3, weighted=True)
    assert trained.predictions.count() == 300
    assert {r.prediction for r in trained.predictions.collect()} <= {float(3 * i + 7) for i in range(150)}


def test_boosting_finds_the_rare_class(spark):
    numbered, mapping = training.imbalanced_features(panel_rows(spark), ["public_holidays"], "row")
    assert sorted(r.id for r in mapping.collect()) == [0, 1, 2] and mapping.columns == ["commune", "id"]
    assert {"year", "month", "day", "weekday", "weekend", "accident", "com"} <= set(numbered.columns)
    assert not {"jour", "mois", "an", "date", COUNT} & set(numbered.columns)
    trained = training.train_boosted(numbered, "row", rounds=5, threshold=0.5)
    assert trained.scores.first().f1 > 0.6
    assert training.confusion(trained, "accident").agg(F.count("*"), F.sum("n")).first() == (4, trained.predictions.count())
    bad = trained.predictions.filter((F.col("probability") >= 0.5) != (F.col("prediction") == 1))
    assert bad.isEmpty()


def test_days_by_commune(spark, rows):
    frame = spark.createDataFrame([("a", 3, 1), ("a", 1, 1), ("a", 3, 1), ("a", 2, 0), ("b", 9, 0)], "com string, day int, accident int")
    assert rows(training.days_by_commune(frame)) == [("a", [1, 3])]


def test_training_from_a_loaded_table(spark, sf):
    table = f"t_{uuid.uuid4().hex}"
    rows = panel_rows(spark).withColumns({"dep": F.lit("77"), "population": F.col("row").cast("int") % 9}).drop("row")
    unique = rows.dropDuplicates(["com", "date"])
    load(unique, table, Audit(dt.datetime(2025, 3, 8), "elt", "load"), path=new_path(spark, "table"))
    trained = training.train_from_table(spark, table)
    assert not {"execution_date", "dag_id", "task_id", "date", "row_key", COUNT} & set(trained.features)
    assert 20 <= trained.predictions.count() <= 21
    assert 0 <= trained.scores.first().f1 <= 1


def test_a_forest_too_large_for_the_driver_is_fitted_saved_and_applied_in_parts(spark, monkeypatch):
    rng = random.Random(3)
    points = [(i, rng.uniform(-1, 1), rng.uniform(-1, 1), rng.choice([0, 7, 70])) for i in range(300)]
    rows = spark.createDataFrame(points, "id bigint, x double, y double, class int")
    whole = training.train_forest(rows, "id", "class", trees=5, weighted=True)
    nodes = whole.model.stages[-3].totalNumNodes
    monkeypatch.setattr(training, "FOREST_NUMBERS", nodes // 2 * (3 + training.NODE_NUMBERS))
    trained = training.train_forest(rows, "id", "class", trees=5, weighted=True)
    assert 2 <= len(trained.model.parts) <= 5
    models = [training.RandomForestClassificationModel.load(part) for part in trained.model.parts]
    assert sum(m.getNumTrees for m in models) == 5 and all(m.totalNumNodes < nodes for m in models)
    assert len({m.toDebugString.split("\n", 1)[1] for m in models}) == len(models)
    found = trained.predictions.collect()
    assert {r.id for r in found} == {r.id for r in whole.predictions.collect()}
    path = training.save_model(trained, new_path(spark, "forest"), spark)
    model, signature = training.load_model(path, spark)
    assert len(model.parts) == len(models) and signature == whole.signature
    frame = rows.select("x", "y")
    got = {(r.x, r.y): r.predicted for r in training.score(model, frame, signature.fieldNames(), "predicted").collect()}
    ready = trained.model.before.transform(frame)
    votes = {}
    for m in models:
        for r in m.transform(ready).select("x", "y", "rawPrediction").collect():
            votes[r.x, r.y] = [a + b for a, b in zip(votes.get((r.x, r.y), [0.0] * 3), r.rawPrediction)]
    assert got == {point: [0, 7, 70][v.index(max(v))] for point, v in votes.items()}
    assert sum(got[x, y] == c for _, x, y, c in points) > 200
    training.save_model(whole, path, spark)
    assert not isinstance(training.load_model(path, spark)[0], training.SplitForest)


def test_the_rows_that_a_task_of_a_training_keeps_do_not_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(training, "ROWS_PER_TASK", 100)
    frame = spark.range(4000).select("id", (F.col("id") % 2).cast("int").alias("accident"), F.rand(1).alias("x"))
    train, _ = training.split_parts(frame, "accident", "id")
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    with training.tasks_by_rows(train):
        sizes = train.select("id").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert spark.conf.get(name, None) == before
    assert sum(sizes) == 3200 and max(sizes) <= 2 * 100


def orders_to_boost(spark):
    """As many orders on each day of two weeks, with nothing else to tell them apart by."""
    days = [(i, f"{i % 3}", dt.date(2023, 1, 2) + dt.timedelta(i % 14)) for i in range(140)]
    rows = [(i, com, 100.0 + i % 7, day, day.day, day.month, day.year, 0, *[False] * 4, float(i % 5)) for i, com, day in days]
    names = f"o_orderkey bigint, com string, o_totalprice double, date date, jour int, mois int, an int, {COUNT} int"
    return spark.createDataFrame(rows, f"{names}, {', '.join(f'{c} boolean' for c in models.FLAGS)}, temp double")


def test_the_imbalanced_confusion_comes_from_a_training_of_all_rounds(spark, rows, monkeypatch):
    rounds, boosted = [], training.GBTClassifier
    monkeypatch.setattr(training, "GBTClassifier", lambda **given: rounds.append(given["maxIter"]) or boosted(**given))
    monkeypatch.setattr(models, "rows_to_boost", lambda *_: orders_to_boost(spark))
    assert rows(models.imbalanced_confusion(spark, "")) == [(0.0, 0.0, 20), (0.0, 1.0, 0), (1.0, 0.0, 0), (1.0, 1.0, 8)]
    assert rounds == [BOOST_ROUNDS]


def test_the_imbalanced_held_out_rows_ask_for_a_training_of_all_rounds(spark, monkeypatch):
    class Asked(Exception):
        pass

    def boosted(**given):
        raise Asked(given["maxIter"])

    monkeypatch.setattr(training, "GBTClassifier", boosted)
    monkeypatch.setattr(models, "rows_to_boost", lambda *_: orders_to_boost(spark))
    with pytest.raises(Asked) as asked:
        models.imbalanced_held_out(spark, "")
    assert asked.value.args == (BOOST_ROUNDS,)


def test_a_large_forest_is_not_fitted_by_passes_over_all_rows_for_some_of_its_nodes(spark, monkeypatch):
    rng = random.Random(4)
    points = [(i, rng.uniform(-1, 1), rng.uniform(-1, 1), rng.choice([0, 1])) for i in range(600)]
    rows = spark.createDataFrame(points, "id bigint, x double, y double, class int")
    fitted, fit = [], training.RandomForestClassifier._fit
    monkeypatch.setattr(training, "FOREST_NUMBERS", 100 * (2 + training.NODE_NUMBERS))
    monkeypatch.setattr(training.RandomForestClassifier, "_fit", lambda self, df: fitted.append(df.count()) or fit(self, df))
    trained = training.train_forest(rows, "id", "class", trees=4, weighted=True)
    assert len(trained.model.parts) == 4 and all(n <= 50 for n in fitted)
    nodes = [training.RandomForestClassificationModel.load(part).totalNumNodes for part in trained.model.parts]
    assert min(nodes) > 100


def nodes_of(frame):
    return sorted((r.tree, r.id, r.left_child, r.right_child, tuple(r.stats), r.feature, r.cut) for r in frame.collect())


def test_trees_grown_from_large_nodes_hold_all_their_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    values = rng.integers(0, 40, (900, 3)).astype(float)
    kinds = ((values[:, 0] > 20).astype(int) + 2 * (values[:, 1] > 11) + (rng.random(900) < 0.1)) % 4
    rows = [(i, *v, int(k)) for i, (v, k) in enumerate(zip(values.tolist(), kinds, strict=True))]
    frame = spark.createDataFrame(rows, "id bigint, a double, b double, c double, _class int").repartition(5, "id")
    ready = Pipeline(stages=features.preprocessing(frame, ["a", "b", "c"], [])).fit(frame).transform(frame)
    monkeypatch.setattr(forest, "CHUNK", 300)
    cuts = forest.cuts_of(ready, 3)
    assert all(20 <= len(cut) < forest.BINS and (np.diff(cut) > 0).all() for cut in cuts)
    chunks = forest.chunks_of(ready, cuts)
    assert 9 <= chunks.count() <= 20
    shape = forest.Shape(3, 4, 2, 30)
    drawn = {}
    for t in range(3):
        for name, x, y in forest.read_chunks(iter(chunks.toArrow().to_batches()), 3):
            drawn[t] = drawn.get(t, 0) + np.bincount(y, weights=forest.times_drawn(name, t, len(x)), minlength=4)
    for most in (2000, 100):
        nodes = nodes_of(forest.grow_trees(chunks, 900, range(3), shape, most))
        for t in range(3):
            own = [n[1:] for n in nodes if n[0] == t]
            stats = {n[0]: np.array(n[3]) for n in own}
            assert [n[0] for n in own] == list(range(len(own)))
            assert stats[0].tolist() == drawn[t].tolist()
            for number, left, right, _, feature, _ in own:
                assert (feature < 0) == (left < 0) == (right < 0)
                if left >= 0:
                    assert number < left < len(own) and number < right < len(own)
                    assert (stats[left] + stats[right]).tolist() == stats[number].tolist() and min(stats[left].sum(), stats[right].sum()) > 0
            children = [child for n in own for child in n[1:3] if child >= 0]
            assert sorted(children) == list(range(1, len(own)))
    assert nodes == nodes_of(forest.grow_trees(chunks, 900, range(3), shape, 100))


def test_a_grown_tree_separates_what_can_be_and_merges_sides_of_one_class():
    x = np.array([[0], [1], [2], [3]], np.uint8)
    shape = forest.Shape(1, 2, 1, 30)
    rng = np.random.default_rng(0)
    tree = forest.grown(x, np.array([0, 0, 1, 1]), np.array([1, 2, 1, 1]), shape, 0, rng)
    assert tree["cut"][0] == 1 and tree["left"].tolist() == [1, -1, -1] and tree["stats"].tolist() == [[3, 2], [3, 0], [0, 2]]
    same = forest.grown(np.zeros((4, 1), np.uint8), np.array([0, 1, 0, 1]), np.ones(4), shape, 0, rng)
    assert same["feature"].tolist() == [-1]
    mostly = forest.grown(x, np.array([0, 0, 0, 1]), np.array([9, 9, 9, 1]), forest.Shape(1, 2, 1, 1), 0, rng)
    assert mostly["feature"].tolist()[0] >= 0
    # Both sides predict class 0.
    level = forest.grown(np.array([[0], [0], [1], [1]], np.uint8), np.array([0, 1, 0, 1]), np.array([9, 1, 9, 4]), forest.Shape(1, 2, 1, 1), 0, rng)
    assert level["feature"].tolist() == [-1] and level["stats"].tolist() == [[18, 5]]
    stopped = forest.grown(x, np.array([0, 1, 0, 1]), np.ones(4), shape, 30, rng)
    assert stopped["feature"].tolist() == [-1]
