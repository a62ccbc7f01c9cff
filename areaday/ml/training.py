"""Training, evaluation and scoring."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassificationModel, RandomForestClassifier  # noqa: F401
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from areaday.fixed import (
    BOOST_DEPTH,
    BOOST_RATE,
    BOOST_ROUNDS,
    BOOST_SAMPLE,
    COUNT,
    FOREST_TREES,
    NOT_FEATURES,
    ROWS_FOR_TRAINING,
    SEED,
    THRESHOLD,
)
from areaday.functions.dates import calendar_features
from areaday.ml import features, forest
from areaday.operators.aggregates import distinct_per_group
from areaday.operators.evaluation import accuracy_f1, accuracy_weighted_f1, class_ratio, confusion_matrix
from areaday.operators.joins import lookup
from areaday.operators.ranking import first_seen_index, latest_rows_by_year, seeded_sample, stratified_split
from areaday.schemas import conform
from areaday.session import materialise, new_path, setting, shared_dir, wide_partitions


#: Rows that one task of a training reads and keeps in memory.
ROWS_PER_TASK = 250_000


#: Numbers in the nodes of trees that the driver holds at once; a node has one per class and some ``NODE_NUMBERS`` more.
FOREST_NUMBERS = 2_500_000
NODE_NUMBERS = 40


class SplitForest:
    """A fitted forest whose trees are saved in parts, each a forest of Spark's own.

    ``before`` makes the features, ``after`` the prediction from the class with most votes. Driver and tasks read the
    trees one at a time.
    """

    def __init__(self, before: PipelineModel, parts: list[str], after: PipelineModel):
        self.before, self.parts, self.after, self.trees = before, parts, after, None

    def transform(self, df: DataFrame) -> DataFrame:
        if self.trees is None:
            self.trees = [forest.read_trees(df.sparkSession, part) for part in self.parts]
        predicted = forest.predicted_class(F.col("features"), self.trees)
        ready = self.before.transform(df).withColumn("_predicted", predicted)
        return self.after.transform(ready.select(*df.columns, "_predicted"))

    def save(self, path: str) -> None:
        self.before.write().overwrite().save(f"{path}/before")
        self.after.write().overwrite().save(f"{path}/after")
        for i, part in enumerate(self.parts):
            forest.copy_saved(SparkSession.active(), part, f"{path}/part-{i}")

    @classmethod
    def load(cls, path: str, parts: int) -> SplitForest:
        before, after = (PipelineModel.load(f"{path}/{name}") for name in ("before", "after"))
        return cls(before, [f"{path}/part-{i}" for i in range(parts)], after)


class Trained(NamedTuple):
    model: PipelineModel | SplitForest
    features: list[str]
    predictions: DataFrame
    scores: DataFrame
    signature: StructType
    example: DataFrame


def parts_to_fit(rows: int) -> int:
    """Into how many tasks training deals its rows, so that none keeps more than ``ROWS_PER_TASK``."""
    return -(-rows // ROWS_PER_TASK)


def split_parts(df: DataFrame, label: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Training and test part of ``df``, written out once for all the passes over them and spread over all cores."""
    rows = materialise(df)
    marked = stratified_split(rows, label, key)
    kept = materialise(marked.repartition(max(wide_partitions(df.sparkSession), parts_to_fit(rows.count())), key))
    return kept.filter(~F.col("is_test")).drop("is_test"), kept.filter("is_test").drop("is_test")


@contextmanager
def tasks_by_rows(train: DataFrame) -> Iterator[None]:
    """Let the files of ``train`` be read by as many tasks as their rows need.

    Spark reads small files together, as many as give each core one task, so that what a task keeps would grow with the
    table. A table with fewer rows is read as Spark reads it anyway.
    """
    spark = train.sparkSession
    n = parts_to_fit(train.count())
    if n <= spark.sparkContext.defaultParallelism:
        yield
    else:
        with setting(spark, "spark.sql.files.minPartitionNum", str(n)):
            yield


def fit_in_parts(before: PipelineModel, whole: RandomForestClassifier, labelled: DataFrame, classes: int) -> list[str]:
    """Saved forests of some of the trees each, or none if all trees together have few enough nodes for the driver.

    A tree has fewer nodes than twice its rows. Where that could be too many, one tree shows how many there are. Spark's
    own fit reads all rows for every few thousand nodes, so these trees are grown in tasks.
    """
    spark, trees, rows = labelled.sparkSession, whole.getNumTrees(), labelled.count()
    most = FOREST_NUMBERS // (classes + NODE_NUMBERS)
    if 2 * rows * trees <= most:
        return []
    ready = materialise(before.transform(labelled).select("features", "_class"))
    columns = ready.first().features.size
    shape = forest.Shape(columns, classes, math.ceil(math.sqrt(columns)), whole.getMaxDepth())
    cuts = forest.cuts_of(ready, columns)
    chunks = forest.chunks_of(ready, cuts)
    first_tree = forest.grow_trees(chunks, rows, range(1), shape, ROWS_PER_TASK)
    at_once = max(1, most // first_tree.count())
    if at_once >= trees:
        return []
    nodes = first_tree.unionByName(forest.grow_trees(chunks, rows, range(1, trees), shape, ROWS_PER_TASK))
    saved: dict[int, str] = {}
    parts = []
    for first in range(0, trees, at_once):
        n = min(at_once, trees - first)
        if n not in saved:
            # A forest of a few rows has everything but the nodes as Spark writes it.
            saved[n] = new_path(spark, "trees")
            whole.copy({whole.numTrees: n}).fit(ready.limit(50)).write().save(saved[n])
        parts.append(new_path(spark, "trees"))
        forest.copy_saved(spark, saved[n], parts[-1], nodes=False)
        forest.write_nodes(nodes.filter(F.col("tree").between(first, first + n - 1)), cuts, first, parts[-1])
    return parts


def train_forest(
    df: DataFrame, key: str, target: str = COUNT, trees: int = FOREST_TREES, max_depth: int = 30, weighted: bool = False
) -> Trained:
    """Scale, encode and fit a random forest on all columns but ``key``, target and audit columns.

    ``key`` is a unique column that the split and the example rows are drawn by. The target holds
    numbers, each of which is a class, however many there are. Depth 30 is the most Spark allows. With ``weighted`` the F1 score averages
    over all classes, otherwise it is that of class 1. A forest with too many nodes for the driver becomes a ``SplitForest``.
    """
    used = features.integers_as_double(df.drop(*NOT_FEATURES).withColumn(key, F.col(key).cast("string")))
    inputs = used.drop(target, key)
    train, test = split_parts(used, target, key)
    classes = StringIndexer(inputCol=target, outputCol="_class", stringOrderType="alphabetAsc").fit(train)
    whole = RandomForestClassifier(
        labelCol="_class",
        predictionCol="_predicted",
        numTrees=trees,
        maxDepth=max_depth,
        seed=SEED,
        featureSubsetStrategy="sqrt",
    )
    named = IndexToString(inputCol="_predicted", outputCol="_name", labels=classes.labels)
    number = SQLTransformer(statement="SELECT *, CAST(_name AS DOUBLE) AS prediction FROM __THIS__")
    stages = features.preprocessing(train, features.numeric_columns(inputs), features.other_columns(inputs))
    labelled = classes.transform(train)
    before = Pipeline(stages=stages).fit(labelled)
    parts = fit_in_parts(before, whole, labelled, len(classes.labels))
    if parts:
        model = SplitForest(before, parts, PipelineModel([named, number]))
    else:
        # The copy leaves behind the training summary, which holds the session and so keeps the model from
        # being sent to tasks once the session has observed a write.
        model = Pipeline(stages=[*before.stages, whole, named, number]).fit(labelled).copy()
    predictions = model.transform(test).select(key, target, "prediction")
    score = accuracy_weighted_f1 if weighted else accuracy_f1
    example = seeded_sample(train, key, 5).drop(target, key)
    return Trained(model, inputs.columns, predictions, score(predictions, target, "prediction"), inputs.schema, example)


def train_from_table(spark: SparkSession, table: str, n: int = ROWS_FOR_TRAINING, weighted: bool = True) -> Trained:
    """Train a forest on the ``n`` latest rows of a loaded training table."""
    latest = latest_rows_by_year(spark.table(table), n, ["dep", "com"])
    keyed = latest.withColumn("row_key", F.concat_ws("-", "dep", "com", "an", "mois", "jour"))
    return train_forest(keyed, "row_key", weighted=weighted)


def imbalanced_features(df: DataFrame, flags: list[str], order: str) -> tuple[DataFrame, DataFrame]:
    """The training set as plain numbers with label ``accident``, and the mapping of communes to ids.

    ``order`` is a unique number per row; communes are numbered as they come in it.
    """
    labelled = features.binary_label(df, COUNT, "accident").drop(COUNT, "jour", "mois", "an")
    dated = labelled.withColumns(calendar_features(F.col("date"))).drop("date")
    mapping = materialise(first_seen_index(dated, "com", order))
    numbered = lookup(features.flags_as_int(dated, flags), mapping, "com", "com", "id")
    return numbered, mapping.withColumnRenamed("com", "commune")


def positive_probability(probability: str = "probability") -> Column:
    return vector_to_array(F.col(probability))[1]


def at_threshold(score: Column, threshold: float = THRESHOLD) -> Column:
    """1 from the threshold on, itself included."""
    return (score >= threshold).cast("int")


def train_boosted(
    df: DataFrame, key: str, label: str = "accident", rounds: int = BOOST_ROUNDS, threshold: float = THRESHOLD
) -> Trained:
    """Fit boosted trees on all columns but ``key`` and label, class 1 weighted by its rarity.

    Spark draws the columns for each node, where a draw per tree would be the closest equal.
    """
    train, test = split_parts(df, label, key)
    ratio = class_ratio(train, label).first().ratio or 1.0
    inputs = [c for c in df.columns if c not in (key, label)]
    trees = GBTClassifier(
        labelCol=label,
        weightCol="weight",
        maxIter=rounds,
        stepSize=BOOST_RATE,
        maxDepth=BOOST_DEPTH,
        subsamplingRate=BOOST_SAMPLE,
        featureSubsetStrategy=str(BOOST_SAMPLE),
        checkpointInterval=10,
        seed=SEED,
    )
    shared_dir(df.sparkSession)
    with tasks_by_rows(train):
        model = Pipeline(stages=[*features.assemble(inputs), trees]).fit(features.class_weight(train, label, ratio))
    probability = positive_probability()
    predictions = model.transform(features.class_weight(test, label, ratio)).select(
        key, label, probability.alias("probability"), at_threshold(probability, threshold).alias("prediction")
    )
    signature = df.select(*inputs).schema
    example = seeded_sample(train, key, 5).select(*inputs)
    return Trained(model, inputs, predictions, accuracy_f1(predictions, label, "prediction"), signature, example)


def confusion(trained: Trained, label: str) -> DataFrame:
    return confusion_matrix(trained.predictions, label, "prediction")


def score(model: PipelineModel | SplitForest, df: DataFrame, expected: list[str], output: str = "accident") -> DataFrame:
    """``df``, which must have exactly the expected columns, in their order and with the prediction."""
    ready = conform(df, expected)
    return model.transform(ready).select(*expected, F.col("prediction").cast("int").alias(output))


def metric_rows(scores: DataFrame, run_id: str) -> DataFrame:
    """One row per metric of a run, to append to a table of metrics."""
    return scores.unpivot([], scores.columns, "metric", "value").select(F.lit(run_id).alias("run_id"), "metric", "value")


def save_model(trained: Trained, path: str, spark: SparkSession) -> str:
    """Model and input signature below ``path``, replacing what is there."""
    split = isinstance(trained.model, SplitForest)
    if split:
        trained.model.save(f"{path}/trees")
    else:
        trained.model.write().overwrite().save(f"{path}/model")
    parts = spark.createDataFrame([(str(len(trained.model.parts) if split else 0),)], "value STRING")
    parts.coalesce(1).write.mode("overwrite").text(f"{path}/parts")
    signature = spark.createDataFrame([(trained.signature.json(),)], "value STRING")
    signature.coalesce(1).write.mode("overwrite").text(f"{path}/signature")
    return path


def load_model(path: str, spark: SparkSession) -> tuple[PipelineModel | SplitForest, StructType]:
    text = spark.read.text(f"{path}/signature").first().value
    try:
        parts = int(spark.read.text(f"{path}/parts").first().value)
    except AnalysisException as error:  # a model that was saved whole
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        parts = 0
    model = SplitForest.load(f"{path}/trees", parts) if parts else PipelineModel.load(f"{path}/model")
    return model, StructType.fromJson(json.loads(text))


def days_by_commune(predictions: DataFrame) -> DataFrame:
    """The days of the month on which an accident is predicted, per commune."""
    return distinct_per_group(predictions.filter(F.col("accident") == 1), "com", "day")
