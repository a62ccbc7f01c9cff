"""Scores of predicted classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaday.session import materialise


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    """Rows of class 0 and of class 1, and how many of the first come on one of the second."""
    counted = df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives")
    )
    return counted.withColumn("ratio", F.try_divide("negatives", "positives"))


def accuracy_f1(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Accuracy, and the F1 score of class 1 (0 if the class never occurs)."""
    t, p = F.col(truth), F.col(predicted)
    tp = F.count_if((t == 1) & (p == 1))
    wrong = F.count_if((t == 1) != (p == 1))
    return df.agg(
        F.avg((t == p).cast("int")).alias("accuracy"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + wrong), F.lit(0.0)).alias("f1"),
    )


def accuracy_weighted_f1(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Accuracy, and the F1 scores of all classes weighted by how often each is the truth."""
    cells = df.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    roles = F.array(
        F.struct(F.col("t").alias("label"), F.col("n").alias("truths"), F.lit(0).cast("bigint").alias("guesses")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("truths"), F.col("n").alias("guesses")),
    )
    hits = F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)
    # A hit is counted once, on the row for the truth.
    classes = (
        cells.withColumn("hits", hits)
        .select("hits", F.explode(roles).alias("r"))
        .select("r.*", F.when(F.col("r.truths") > 0, F.col("hits")).otherwise(0).alias("hits"))
        .groupBy("label")
        .agg(F.sum("truths").alias("truths"), F.sum("guesses").alias("guesses"), F.sum("hits").alias("hits"))
    )
    f1 = 2 * F.col("hits") / (F.col("truths") + F.col("guesses"))
    return classes.agg(
        (F.sum("hits") / F.sum("truths")).alias("accuracy"),
        (F.sum(f1 * F.col("truths")) / F.sum("truths")).alias("f1"),
    )


def confusion_matrix(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """``truth, predicted, n`` for each pair of the classes that occur as either, with 0 where a pair does not.

    The number of classes is that of a classifier, so the list of them is small; null is no class.
    """
    cells = df.groupBy(F.col(truth).cast("double").alias("truth"), F.col(predicted).cast("double").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    cells = materialise(cells.dropna())
    classes = cells.select(F.explode(F.array("truth", "predicted")).alias("truth")).distinct()
    known = classes.agg(F.collect_set("truth").alias("known")).scalar()
    grid = classes.select("truth", F.explode(known).alias("predicted"))
    return grid.join(cells, ["truth", "predicted"], "left").select("truth", "predicted", F.coalesce("n", F.lit(0)).alias("n"))
