"""Features: scaling, categories, labels, weights."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

# Spark's trees take no missing values. Far below all others, they can be split off like a value.
MISSING = -1.0e9


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def other_columns(df: DataFrame) -> list[str]:
    """Columns that are not numbers; booleans are among them."""
    return [f.name for f in df.schema if not isinstance(f.dataType, NumericType)]


def integers_as_double(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema if isinstance(f.dataType, IntegralType)]
    return df.withColumns({c: F.col(c).cast("double") for c in names})


def flags_as_int(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


def binary_label(df: DataFrame, count: str, label: str) -> DataFrame:
    """1 where the count is not 0."""
    return df.withColumn(label, (F.col(count) != 0).cast("int"))


def scaling(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, nulls left out; a constant column has 1."""
    row = df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns], *[F.stddev_pop(c).alias(f"std_{c}") for c in columns]
    ).first()
    return {c: (row[f"mean_{c}"] or 0.0, row[f"std_{c}"] or 1.0) for c in columns}


def scaled(column: str, mean: float, std: float) -> str:
    return f"((`{column}` - {mean!r}D) / {std!r}D)"


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns scaled to mean 0 and standard deviation 1."""
    stats = scaling(df, columns)
    return df.withColumns({c: F.expr(scaled(c, *stats[c])) for c in columns})


def preprocessing(df: DataFrame, numeric: list[str], categorical: list[str]) -> list[Transformer]:
    """Pipeline stages that turn the columns into ``features``.

    Numbers are scaled with what ``df`` shows. A category gets a place of its own in the vector; one
    that was not seen in fitting has zeros in all of them.
    """
    stats = scaling(df, numeric) if numeric else {}
    parts = [f"coalesce({scaled(c, *stats[c])}, {MISSING!r}D) AS `{c}_scaled`" for c in numeric]
    parts += [f"CAST(`{c}` AS STRING) AS `{c}_text`" for c in categorical]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")]
    inputs = [f"{c}_scaled" for c in numeric]
    if categorical:
        indexed, vectors = [f"{c}_index" for c in categorical], [f"{c}_vector" for c in categorical]
        stages.append(
            StringIndexer(inputCols=[f"{c}_text" for c in categorical], outputCols=indexed, handleInvalid="keep")
        )
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=vectors))
        inputs += vectors
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def assemble(columns: list[str]) -> list[Transformer]:
    """Pipeline stages that put plain numbers into ``features``, nulls marked as missing."""
    parts = [f"coalesce(CAST(`{c}` AS DOUBLE), {MISSING!r}D) AS `{c}_number`" for c in columns]
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"),
        VectorAssembler(inputCols=[f"{c}_number" for c in columns], outputCol="features"),
    ]


def class_weight(df: DataFrame, label: str, ratio: float, weight: str = "weight") -> DataFrame:
    """Weight rows of class 1 by ``ratio``, all others by 1."""
    return df.withColumn(weight, F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))
