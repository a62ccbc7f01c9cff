"""Published files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> str:
    """A CSV dataset with headers, quotes within quotes doubled. ``overwrite`` replaces what is there; ``ignore`` leaves it.

    Texts keep the white space at their ends.
    """
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(header=True, sep=sep, quote='"', escape='"', **spaces).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def as_json_record(df: DataFrame) -> Column:
    """One JSON object per row, with all columns."""
    return F.to_json(F.struct(*df.columns))


def json_records(df: DataFrame) -> DataFrame:
    return df.select(as_json_record(df).alias("record"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path
