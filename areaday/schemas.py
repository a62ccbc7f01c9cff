"""Explicit schemas of the landed files, as DDL, and checks against them."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame

from areaday.fixed import WEATHER

PUBLIC_HOLIDAYS = "date DATE, public_holiday STRING"
SCHOOL_HOLIDAYS = "zone STRING, type STRING, start_date TIMESTAMP, end_date TIMESTAMP"
COMMUNES = "commune STRING, code_region STRING, code STRING, population INT"
FIRE_BRIGADE = ["name", "city", "department"]
WEATHER_HOURLY = "dt_iso STRING, " + ", ".join(f"{c} DOUBLE" for c in WEATHER)
WEATHER_DAILY = "date DATE, " + ", ".join(f"{c} DOUBLE" for c in WEATHER)
ACCIDENT_COUNTS = "jour INT, mois INT, an INT, dep STRING, com STRING, nombre_d_accidents BIGINT"
COMMUNE_MAPPING = "commune STRING, id BIGINT"

CATALOGUE_JSON = "resources ARRAY<STRUCT<title: STRING, url: STRING, format: STRING>>"
SCHOOL_JSON = (
    "records ARRAY<STRUCT<fields: STRUCT<annee_scolaire: STRING, zones: STRING, description: STRING,"
    " start_date: STRING, end_date: STRING>>>"
)
COMMUNES_JSON = "nom STRING, codeRegion STRING, code STRING, population INT, codesPostaux ARRAY<STRING>"
# The depth of the coordinates depends on the type, so they are first read as text.
GEOJSON = (
    "features ARRAY<STRUCT<properties: STRUCT<code: STRING, nom: STRING>,"
    " geometry: STRUCT<type: STRING, coordinates: STRING>>>"
)


class ColumnDiff(NamedTuple):
    missing: list[str]
    extra: list[str]


def column_diff(expected: Iterable[str], actual: Iterable[str]) -> ColumnDiff:
    """Names that ``actual`` lacks, and names it has beyond ``expected``."""
    expected, actual = set(expected), set(actual)
    return ColumnDiff(sorted(expected - actual), sorted(actual - expected))


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``df`` itself, if it has all ``columns``."""
    missing = column_diff(columns, df.columns).missing
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` in the order of ``columns``, if it has exactly these."""
    diff = column_diff(columns, df.columns)
    if diff.missing or diff.extra:
        raise ValueError(f"columns differ; missing: {diff.missing}, extra: {diff.extra}")
    return df.select(*columns)


def drop_strict(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns that must be there (``df.drop`` alone passes over missing ones)."""
    return require_columns(df, columns).drop(*columns)
