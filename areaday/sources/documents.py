"""Landed JSON and HTML payloads as rows.

A document that is cut off or has values of another type raises an error, unless a ``Quarantine`` is given, which such
documents go to.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from areaday import schemas
from areaday.fixed import SCHOOL_HOLIDAY_YEARS, TITLE_DEFAULT
from areaday.functions.dates import utc_instant, years_around
from areaday.functions.text import part, strip
from areaday.operators.aggregates import last_wins
from areaday.sources.boundaries import json_elements
from areaday.sources.quarantine import Quarantine, readable_elements

# The table markup that rows are read from.
ROW = r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"
CELL = r"(?is)<td\b[^>]*>(.*?)</td\s*>"
TAG = r"(?s)<[^>]*>"
FAIL = {"mode": "FAILFAST"}
# How many levels of lists lie above a point in each type of geometry.
GEOMETRY_DEPTHS = {"Point": 0, "MultiPoint": 1, "LineString": 1, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 3}


def elements(
    spark: SparkSession,
    path: str,
    schema: str,
    key: str | None,
    multi_line: bool,
    quarantine: Quarantine | None = None,
    name: str = "documents",
) -> DataFrame:
    """The objects of the lists in JSON documents as column ``r``: of the lists that they are, or of those below ``key``.

    With ``multi_line`` a file is one document, which several tasks read where it is large (``json_elements``); otherwise
    each line is one. With ``quarantine`` documents that cannot be read go there as those of the source ``name``.
    """
    if quarantine is not None:
        return readable_elements(spark, path, schema, key, multi_line, quarantine, name)
    if not multi_line:
        documents = spark.read.schema(schema).options(**FAIL).json(path)
        return documents.select(F.struct("*").alias("r") if key is None else F.explode(key).alias("r"))
    kind = StructType.fromDDL(schema)
    kind = kind if key is None else kind[key].dataType.elementType
    return json_elements(spark, path, key).select(F.from_json("element", kind, FAIL).alias("r"))


def read_catalogue(
    spark: SparkSession, path: str, multi_line: bool = True, quarantine: Quarantine | None = None
) -> DataFrame:
    """The resources of catalogue documents, with defaults for missing fields."""
    resource = elements(spark, path, schemas.CATALOGUE_JSON, "resources", multi_line, quarantine, "catalogue")
    return resource.select(
        F.coalesce("r.title", F.lit(TITLE_DEFAULT)).alias("title"),
        F.coalesce("r.url", F.lit("")).alias("url"),
        F.coalesce("r.format", F.lit("")).alias("format"),
    )


def holidays_of_maps(documents: DataFrame, text: str, order: str) -> DataFrame:
    """Documents that map dates to names, merged: the document last by ``order`` wins a date."""
    entries = documents.select(
        F.col(order).alias("_order"), F.explode(F.from_json(text, "map<string,string>", FAIL)).alias("date", "public_holiday")
    )
    merged = last_wins(entries, "date", "public_holiday", F.col("_order"))
    return merged.withColumn("date", F.to_date("date"))


def read_public_holidays(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """One JSON map per year, in files named by year: the years ``first`` to ``last``, by date.

    A dataset that Spark wrote counts as one file, under its folder's name.
    """
    documents = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    year = F.regexp_extract("_metadata.file_path", r"(\d{4})[^/]*(?:/part-[^/]*)?$", 1)
    dated = documents.select("value", F.when(year != "", year).cast("int").alias("year"))
    return holidays_of_maps(dated.filter(F.col("year").between(first, last)), "value", "year").orderBy("date")


def read_school_holidays(
    spark: SparkSession,
    path: str,
    year: int,
    span: tuple[int, int] = SCHOOL_HOLIDAY_YEARS,
    multi_line: bool = True,
    quarantine: Quarantine | None = None,
) -> DataFrame:
    """School holidays of the school years around ``year``, one row per zone and range."""
    records = elements(spark, path, schemas.SCHOOL_JSON, "records", multi_line, quarantine, "school_holidays")
    fields = records.select("r.fields.*")
    first, last = years_around(year, span)
    in_span = part(F.col("annee_scolaire"), "-", 1).cast("int").between(first, last)
    return fields.filter(in_span).select(
        F.col("zones").alias("zone"),
        F.col("description").alias("type"),
        utc_instant(F.col("start_date")).alias("start_date"),
        utc_instant(F.col("end_date")).alias("end_date"),
    )


def read_communes(
    spark: SparkSession, path: str, multi_line: bool = True, quarantine: Quarantine | None = None
) -> DataFrame:
    """Communes from any number of files, each an array of objects."""
    documents = elements(spark, path, schemas.COMMUNES_JSON, None, multi_line, quarantine, "communes").select("r.*")
    return documents.select(
        F.col("nom").alias("commune"), F.col("codeRegion").alias("code_region"), "code", "population"
    )


def read_postal_codes(
    spark: SparkSession, path: str, multi_line: bool = True, quarantine: Quarantine | None = None
) -> DataFrame:
    documents = elements(spark, path, schemas.COMMUNES_JSON, None, multi_line, quarantine, "postal_codes").select("r.*")
    return documents.select(
        F.col("nom").alias("commune"), F.array_join("codesPostaux", ", ").alias("postal_codes")
    )


def first_html(payload: Column) -> Column:
    """The first non-blank text among the ``data`` fields of a JSON array of objects."""
    items = F.from_json(payload, "array<struct<data: variant>>", FAIL)
    texts = F.transform(
        F.filter(items, lambda x: F.schema_of_variant(x["data"]) == "STRING"),
        lambda x: x["data"].cast("string"),
    )
    return F.try_element_at(F.filter(texts, lambda t: strip(t) != ""), F.lit(1))


def table_cells(fragment: Column) -> Column:
    """The rows of the tables in an HTML text after the first row, each an array of cells."""
    rows = F.regexp_extract_all(fragment, F.lit(ROW), 1)
    return F.transform(F.slice(rows, 2, F.size(rows)), lambda row: F.regexp_extract_all(row, F.lit(CELL), 1))


@F.pandas_udf(StringType())
def unescape(text: pd.Series) -> pd.Series:
    """Resolve HTML character references; Spark has no function for them."""
    return text.map(html.unescape, na_action="ignore")


def cell_text(cell: Column) -> Column:
    return strip(unescape(F.regexp_replace(cell, TAG, "")))


def fire_brigades(payloads: DataFrame, payload: str) -> DataFrame:
    """Name, city and department from the table rows that have at least three cells."""
    rows = payloads.select(F.explode(table_cells(first_html(F.col(payload)))).alias("cells"))
    full = rows.filter(F.size("cells") >= 3)
    return full.select(
        *[cell_text(F.col("cells")[i]).alias(name) for i, name in enumerate(schemas.FIRE_BRIGADE)]
    )


def read_fire_brigades(spark: SparkSession, path: str) -> DataFrame:
    """Landed search results, one JSON payload per file."""
    return fire_brigades(spark.read.text(path, wholetext=True), "value")


def read_geojson(
    spark: SparkSession, path: str, multi_line: bool = True, quarantine: Quarantine | None = None
) -> DataFrame:
    """``code``, ``nom``, ``type`` and ``polygons`` of the features of GeoJSON documents.

    All geometries come in the form of multi-polygons, lists of polygons of rings of points of coordinates: a polygon as
    a list of one, lines as rings, points as rings of one point. A feature without a geometry has null.
    """
    features = elements(spark, path, schemas.GEOJSON, "features", multi_line, quarantine, "geojson")
    feature = features.select("r.properties.*", "r.geometry.*")

    def coordinates(depth: int) -> Column:
        """The coordinates as nested lists that many levels above a point, wrapped up to the depth of multi-polygons."""
        kind = "double"
        for _ in range(depth + 1):
            kind = f"array<{kind}>"
        nested = F.from_json("coordinates", kind, FAIL)
        for _ in range(3 - depth):
            nested = F.array(nested)
        return nested

    polygons = F.lit(None)
    for name, depth in GEOMETRY_DEPTHS.items():
        polygons = F.when(F.col("type") == name, coordinates(depth)).otherwise(polygons)
    known = F.col("type").isNull() | F.col("type").isin(*GEOMETRY_DEPTHS)
    unknown = F.raise_error(F.concat(F.lit("geometry of type "), "type")).cast("array<array<array<array<double>>>>")
    return feature.select("code", "nom", "type", F.when(known, polygons).otherwise(unknown).alias("polygons"))
