"""Files and tables: what Spark writes from the given tables is read back by the sources."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areaday import schemas
from areaday.fixed import ROWS_FOR_TRAINING
from areaday.functions.dates import date_of_parts
from areaday.ml.training import days_by_commune
from areaday.operators.ranking import first_seen_index, latest_rows_by_year
from areaday.plans import elt
from areaday.plans.catalogue import data_files
from areaday.plans.counts import accident_counts
from areaday.plans.map_layer import map_extent
from areaday.registered import given
from areaday.registered.panels import PANEL
from areaday.registered.relational import FIRST_SEEN
from areaday.registered.scalars import DATA_FILES, RESOURCES, resources
from areaday.session import new_path
from areaday.sinks import files as out
from areaday.sinks.tables import Audit, load, load_once
from areaday.sources import documents, files
from areaday.sources.quarantine import Quarantine

AUDIT = Audit(datetime(2025, 3, 8, 6, 30), "elt", "load_accidents")
#: About so many rows share a landed document.
DOCUMENT_ROWS = 1000
STRINGS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def landed_text(rows: DataFrame, text: Column, name: str) -> str:
    path = new_path(rows.sparkSession, name)
    rows.select(text.alias("value")).write.text(path)
    return path


def document_of(rows: DataFrame, least: int = 20) -> Column:
    """The document of a row by a hash: as many as ``DOCUMENT_ROWS`` rows each need, and ``least`` at least."""
    return F.pmod(F.xxhash64(*rows.columns), F.lit(max(least, -(-rows.count() // DOCUMENT_ROWS)))).alias("document")


def landed_documents(rows: DataFrame, element: Column, field: str | None, name: str, path: str | None = None) -> str:
    """A folder of JSON documents over several lines, each with several elements, in an array or under ``field``.

    The rows of a document are those of one value of a hash, of which there are more in larger tables, so that documents
    are small.
    """
    several = rows.groupBy(document_of(rows)).agg(F.collect_list(element).alias("found"))
    whole = F.struct(F.col("found").alias(field)) if field else F.col("found")
    pretty = F.regexp_replace(F.to_json(whole), r'\},\{"', '},\n {"')
    path = path or new_path(rows.sparkSession, name)
    several.select("document", pretty.alias("value")).repartition("document").write.partitionBy("document").text(path)
    return f"{path}/*"


def csv_strings_scan(spark, sf):
    path = new_path(spark, "strings")
    out.write_csv(given.table(spark, sf, "orders").select(*STRINGS), path, sep=";")
    return files.read_strings(spark, path)


def csv_text_round_trip(spark, sf):
    """All documents with their whole texts, which hold line breaks, commas and quotes."""
    documents = given.table(spark, sf, "documents")
    quoted = documents.withColumn("text", F.concat(F.lit('"Text", says:\n'), "text", F.lit(' "')))
    path = out.write_csv(quoted, new_path(spark, "texts"))
    return files.read_typed(spark, path, documents.schema, multi_line=True)


def csv_events_round_trip(spark, sf):
    """All events; their ``props`` are JSON and so hold quotes."""
    events = given.table(spark, sf, "events").drop("ts")
    return files.read_typed(spark, out.write_csv(events, new_path(spark, "events")), events.schema)


def csv_typed_scan(spark, sf):
    path = out.write_csv(given.weather_hourly(spark, sf), new_path(spark, "hourly"))
    return files.read_weather_hourly(spark, path)


def recent_files_counts(spark, sf):
    """Accident files by year, of which the two latest are read, united and counted."""
    folder = new_path(spark, "accidents")
    rows = given.accidents(spark, sf).withColumn("caracteristiques", F.col("an"))
    rows.write.partitionBy("caracteristiques").option("header", True).option("sep", ";").csv(folder)
    return accident_counts(files.read_accidents(spark, folder))


def listed_files(spark, sf):
    folder = new_path(spark, "listing")
    years = given.accidents(spark, sf).withColumn("car", F.col("an"))
    years.write.partitionBy("car").option("header", True).csv(folder)
    return files.with_year(files.list_files(spark, folder)).select("name", "year")


def catalogue_scan(spark, sf):
    rows = resources(spark, sf)
    missing = F.when(~F.col("title").startswith("Lieux"), F.col("title"))
    resource = F.struct(missing.alias("title"), "url", F.when(F.col("format") == "csv", F.col("format")).alias("format"))
    path = landed_documents(rows, resource, "resources", "catalogue")
    return documents.read_catalogue(spark, path)


def catalogue_scan_filter(spark, sf):
    """The resources in one document per line, several in each."""
    row = F.struct("title", "url", "format")
    rows = resources(spark, sf).select("title", "url", "format")
    documents_of = rows.groupBy(document_of(rows, 50)).agg(F.collect_list(row).alias("resources"))
    path = landed_text(documents_of, F.to_json(F.struct("resources")), "catalogue")
    return data_files(documents.read_catalogue(spark, path, multi_line=False))


def public_holidays_by_year(spark, sf):
    """One file per year with a map of its days; each day has the priority of its last order."""
    orders = given.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"), "o_orderpriority")
    last = orders.groupBy("date").agg(F.max_by("o_orderpriority", "o_orderkey").alias("name"))
    per_year = last.groupBy(F.year("date").alias("year")).agg(F.map_from_entries(F.collect_list(F.struct(F.date_format("date", "yyyy-MM-dd"), "name"))).alias("days"))
    folder = new_path(spark, "holidays")
    first, final = 1993, 1997
    for year in range(first - 1, final + 2):
        # The last day of a year is given again in the file of the next year, under another name: the later file wins.
        days = per_year.filter(F.col("year") == year).select(F.map_concat("days", F.create_map(F.lit(f"{year - 1}-12-31"), F.lit(f"again in {year}"))).alias("days"))
        days.coalesce(1).select(F.to_json("days").alias("value")).write.text(f"{folder}/{year}")
    return documents.read_public_holidays(spark, folder, first, final)


def elt_run(spark, sf):
    """All files of one department landed, turned into the training set, loaded, published, and read from there."""
    landing, audit = new_path(spark, "landing"), AUDIT
    rows = given.accidents(spark, sf).withColumn("caracteristiques", F.col("an"))
    rows.write.partitionBy("caracteristiques").options(header=True, sep=";").csv(f"{landing}/accidents")
    commune = F.struct(F.col("com").alias("nom"), F.col("dep").alias("codeRegion"), F.col("com").alias("code"), "population")
    landed_documents(given.communes(spark, sf, given.DEPARTMENT), commune, None, "communes", f"{landing}/communes")
    holidays = given.public_holidays(spark, sf).groupBy(F.year("date").alias("year")).agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct(F.date_format("date", "yyyy-MM-dd"), "public_holiday")))).alias("value")
    )
    years = [row.year for row in holidays.select("year").collect()]
    for year in years:
        holidays.filter(F.col("year") == year).select("value").coalesce(1).write.text(f"{landing}/public_holidays/{year}")
    landed_documents(given.school_holidays(spark, sf), school_record(), "records", "school", f"{landing}/school_holidays")
    out.write_csv(given.weather_hourly(spark, sf), f"{landing}/weather_history")
    table, published = table_name("elt"), new_path(spark, "published")
    elt.run(spark, landing, table, audit, given.DEPARTMENT, 2000, new_path(spark, "table"), n_files=7, publish=published)
    read = files.read_typed(spark, published, spark.table(table).schema)
    return given.rounded(read)


def school_record() -> Column:
    """A row of school holidays as the landed documents hold it."""
    year = F.year("start_date")
    iso = "yyyy-MM-dd'T'HH:mm:ssXXX"
    fields = F.struct(
        F.concat_ws("-", year.cast("string"), (year + 1).cast("string")).alias("annee_scolaire"),
        F.col("zone").alias("zones"),
        F.col("type").alias("description"),
        F.date_format("start_date", iso).alias("start_date"),
        F.date_format("end_date", iso).alias("end_date"),
    )
    return F.struct(fields.alias("fields"))


def json_map_last_wins(spark, sf):
    """One document per order: its date and priority. The order with the highest key wins a date."""
    orders = given.table(spark, sf, "orders").select(
        "o_orderkey",
        F.to_json(F.create_map(F.date_format("o_orderdate", "yyyy-MM-dd"), "o_orderpriority")).alias("document"),
    )
    return documents.holidays_of_maps(orders, "document", "o_orderkey")


def json_records_flatten(spark, sf):
    """One document per supplier: its range as a school holiday, in school years from 1995 to 2001."""
    path = landed_documents(given.school_holidays(spark, sf), school_record(), "records", "school")
    read = documents.read_school_holidays(spark, path, 2000)
    time = "yyyy-MM-dd HH:mm:ss"
    return read.withColumns({c: F.date_format(c, time) for c in ("start_date", "end_date")})


def commune_documents(spark: SparkSession, sf: str) -> str:
    code = F.col("c_custkey").cast("string")
    commune = F.struct(
        F.col("c_name").alias("nom"),
        F.col("c_nationkey").cast("string").alias("codeRegion"),
        code.alias("code"),
        F.floor("c_acctbal").cast("int").alias("population"),
        F.array(code, F.col("c_nationkey").cast("string")).alias("codesPostaux"),
    )
    return landed_documents(given.table(spark, sf, "customer"), commune, None, "communes")


def communes_scan(spark, sf):
    return documents.read_communes(spark, commune_documents(spark, sf))


def partly_broken_documents(spark: SparkSession, sf: str) -> str:
    """The customers as documents of ten communes each, one per line; four of each nine cannot be read, each in its way."""
    number = F.floor(F.col("c_custkey") / 10)
    population = F.when(number % 9 == 2, "many").otherwise(F.floor("c_acctbal").cast("string"))
    commune = F.format_string(
        '{"nom": "%s", "codeRegion": "%s", "code": "%s", "population": %s}',
        "c_name",
        "c_nationkey",
        "c_custkey",
        F.when(number % 9 == 2, F.concat(F.lit('"'), population, F.lit('"'))).otherwise(population),
    )
    several = given.table(spark, sf, "customer").groupBy(number.alias("number")).agg(F.collect_list(commune).alias("found"))
    whole = F.concat(F.lit("["), F.array_join("found", ", "), F.lit("]"))
    broken = (
        F.when(F.col("number") % 9 == 0, F.substring(whole, 1, 30))
        .when(F.col("number") % 9 == 1, F.concat(F.lit('{"message": '), whole, F.lit("}")))
        .when(F.col("number") % 9 == 3, F.lit("  "))
        .otherwise(whole)
    )
    return landed_text(several, broken, "communes")


def communes_readable(spark, sf):
    """The communes of the documents that can be read."""
    aside = Quarantine(new_path(spark, "quarantine"))
    return documents.read_communes(spark, partly_broken_documents(spark, sf), multi_line=False, quarantine=aside)


def quarantine_reasons(spark, sf):
    """The documents that cannot be read by reason, beside the counts of the pass that put them aside."""
    aside = Quarantine(new_path(spark, "quarantine"))
    documents.read_communes(spark, partly_broken_documents(spark, sf), multi_line=False, quarantine=aside)
    counts = [F.lit(value).cast("long").alias(f"all_{name}") for name, value in aside.counts["communes"]._asdict().items()]
    return aside.read(spark).groupBy("source", "reason").agg(F.count("*").alias("documents")).select("*", *counts)


def postal_codes(spark, sf):
    return documents.read_postal_codes(spark, commune_documents(spark, sf))


def html_rows(spark, sf):
    """One search result per customer: a table with a heading, one full row and one short one."""
    rows = F.concat(
        F.lit("<table><tr><th>Name</th></tr><tr class='x'><td> <a href='#'>"),
        F.col("c_name"),
        F.lit("</a>\n</td><td>R&amp;D &eacute;"),
        F.col("c_nationkey").cast("string"),
        F.lit("</td><td>"),
        F.col("c_mktsegment"),
        F.lit("</td></tr><tr><td>short</td></tr></table>"),
    )
    # to_json of the array gives ["..."]; the text between the brackets is the JSON string.
    quoted = F.regexp_replace(F.to_json(F.array(rows)), r"^\[|\]$", "")
    payload = F.concat(F.lit('[{"command":"settings"},{"data":{"a":1}},{"data":"  "},{"data":'), quoted, F.lit("}]"))
    path = landed_text(given.table(spark, sf, "customer"), payload, "html")
    return documents.fire_brigades(spark.read.text(path), "value")


def html_cells(spark, sf):
    """The list items of each whole page, joined by bars."""
    cells = F.regexp_extract_all("html", F.lit("(?s)<li[^>]*>(.*?)</li>"), 1)
    return given.table(spark, sf, "pages").select(
        "page_id", F.size(cells).alias("n"), F.array_join(cells, "|").alias("cells")
    )


def geojson(spark: SparkSession, sf: str) -> DataFrame:
    """One feature collection per customer, a triangle placed by key and balance, twice where the key is even."""
    x = (F.col("c_custkey") % 360 - 180).cast("double")
    y = F.col("c_acctbal") / 1000
    ring = F.array(F.array(x, y), F.array(x + 1, y), F.array(x, y + 1), F.array(x, y))
    polygon = F.to_json(F.array(ring))
    double = F.concat(F.lit("["), polygon, F.lit(","), polygon, F.lit("]"))
    even = F.col("c_custkey") % 2 == 0
    geometry = F.concat(
        F.lit('{"type":"'),
        F.when(even, "MultiPolygon").otherwise("Polygon"),
        F.lit('","coordinates":'),
        F.when(even, double).otherwise(polygon),
        F.lit("}"),
    )
    properties = F.to_json(F.struct(F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("nom")))
    document = F.concat(
        F.lit('{"type":"FeatureCollection","features":[{"properties":'),
        properties,
        F.lit(',"geometry":'),
        geometry,
        F.lit("}]}"),
    )
    path = landed_text(given.table(spark, sf, "customer"), document, "geojson")
    return documents.read_geojson(spark, path, multi_line=False)


def geojson_scan(spark, sf):
    return geojson(spark, sf).select(
        "code", "nom", F.col("type").alias("kind"), F.size(F.flatten(F.flatten("polygons"))).alias("points")
    )


def map_extent_of_features(spark, sf):
    return given.rounded(map_extent(geojson(spark, sf)))


def table_name(name: str) -> str:
    return f"areaday_{name}_{uuid.uuid4().hex}"


def load_replace(spark, sf):
    """Two loads of one table: the second replaces the first."""
    table, path = table_name("replace"), new_path(spark, "table")
    rows = given.accidents(spark, sf)
    load(rows.filter(F.col("dep") == given.DEPARTMENT), table, AUDIT, path=path)
    load(rows, table, AUDIT, path=path)
    return spark.table(table)


def load_append(spark, sf):
    """Two loads of one table: the second adds to the first, with a choice of columns."""
    table, path = table_name("append"), new_path(spark, "table")
    rows = given.accidents(spark, sf)
    for _ in range(2):
        load(rows, table, AUDIT, mode="append", columns=["Num_Acc", "com"], path=path)
    return spark.table(table)


def load_append_once(spark, sf):
    """A load that is run twice, the second time after one of another task: its rows are there once."""
    table, path = table_name("once"), new_path(spark, "table")
    rows = given.accidents(spark, sf)
    other = AUDIT._replace(task_id="load_again")
    for audit in (AUDIT, other, AUDIT):
        load_once(rows, table, audit, columns=["Num_Acc", "com"], path=path)
    return spark.table(table)


def load_metrics(spark, sf):
    result = load(given.accidents(spark, sf), table_name("metrics"), AUDIT, path=new_path(spark, "table"))
    return spark.createDataFrame([result], "rows_inserted BIGINT, execution_time STRING")


def table_scan_top(spark, sf):
    table = table_name("scan")
    load(given.accidents(spark, sf), table, AUDIT, path=new_path(spark, "table"), partition_by=["an"])
    return latest_rows_by_year(spark.table(table), ROWS_FOR_TRAINING, ["com", "Num_Acc"])


def publish_if_absent(spark, sf):
    """The second publication finds the first and leaves it."""
    path = new_path(spark, "published")
    orders = given.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    out.write_parquet(orders, path, mode="ignore")
    out.write_parquet(orders.limit(0), path, mode="ignore")
    return spark.read.parquet(path)


def publish_replace(spark, sf):
    path = new_path(spark, "published")
    customer = given.table(spark, sf, "customer").select("c_custkey", "c_name")
    out.write_csv(given.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), path)
    out.write_csv(customer, path)
    return files.read_typed(spark, path, "c_custkey BIGINT, c_name STRING")


def json_records(spark, sf):
    return out.json_records(given.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"))


def json_round_trip(spark, sf):
    orders = given.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return spark.read.schema(orders.schema).json(out.write_json(orders, new_path(spark, "json")))


def mapping_round_trip(spark, sf):
    mapping = first_seen_index(given.table(spark, sf, "orders"), "o_custkey", "o_orderkey")
    named = mapping.select(F.col("o_custkey").cast("string").alias("commune"), "id")
    path = out.write_csv(named, new_path(spark, "mapping"))
    return files.read_typed(spark, path, schemas.COMMUNE_MAPPING)


def predictions_round_trip(spark, sf):
    rows = given.dated_predictions(spark, sf)
    path = out.write_csv(rows, new_path(spark, "predictions"))
    return files.read_predictions(spark, path, rows.schema)


def days_by_commune_round_trip(spark, sf):
    days = days_by_commune(given.dated_predictions(spark, sf)).withColumn(
        "day", F.array_join(F.col("day").cast("array<string>"), " ")
    )
    path = out.write_csv(days, new_path(spark, "days"))
    return files.read_typed(spark, path, "com STRING, day STRING")


def landed_dates(spark, sf):
    """Dates through a file as text, built anew from their parts."""
    parts = given.accidents(spark, sf).select("Num_Acc", "jour", "mois", "an")
    path = out.write_csv(parts, new_path(spark, "dates"))
    read = files.read_strings(spark, path, ",")
    return read.select("Num_Acc", date_of_parts(F.col("an"), F.col("mois"), F.col("jour")).alias("date"))


AUDITED = "'2025-03-08 06:30:00' AS execution_date, 'elt' AS dag_id, 'load_accidents' AS task_id"
ORDERED = "an DESC NULLS FIRST, mois DESC NULLS FIRST, jour DESC NULLS FIRST, com, Num_Acc"

# The landed school holidays are read for the school years around 2000 only.
SOME_SCHOOL = f"SELECT * FROM ({given.SCHOOL}) WHERE year(start_date) BETWEEN 1996 AND 2001"
ELT_PANEL = PANEL.replace(given.SCHOOL, SOME_SCHOOL)

QUERIES = {
    "csv_strings_scan": (
        csv_strings_scan,
        "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in STRINGS) + " FROM orders",
    ),
    "csv_typed_scan": (csv_typed_scan, given.HOURLY),
    "csv_text_round_trip": (
        csv_text_round_trip,
        """SELECT doc_id, '"Text", says:' || chr(10) || text || ' "' AS text, lang, source, n_chars FROM documents""",
    ),
    "csv_events_round_trip": (csv_events_round_trip, "SELECT event_id, user_id, event_type, value, props FROM events"),
    "recent_files_counts": (
        recent_files_counts,
        f"SELECT * FROM ({given.COUNTS}) WHERE an > (SELECT max(an) - 2 FROM ({given.COUNTS}))",
    ),
    "listed_files": (
        listed_files,
        f"SELECT DISTINCT 'car=' || CAST(an AS VARCHAR) AS name, an AS year FROM ({given.ACCIDENTS})",
    ),
    "catalogue_scan": (
        catalogue_scan,
        f"""SELECT CASE WHEN starts_with(title, 'Lieux') THEN 'noname' ELSE title END AS title, url,
                   CASE WHEN format = 'csv' THEN format ELSE '' END AS format FROM ({RESOURCES})""",
    ),
    "catalogue_scan_filter": (catalogue_scan_filter, f"SELECT title, url, format, name FROM ({DATA_FILES})"),
    "public_holidays_by_year": (
        public_holidays_by_year,
        """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS date, arg_max(o_orderpriority, o_orderkey) AS name FROM orders GROUP BY 1),
                f AS (SELECT year(date) AS y, date, name FROM o UNION ALL
                      SELECT y, make_date(y - 1, 12, 31), 'again in ' || y FROM (SELECT DISTINCT CAST(year(date) AS INTEGER) AS y FROM o))
           SELECT date, arg_max(name, y) AS public_holiday FROM f WHERE y BETWEEN 1993 AND 1997 GROUP BY 1""",
    ),
    "elt_run": (
        elt_run,
        f"""WITH t AS (SELECT p.*, w.* EXCLUDE (date) FROM ({ELT_PANEL}) p LEFT JOIN ({given.DAILY}) w ON w.date = p.date)
            SELECT * REPLACE (CAST(jour AS INTEGER) AS jour), {AUDITED} FROM t""",
    ),
    "json_map_last_wins": (
        json_map_last_wins,
        """SELECT CAST(o_orderdate AS DATE) AS date, arg_max(o_orderpriority, o_orderkey) AS public_holiday
           FROM orders GROUP BY 1""",
    ),
    "json_records_flatten": (
        json_records_flatten,
        f"""SELECT zone, type, strftime(start_date, '%Y-%m-%d %H:%M:%S') AS start_date,
                   strftime(end_date, '%Y-%m-%d %H:%M:%S') AS end_date
            FROM ({given.SCHOOL}) WHERE year(start_date) BETWEEN 1996 AND 2001""",
    ),
    "communes_scan": (
        communes_scan,
        """SELECT c_name AS commune, CAST(c_nationkey AS VARCHAR) AS code_region, CAST(c_custkey AS VARCHAR) AS code,
                  CAST(floor(c_acctbal) AS INTEGER) AS population FROM customer""",
    ),
    "communes_readable": (
        communes_readable,
        """SELECT c_name AS commune, CAST(c_nationkey AS VARCHAR) AS code_region, CAST(c_custkey AS VARCHAR) AS code,
                  CAST(floor(c_acctbal) AS INTEGER) AS population FROM customer WHERE (c_custkey // 10) % 9 > 3""",
    ),
    "quarantine_reasons": (
        quarantine_reasons,
        """WITH d AS (SELECT c_custkey // 10 AS number, count(*) AS n FROM customer GROUP BY 1),
                totals AS (SELECT count(*) AS all_documents, count(*) FILTER (WHERE number % 9 < 4) AS all_quarantined,
                                  coalesce(sum(n) FILTER (WHERE number % 9 > 3), 0) AS all_elements FROM d)
           SELECT 'communes' AS source,
                  CASE number % 9 WHEN 0 THEN 'malformed' WHEN 1 THEN 'no list' WHEN 2 THEN 'value of another type'
                       ELSE 'empty' END AS reason, count(*) AS documents,
                  CAST(any_value(all_documents) AS BIGINT) AS all_documents,
                  CAST(any_value(all_quarantined) AS BIGINT) AS all_quarantined,
                  CAST(any_value(all_elements) AS BIGINT) AS all_elements
           FROM d, totals WHERE number % 9 < 4 GROUP BY ALL""",
    ),
    "postal_codes": (
        postal_codes,
        """SELECT c_name AS commune, CAST(c_custkey AS VARCHAR) || ', ' || CAST(c_nationkey AS VARCHAR) AS postal_codes
           FROM customer""",
    ),
    "html_rows": (
        html_rows,
        """SELECT c_name AS name, 'R&D é' || CAST(c_nationkey AS VARCHAR) AS city, c_mktsegment AS department
           FROM customer""",
    ),
    "html_cells": (
        html_cells,
        """SELECT page_id, CAST(len(c) AS INTEGER) AS n, array_to_string(c, '|') AS cells
           FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1) AS c FROM pages)""",
    ),
    "geojson_scan": (
        geojson_scan,
        """SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS nom,
                  CASE WHEN c_custkey % 2 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind,
                  CASE WHEN c_custkey % 2 = 0 THEN 8 ELSE 4 END AS points FROM customer""",
    ),
    "map_extent": (
        map_extent_of_features,
        """WITH p AS (SELECT CAST(c_custkey % 360 - 180 AS DOUBLE) AS x, c_acctbal / 1000 AS y FROM customer)
           SELECT round(min(x), 9) AS min_x, round(min(y), 9) AS min_y, round(max(x) + 1, 9) AS max_x,
                  round(max(y) + 1, 9) AS max_y, round((min(x) + max(x) + 1) / 2, 9) AS centre_x,
                  round((min(y) + max(y) + 1) / 2, 9) AS centre_y FROM p""",
    ),
    "load_replace": (load_replace, f"SELECT *, {AUDITED} FROM ({given.ACCIDENTS})"),
    "load_append": (
        load_append,
        f"SELECT Num_Acc, com, {AUDITED} FROM ({given.ACCIDENTS}) CROSS JOIN (SELECT unnest([1, 2]))",
    ),
    "load_append_once": (
        load_append_once,
        f"""SELECT * EXCLUDE (task) REPLACE (task AS task_id), 'elt/' || task || '/2025-03-08T06:30:00' AS load_id
            FROM (SELECT Num_Acc, com, {AUDITED} FROM ({given.ACCIDENTS}))
            CROSS JOIN (SELECT unnest(['load_accidents', 'load_again']) AS task)""",
    ),
    "load_metrics": (
        load_metrics,
        f"SELECT count(*) AS rows_inserted, '2025-03-08 06:30:00' AS execution_time FROM ({given.ACCIDENTS})",
    ),
    "table_scan_top": (
        table_scan_top,
        f"SELECT *, {AUDITED} FROM ({given.ACCIDENTS}) ORDER BY {ORDERED} LIMIT 100",
    ),
    "publish_if_absent": (publish_if_absent, "SELECT o_orderkey, o_custkey FROM orders"),
    "publish_replace": (publish_replace, "SELECT c_custkey, c_name FROM customer"),
    "json_records": (
        json_records,
        """SELECT CAST(to_json({'o_orderkey': o_orderkey, 'o_custkey': o_custkey, 'o_orderstatus': o_orderstatus})
                  AS VARCHAR) AS record FROM orders""",
    ),
    "json_round_trip": (json_round_trip, "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders"),
    "mapping_round_trip": (
        mapping_round_trip,
        f"SELECT CAST(o_custkey AS VARCHAR) AS commune, id FROM ({FIRST_SEEN})",
    ),
    "predictions_round_trip": (predictions_round_trip, given.DATED_PREDICTIONS),
    "days_by_commune": (
        days_by_commune_round_trip,
        f"""SELECT com, array_to_string(list_sort(list(DISTINCT day)), ' ') AS day
            FROM ({given.DATED_PREDICTIONS}) WHERE accident = 1 GROUP BY 1""",
    ),
    "landed_dates": (
        landed_dates,
        "SELECT CAST(o_orderkey AS VARCHAR) AS Num_Acc, CAST(o_orderdate AS DATE) AS date FROM orders",
    ),
}
