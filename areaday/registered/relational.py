"""Joins, aggregates, rankings, set operations and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from areaday import schemas
from areaday.fixed import ROWS_FOR_TRAINING
from areaday.ml import features
from areaday.ml.training import at_threshold, days_by_commune
from areaday.operators import aggregates, evaluation, joins, ranking
from areaday.plans import catalogue, map_layer
from areaday.registered import given
from areaday.session import materialise, new_path
from areaday.sinks.files import write_csv
from areaday.sources import files
from areaday.sources.files import files_by_year as by_year
from areaday.sources.files import recent_files as latest

# The day of the map, and the number of rows of a preview.
DAY = (1998, 10, 3)
PREVIEW = 5


def filter_eq(spark, sf):
    return given.accidents(spark, sf).filter(F.col("dep") == given.DEPARTMENT)


def filter_day(spark, sf):
    return map_layer.of_day(given.dated_predictions(spark, sf), *DAY)


def rename_select_constant(spark, sf):
    customer = given.table(spark, sf, "customer").withColumnsRenamed({"c_custkey": "com", "c_acctbal": "population"})
    constant = schemas.drop_strict(customer, "c_mktsegment").withColumn("dep", F.lit(77))
    return schemas.conform(constant.drop("c_nationkey", "not_there"), ["com", "c_name", "population", "dep"])


def conditional_labels(spark, sf):
    rows = given.dated_predictions(spark, sf)
    return rows.select(
        "id",
        map_layer.yes_no(F.col("jour_ferie")).alias("holiday"),
        map_layer.colour(F.col("accident") == 1).alias("colour"),
    )


def flag_casts(spark, sf):
    flagged = given.table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").alias("done"), (F.col("o_totalprice") > 200000).alias("large")
    )
    return features.integers_as_double(features.flags_as_int(flagged, ["done", "large"]))


def columns_by_type(spark, sf):
    customer = given.table(spark, sf, "customer").withColumn("rich", F.col("c_acctbal") > 5000)
    sums = [F.sum(F.col(c).cast("decimal(20,2)")).cast("double").alias(f"sum_{c}") for c in features.numeric_columns(customer)]
    kinds = [F.count_distinct(c).alias(f"kinds_{c}") for c in features.other_columns(customer)]
    return customer.agg(*sums, *kinds)


def commune_lookup(spark, sf):
    population = given.communes(spark, sf).select("com", "population")
    return given.accidents(spark, sf).select("Num_Acc", "com").join(population, "com", "left")


def null_safe_left_join(spark, sf):
    documents, labels = given.table(spark, sf, "documents"), given.table(spark, sf, "labels")
    quality = documents.join(labels, "doc_id", "left").select("doc_id", "lang", "quality")
    names = quality.groupBy("quality").agg(F.count(F.lit(1)).alias("documents"))
    return joins.left_join(quality, materialise(names), ["quality"])


def membership_flag(spark, sf):
    urgent = given.table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")
    return joins.membership_flag(given.table(spark, sf, "customer").select("c_custkey"), urgent, "c_custkey", "urgent")


def anti_new_files(spark, sf):
    names = given.file_names(spark, sf).distinct()
    stored = names.filter(F.col("name").contains("_en_"))
    return joins.not_in_store(names, stored, "name")


def first_seen_index(spark, sf):
    return ranking.first_seen_index(given.table(spark, sf, "orders"), "o_custkey", "o_orderkey")


def dim_lookup(spark, sf):
    orders = given.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    mapping = materialise(ranking.first_seen_index(orders, "o_custkey", "o_orderkey"))
    return joins.lookup(orders, mapping, "o_custkey", "o_custkey", "id")


def stratified_split(spark, sf):
    orders = given.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return ranking.stratified_split(orders, "o_orderstatus", "o_orderkey")


def seeded_sample(spark, sf):
    return ranking.seeded_sample(given.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 5)


def top_k_desc(spark, sf):
    return ranking.latest_rows(given.accidents(spark, sf), ROWS_FOR_TRAINING, ["com", "Num_Acc"])


def first_rows(spark, sf):
    return ranking.first_rows(given.table(spark, sf, "customer"), ["c_custkey"], PREVIEW)


def recent_files(spark, sf):
    return latest(given.file_names(spark, sf).distinct())


def files_by_year(spark, sf):
    return by_year(given.file_names(spark, sf))


def files_per_year(spark, sf):
    return catalogue.files_per_year(given.file_names(spark, sf).distinct())


def incomplete_years(spark, sf):
    """All years have a file of every source and language; three files less make some years incomplete."""
    names = given.file_names(spark, sf).distinct()
    per_year = names.filter(F.col("name").rlike("_src(0|1|2|3)_en_|_src4_.*[02468][.]csv$"))
    return catalogue.incomplete_years(per_year)


def distinct_values(spark, sf):
    return aggregates.distinct_values(given.accidents(spark, sf), "an")


def value_counts(spark, sf):
    return aggregates.value_counts(given.predictions(spark, sf), "truth")


def document_labels(spark, sf):
    return given.table(spark, sf, "documents").join(given.table(spark, sf, "labels"), "doc_id", "left")


def null_profile(spark, sf):
    return aggregates.null_counts(document_labels(spark, sf))


def column_profile(spark, sf):
    return aggregates.column_profile(document_labels(spark, sf))


def collect_distinct(spark, sf):
    days = days_by_commune(given.dated_predictions(spark, sf))
    return days.select("com", F.array_join(F.col("day").cast("array<string>"), ",").alias("days"))


def class_ratio(spark, sf):
    return given.rounded(evaluation.class_ratio(given.predictions(spark, sf), "truth"))


def accuracy_f1(spark, sf):
    return given.rounded(evaluation.accuracy_f1(given.predictions(spark, sf), "truth", "prediction"))


def accuracy_weighted_f1(spark, sf):
    return given.rounded(evaluation.accuracy_weighted_f1(given.predictions(spark, sf), "truth", "prediction"))


def confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(given.predictions(spark, sf), "truth", "prediction")


def confusion_matrix_classes(spark, sf):
    """Ten true classes, and guesses that are off by up to two, so two classes are only guessed."""
    vectors = given.table(spark, sf, "embeddings")
    return evaluation.confusion_matrix(vectors.withColumn("guess", F.col("label") + F.col("vec_id") % 3), "label", "guess")


def last_wins(spark, sf):
    orders = given.table(spark, sf, "orders").withColumn("month_day", F.date_format("o_orderdate", "MM-dd"))
    return aggregates.last_wins(orders, "month_day", "o_orderpriority", F.col("o_orderkey"))


def bbox(spark, sf):
    vectors = given.table(spark, sf, "embeddings").select(F.col("embedding").cast("array<double>").alias("e"))
    return given.rounded(aggregates.bounding_box(vectors, F.slice("e", 1, 1), F.slice("e", 2, 1)))


def union_by_name(spark, sf):
    orders = given.table(spark, sf, "orders")
    old = orders.select(F.col("o_orderkey").alias("Num_Acc"), "o_orderstatus")
    new = orders.select("o_orderstatus", F.col("o_custkey").alias("Accident_Id"))
    both = files.read_union(spark, [write_csv(x, new_path(spark, "union"), sep=";") for x in (old, new)])
    return files.with_accident_id(both).select(F.col("id").cast("bigint").alias("id"), "o_orderstatus")


def union_same_columns(spark, sf):
    customer, supplier = given.table(spark, sf, "customer"), given.table(spark, sf, "supplier")
    first = customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("dep"))
    second = supplier.select(F.col("s_suppkey").alias("Accident_Id"), F.col("s_nationkey").alias("dep"))
    paths = [write_csv(x, new_path(spark, "same"), sep=";") for x in (first, second)]
    return files.read_same_columns(spark, paths, {"Accident_Id": "id"}).select(*[F.col(c).cast("bigint").alias(c) for c in first.columns])


def map_flags(spark, sf):
    communes = given.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("nom")
    )
    return map_layer.commune_flags(communes, map_layer.of_day(given.dated_predictions(spark, sf), *DAY))


def map_flags_predicted(spark, sf):
    communes = given.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("nom")
    )
    return map_layer.commune_flags(communes, map_layer.of_day(given.dated_predictions(spark, sf), *DAY), True)


def day_summary(spark, sf):
    day_rows = map_layer.of_day(given.dated_predictions(spark, sf), *DAY)
    return map_layer.day_summary(day_rows, ["jour_ferie"], ["id"])


def binary_label(spark, sf):
    per_customer = given.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n")
    )
    return features.binary_label(per_customer, "n", "label")


def class_weight(spark, sf):
    rows = given.dated_predictions(spark, sf).select("id", "accident")
    ratio = evaluation.class_ratio(rows, "accident").first().ratio
    return given.rounded(features.class_weight(rows, "accident", ratio))


def standardise(spark, sf):
    columns = ["o_totalprice"]
    orders = given.table(spark, sf, "orders").select("o_orderkey", *columns)
    return given.rounded(features.standardise(orders, columns), 6)


def threshold_flag(spark, sf):
    lines = given.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 50).alias("score"))
    return lines.withColumn("predicted", at_threshold(F.col("score")))


FIRST_SEEN = "SELECT o_custkey, row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS id FROM orders GROUP BY 1"
DAY_ROWS = f"SELECT * FROM ({given.DATED_PREDICTIONS}) WHERE year = {DAY[0]} AND month = {DAY[1]} AND day = {DAY[2]}"
DOCUMENT_LABELS = "SELECT doc_id, text, lang, source, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)"
PROFILED = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"), ("quality", "int"), ("toxic", "int")]


def map_sql(rows: str) -> str:
    return f"""
SELECT code, nom, CAST(flag AS INTEGER) AS accident, CASE WHEN flag THEN '#8B0000' ELSE '#008000' END AS colour
FROM (SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS nom,
             CAST(c_custkey AS VARCHAR) IN (SELECT com FROM ({rows})) AS flag FROM customer)"""


def confusion_sql(rows: str) -> str:
    return f"""
WITH r AS ({rows}), k AS (SELECT t AS k FROM r UNION SELECT p FROM r)
SELECT CAST(a.k AS DOUBLE) AS truth, CAST(b.k AS DOUBLE) AS predicted,
       (SELECT count(*) FROM r WHERE t = a.k AND p = b.k) AS n FROM k a CROSS JOIN k b"""


QUERIES = {
    "filter_eq": (filter_eq, f"SELECT * FROM ({given.ACCIDENTS}) WHERE dep = '{given.DEPARTMENT}'"),
    "filter_day": (filter_day, DAY_ROWS),
    "rename_select_constant": (
        rename_select_constant,
        "SELECT c_custkey AS com, c_name, c_acctbal AS population, 77 AS dep FROM customer",
    ),
    "conditional_labels": (
        conditional_labels,
        f"""SELECT id, CASE WHEN jour_ferie = 1 THEN '✅ Oui' ELSE '❌ Non' END AS holiday,
                   CASE WHEN accident = 1 THEN '#8B0000' ELSE '#008000' END AS colour FROM ({given.DATED_PREDICTIONS})""",
    ),
    "flag_casts": (
        flag_casts,
        """SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, CAST(o_orderstatus = 'F' AS DOUBLE) AS done,
                  CAST(o_totalprice > 200000 AS DOUBLE) AS large FROM orders""",
    ),
    "columns_by_type": (
        columns_by_type,
        """SELECT CAST(sum(CAST(c_custkey AS DECIMAL(20,2))) AS DOUBLE) AS sum_c_custkey,
                  CAST(sum(CAST(c_nationkey AS DECIMAL(20,2))) AS DOUBLE) AS sum_c_nationkey,
                  CAST(sum(CAST(c_acctbal AS DECIMAL(20,2))) AS DOUBLE) AS sum_c_acctbal,
                  count(DISTINCT c_name) AS kinds_c_name, count(DISTINCT c_mktsegment) AS kinds_c_mktsegment,
                  count(DISTINCT c_acctbal > 5000) AS kinds_rich FROM customer""",
    ),
    "commune_lookup": (
        commune_lookup,
        f"""SELECT a.com, a.Num_Acc, c.population FROM ({given.ACCIDENTS}) a
            LEFT JOIN ({given.COMMUNES}) c ON c.com = a.com""",
    ),
    "null_safe_left_join": (
        null_safe_left_join,
        f"""WITH q AS (SELECT doc_id, lang, quality FROM ({DOCUMENT_LABELS}))
            SELECT q.*, n.documents FROM q
            LEFT JOIN (SELECT quality, count(*) AS documents FROM q GROUP BY 1) n
            ON q.quality IS NOT DISTINCT FROM n.quality""",
    ),
    "membership_flag": (
        membership_flag,
        """SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS urgent
           FROM customer""",
    ),
    "anti_new_files": (
        anti_new_files,
        f"SELECT DISTINCT name FROM ({given.FILES}) WHERE NOT contains(name, '_en_')",
    ),
    "first_seen_index": (first_seen_index, FIRST_SEEN),
    "dim_lookup": (
        dim_lookup,
        f"SELECT o_orderkey, m.id AS o_custkey FROM orders JOIN ({FIRST_SEEN}) m USING (o_custkey)",
    ),
    "stratified_split": (
        stratified_split,
        """SELECT o_orderkey, o_orderstatus,
                  row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '42'), o_orderkey)
                  <= ceil(0.2 * count(*) OVER (PARTITION BY o_orderstatus)) AS is_test FROM orders""",
    ),
    "seeded_sample": (
        seeded_sample,
        "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '42'), o_orderkey LIMIT 5",
    ),
    "top_k_desc": (
        top_k_desc,
        f"""SELECT * FROM ({given.ACCIDENTS}) ORDER BY an DESC NULLS FIRST, mois DESC NULLS FIRST,
            jour DESC NULLS FIRST, com, Num_Acc LIMIT 100""",
    ),
    "first_rows": (first_rows, f"SELECT * FROM customer ORDER BY c_custkey LIMIT {PREVIEW}"),
    "recent_files": (
        recent_files,
        f"""SELECT name, CAST(regexp_extract(name, 'car.*(\\d{{4}})', 1) AS INTEGER) AS year
            FROM (SELECT DISTINCT name FROM ({given.FILES})) ORDER BY year DESC, name LIMIT 2""",
    ),
    "files_by_year": (
        files_by_year,
        f"""SELECT year, name, count(*) OVER (PARTITION BY year) AS files_in_year
            FROM (SELECT DISTINCT name, CAST(regexp_extract(name, 'car.*(\\d{{4}})', 1) AS INTEGER) AS year
                  FROM ({given.FILES}))""",
    ),
    "files_per_year": (
        files_per_year,
        f"""SELECT split_part(split_part(name, '_', -1), '.', 1) AS year, count(DISTINCT name) AS files
            FROM ({given.FILES}) GROUP BY 1""",
    ),
    "incomplete_years": (
        incomplete_years,
        f"""SELECT split_part(split_part(name, '_', -1), '.', 1) AS year, count(DISTINCT name) AS files
            FROM ({given.FILES}) WHERE regexp_matches(name, '_src(0|1|2|3)_en_|_src4_.*[02468][.]csv$')
            GROUP BY 1 HAVING count(DISTINCT name) <> 4""",
    ),
    "distinct_values": (distinct_values, f"SELECT DISTINCT an FROM ({given.ACCIDENTS})"),
    "value_counts": (value_counts, 'SELECT quality AS truth, count(*) AS "count" FROM labels GROUP BY 1'),
    "null_profile": (
        null_profile,
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM ({DOCUMENT_LABELS})" for c, _ in PROFILED
        ),
    ),
    "column_profile": (
        column_profile,
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM ({DOCUMENT_LABELS})" for c, t in PROFILED
        ),
    ),
    "collect_distinct": (
        collect_distinct,
        f"""SELECT com, array_to_string(list_sort(list(DISTINCT day)), ',') AS days
            FROM ({given.DATED_PREDICTIONS}) WHERE accident = 1 GROUP BY 1""",
    ),
    "class_ratio": (
        class_ratio,
        """SELECT CAST(count_if(quality = 0) AS BIGINT) AS negatives, CAST(count_if(quality = 1) AS BIGINT) AS positives,
                  round(count_if(quality = 0) / count_if(quality = 1), 9) AS ratio FROM labels""",
    ),
    "accuracy_f1": (
        accuracy_f1,
        """SELECT round(avg(CAST(quality = toxic AS INTEGER)), 9) AS accuracy,
                  round(2 * count_if(quality = 1 AND toxic = 1)
                        / (2 * count_if(quality = 1 AND toxic = 1) + count_if((quality = 1) <> (toxic = 1))), 9) AS f1
           FROM labels""",
    ),
    "accuracy_weighted_f1": (
        accuracy_weighted_f1,
        """WITH per_class AS (
             SELECT k, (SELECT count(*) FROM labels WHERE quality = k) AS truths,
                    (SELECT count(*) FROM labels WHERE toxic = k) AS guesses,
                    (SELECT count(*) FROM labels WHERE quality = k AND toxic = k) AS hits
             FROM (SELECT unnest([0, 1]) AS k))
           SELECT round(sum(hits) / sum(truths), 9) AS accuracy,
                  round(sum(2 * hits / (truths + guesses) * truths) / sum(truths), 9) AS f1 FROM per_class""",
    ),
    "confusion_matrix": (
        confusion_matrix,
        confusion_sql("SELECT quality AS t, toxic AS p FROM labels"),
    ),
    "confusion_matrix_classes": (
        confusion_matrix_classes,
        confusion_sql("SELECT label AS t, label + vec_id % 3 AS p FROM embeddings"),
    ),
    "last_wins": (
        last_wins,
        """SELECT strftime(o_orderdate, '%m-%d') AS month_day, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority
           FROM orders GROUP BY 1""",
    ),
    "bbox": (
        bbox,
        """WITH p AS (SELECT CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)
           SELECT round(min(x), 9) AS min_x, round(min(y), 9) AS min_y, round(max(x), 9) AS max_x, round(max(y), 9) AS max_y,
                  round((min(x) + max(x)) / 2, 9) AS centre_x, round((min(y) + max(y)) / 2, 9) AS centre_y FROM p""",
    ),
    "union_by_name": (
        union_by_name,
        "SELECT o_orderkey AS id, o_orderstatus FROM orders UNION ALL SELECT o_custkey, o_orderstatus FROM orders",
    ),
    "union_same_columns": (
        union_same_columns,
        "SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS dep FROM customer UNION ALL SELECT s_suppkey, s_nationkey FROM supplier",
    ),
    "map_flags": (map_flags, map_sql(DAY_ROWS)),
    "map_flags_predicted": (map_flags_predicted, map_sql(f"SELECT * FROM ({DAY_ROWS}) WHERE accident = 1")),
    "day_summary": (
        day_summary,
        f"""SELECT * REPLACE (CASE WHEN jour_ferie = 1 THEN '✅ Oui' ELSE '❌ Non' END AS jour_ferie)
            FROM ({DAY_ROWS}) ORDER BY id LIMIT 1""",
    ),
    "binary_label": (
        binary_label,
        """SELECT o_custkey, n, CASE WHEN n <> 0 THEN 1 ELSE 0 END AS label
           FROM (SELECT o_custkey, CAST(count_if(o_orderpriority = '1-URGENT') AS BIGINT) AS n FROM orders GROUP BY 1)""",
    ),
    "class_weight": (
        class_weight,
        f"""WITH p AS (SELECT id, accident FROM ({given.DATED_PREDICTIONS}))
            SELECT id, accident, CASE WHEN accident = 1
                   THEN round((SELECT count_if(accident = 0) / count_if(accident = 1) FROM p), 9) ELSE 1.0 END AS weight
            FROM p""",
    ),
    "standardise": (
        standardise,
        """SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM orders))
                  / (SELECT stddev_pop(o_totalprice) FROM orders), 6) AS o_totalprice FROM orders""",
    ),
    "threshold_flag": (
        threshold_flag,
        """SELECT l_orderkey, l_linenumber, l_quantity / 50 AS score, CASE WHEN l_quantity / 50 >= 0.8 THEN 1 ELSE 0 END
                  AS predicted FROM lineitem""",
    ),
}
