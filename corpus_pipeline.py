"""A corpus for training in five stages: toxicity, line dedup, near duplicates, decontamination, packing.

Every stage reads what the one before has kept, as a Parquet table, and all but the last return the columns of
``documents``. Null texts count as empty throughout; no stage drops a document for that. Extra columns are handed on. Rows
that repeat a ``doc_id`` or have none are documents of their own, except that line dedup reads rows with one id and one text
as copies of one document and leaves their lines; near duplicates then keep one of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaday.llm import toxicity as tox
from areaday.llm.common import table
from areaday.llm.decontamination import contaminated, contamination, hit_words
from areaday.llm.jaccard_join import jaccard_join
from areaday.llm.line_dedup import line_dedup
from areaday.llm.packing import pack_documents
from areaday.session import materialise

TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    model = tox.train(docs, table(spark, sf_dir, "labels"))
    return tox.toxicity(docs, model, tuple(docs.columns)).filter(~tox.rejected(F.col("score"))).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; those of which nothing else is left go. ``n_chars`` follows the text."""
    cut = line_dedup(docs, tuple(docs.columns))
    kept = cut.filter((F.size("removed") == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    changed = F.size("removed") > 0
    replaced = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return kept.select(
        *[
            F.when(changed, replaced[name]).otherwise(F.col(f"row.`{name}`")).alias(name)
            if name in replaced
            else F.col(f"row.`{name}`").alias(name)
            for name in docs.columns
        ]
    )


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by a Jaccard similarity of 0.8 or more, the one with the smallest ``doc_id``.

    Each row is a document of its own here, by a number that it gets: of rows that repeat an id, or have none, one stays of
    each group as well. A null ``doc_id`` stays only where its group has no other.
    """
    rows = materialise(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("number")))
    found = jaccard_join(rows.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text")))
    several = found.join(materialise(found.groupBy("component_id").count().filter("count > 1")), "component_id")
    member = rows.select(F.col("row.doc_id").alias("id"), F.col("number").alias("doc_id")).join(several, "doc_id")
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("doc_id"))
    stays = member.groupBy("component_id").agg(F.min_by("doc_id", order).alias("stays"))
    gone = several.join(materialise(stays), "component_id").filter(F.col("doc_id") != F.col("stays"))
    return rows.join(materialise(gone.select(F.col("doc_id").alias("number"))), "number", "left_anti").select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark passage."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"), tuple(docs.columns))
    return found.filter(~contaminated(hit_words(), F.col("n_words"))).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: A classifier, an edit join and a packing are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
