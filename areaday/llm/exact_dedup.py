"""Exact duplicates by an extendible-hash index on shared files.

The 64-bit hash of a text is its key. A directory maps the top bits of a key to a bucket. It starts with one bucket; a
bucket of more than ``capacity`` keys is split by one more bit, which doubles the directory where it needs to be deeper.
Owner tasks take ranges of buckets and write them, sorted by key, to the shared folder.

A key that one row has is an entry by itself. The texts of all other keys are compared by their bytes: equal ones become
one entry, and different texts of one key a chain. Rows then probe the index: the slot of the key tells the bucket, the
bucket has the key, and where its chain is longer than one, the row's bytes are compared with those in the chain. Where
the chain has one text, all rows of the key were found equal when they were put in. So only texts whose key repeats are
moved, and those are combined by each task first: a third of all rows being copies of one text costs one entry per task.

Only DataFrame functions run here. Null texts count as empty. Rows that repeat a ``doc_id`` are rows of their own and
share the decision; a null ``doc_id`` never stays where another of its group has an id, and otherwise ``keep_id`` is
null and ``kept`` is true. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from areaday.llm.common import lowered, whole_text
from areaday.session import materialise

CAPACITY = 50_000
KEY_BITS = 64
# Bits beyond those that buckets of equal size would need, up to which an overfull bucket is split.
SLACK_BITS = 6


def key_of(text: Column) -> Column:
    return F.xxhash64(text)


def top_bits(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of a key as a number."""
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned(key, KEY_BITS - depth)


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, the text as it is compared, and its key."""
    rows = docs.select(docs["doc_id"].alias("doc_id"), lowered(whole_text(docs)).alias("norm"))
    return rows.withColumn("key", key_of(F.col("norm")))


def entries(docs: DataFrame) -> DataFrame:
    """One row per key: its number of rows, and their largest ``doc_id``."""
    return keyed(docs).groupBy("key").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))


def directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """The buckets ``(depth, prefix, n)`` of the different ``key`` of ``keys``, and the depth of the deepest.

    The keys are counted once, by the slots of the deepest directory that can come about. Summed up, the slots give the
    number of keys below every prefix, and doubling from depth 0 on is a rule on these numbers: a prefix is a bucket
    if its keys fit, or can be divided no further, and those of the prefix one bit shorter did not fit.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    total = keys.count()
    limit = min(KEY_BITS - 2, max(0, math.ceil(math.log2(max(total, 1) / capacity))) + SLACK_BITS)
    slots = materialise(keys.groupBy(top_bits(F.col("key"), limit).alias("slot")).agg(F.count("*").alias("n")))
    prefixes = (
        slots.select(F.explode(F.sequence(F.lit(0), F.lit(limit))).alias("depth"), "slot", "n")
        .groupBy("depth", F.expr(f"shiftright(slot, {limit} - depth)").alias("prefix"))
        .agg(F.sum("n").alias("n"))
    )
    prefixes = materialise(prefixes)
    split = prefixes.filter((F.col("n") > capacity) & (F.col("depth") < limit)).select("depth", "prefix")
    parent = split.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    below = prefixes.withColumn("parent", F.shiftright("prefix", 1)).join(parent, ["depth", "parent"], "left_semi")
    buckets = (
        prefixes.filter("depth = 0").unionByName(below.drop("parent")).join(split, ["depth", "prefix"], "left_anti")
    )
    buckets = materialise(buckets.select("depth", "prefix", "n"))
    return buckets, buckets.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]


def slots_of(buckets: DataFrame, depth: int) -> DataFrame:
    """``slot, bucket`` of a directory of ``depth`` bits: a bucket of a lower depth owns several slots.

    A bucket's number is the first of its slots, so that buckets are in the order of their keys' bits.
    """
    first = F.expr(f"shiftleft(prefix, {depth} - depth)")
    after = F.expr(f"shiftleft(prefix + 1, {depth} - depth)")
    return materialise(buckets.select(first.alias("bucket"), F.explode(F.sequence(first, after - 1)).alias("slot")))


def in_buckets(rows: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """``rows`` with the bucket of their key; a directory of depth 0 has one."""
    if depth == 0:
        return rows.withColumn("bucket", F.lit(0).cast("long"))
    return rows.withColumn("slot", top_bits(F.col("key"), depth)).join(slots, "slot").drop("slot")


def index(docs: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame, int]:
    """The index, the slots of its directory, and the directory's depth, all written to the shared folder.

    The index has ``bucket, key, chain, texts, norm, keep_id, group_size``: ``texts`` is the number of different texts of
    a key, ``chain`` the place among them, from 0, and ``norm`` the text where there are several.
    """
    found = materialise(entries(docs))
    buckets, depth = directory(found, capacity)
    slots = slots_of(buckets, depth)
    # Written, so that Spark knows the size of either part.
    shared = materialise(found.filter("group_size > 1").select("key"))
    compared = (
        keyed(docs)
        .join(shared, "key", "left_semi")
        .groupBy("key", "norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    chain = Window.partitionBy("key")
    chained = compared.withColumn("texts", F.count("*").over(chain)).withColumn(
        "chain", F.row_number().over(chain.orderBy("norm")) - 1
    )
    chained = chained.withColumn("norm", F.when(F.col("texts") > 1, F.col("norm")))
    alone = found.filter("group_size = 1").select(
        "*", F.lit(0).alias("chain"), F.lit(1).cast("long").alias("texts"), F.lit(None).cast("string").alias("norm")
    )
    owned = in_buckets(alone.unionByName(chained), slots, depth).repartitionByRange("bucket", "key")
    columns = ["bucket", "key", "chain", "texts", "norm", "keep_id", "group_size"]
    return materialise(owned.sortWithinPartitions("bucket", "key", "chain").select(columns)), slots, depth


def probe(docs: DataFrame, found: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """``doc_id, keep_id, group_size, text_sha256`` of each row by the index: slot, bucket, key, and bytes in a chain."""
    digest = F.sha2("norm", 256).alias("text_sha256")
    result = ["doc_id", "keep_id", "group_size", "text_sha256"]
    rows = in_buckets(keyed(docs).select("doc_id", "key", digest), slots, depth)
    by_key = rows.join(found.filter("texts = 1").drop("norm"), ["bucket", "key"]).select(result)
    chains = materialise(found.filter("texts > 1"))
    if chains.isEmpty():
        return by_key
    rows = in_buckets(keyed(docs).withColumn("text_sha256", F.sha2("norm", 256)), slots, depth)
    return by_key.unionByName(rows.join(chains, ["bucket", "key", "norm"]).select(result))


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """For each row: ``doc_id, keep_id, group_size, kept, text_sha256``; the largest ``doc_id`` of equal texts stays."""
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    found = probe(docs, *index(docs, capacity))
    return found.select("doc_id", "keep_id", "group_size", kept, "text_sha256")
