"""Documents that cannot be read are put aside with the reason, and the others are read."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from areaday.session import new_path

EMPTY, MALFORMED, NO_LIST, OTHER_TYPE = "empty", "malformed", "no list", "value of another type"
_CORRUPT = "_corrupt_record"


class Counts(NamedTuple):
    documents: int
    quarantined: int
    elements: int


@dataclass
class Quarantine:
    """A folder for documents that cannot be read, and the counts of each source that was read with it.

    The documents of a source are in ``path/source=<name>``, with ``document`` (the path of the file), ``text`` and
    ``reason``. Reading a source again replaces them.
    """

    path: str
    counts: dict[str, Counts] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("document string, text string, reason string, source string").parquet(self.path)


def checked(text: Column, schema: str, key: str | None) -> tuple[Column, Column]:
    """The list of a JSON document (below ``key``, or all of it), and why it cannot be read: null where it can."""
    # A document that is a list becomes a field, as only objects can say that a value has another type.
    whole = F.concat(F.lit('{"document":'), text, F.lit("}")) if key is None else text
    kind = StructType.fromDDL(schema)
    name = key or "document"
    parsed = F.from_json(
        whole,
        StructType.fromDDL(f"document array<{kind.simpleString()}>" if key is None else schema).add(_CORRUPT, StringType()),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )
    document = F.try_parse_json(text)
    at = document if key is None else F.try_variant_get(document, f"$.{key}", "variant")
    is_list = F.coalesce(F.schema_of_variant(at).startswith("ARRAY"), F.lit(False))
    reason = (
        F.when(F.trim(F.regexp_replace(text, r"\s+", " ")) == "", EMPTY)
        .when(document.isNull(), MALFORMED)
        .when(~is_list, NO_LIST)
        .when(parsed[_CORRUPT].isNotNull() | parsed[name].isNull() | F.exists(parsed[name], lambda x: x.isNull()), OTHER_TYPE)
    )
    return parsed[name], reason


def readable_elements(
    spark: SparkSession, path: str, schema: str, key: str | None, multi_line: bool, quarantine: Quarantine, name: str
) -> DataFrame:
    """The objects of the lists in the readable documents as column ``r``; the other documents go to ``quarantine``.

    A document is a file with ``multi_line`` and a line otherwise. It is one value of one task, so it has to be below
    2 GB; it is either read whole or put aside whole. Spark lists no files of 0 bytes, so these are no documents. One
    pass parses, counts and writes both kinds.
    """
    documents = spark.read.text(path, wholetext=multi_line).select(
        F.col("_metadata.file_path").alias("document"), F.col("value").alias("text")
    )
    found, reason = checked(F.col("text"), schema, key)
    parsed = documents.withColumn("reason", reason).select(
        "document",
        F.when(F.col("reason").isNotNull(), F.col("text")).alias("text"),
        "reason",
        F.when(F.col("reason").isNull(), found).alias("found"),
        F.col("reason").isNotNull().alias("aside"),
    )
    seen = Observation()
    counts = parsed.observe(
        seen,
        F.count("*").alias("documents"),
        F.count("reason").alias("quarantined"),
        F.coalesce(F.sum(F.size("found")), F.lit(0)).alias("elements"),
    )
    written = new_path(spark, "checked")
    counts.write.partitionBy("aside").parquet(written)
    quarantine.counts[name] = Counts(**seen.get)
    table = spark.read.schema(parsed.schema).parquet(written)
    aside = table.filter("aside").select("document", "text", "reason")
    aside.write.mode("overwrite").parquet(f"{quarantine.path}/source={name}")
    return table.filter("not aside").select(F.explode("found").alias("r"))
