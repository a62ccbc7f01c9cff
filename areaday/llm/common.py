"""What several of the text operators share: texts, tables, batches, folds, sketches."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areaday.session import materialise

BATCH_ROWS = 1000
BATCH_BYTES = "16m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of bounded rows and bytes, so that long texts fit a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def whole_text(docs: DataFrame) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def lowered(text: Column) -> Column:
    """``text`` with A-Z lowered and nothing else; ``lower`` does the same on ASCII, and faster."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def fold(doc_id: Column, folds: int) -> Column:
    """The crc32 of the id as text, modulo ``folds``; null ids belong to fold 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")


def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Arrow batches as dictionaries of Python lists."""
    for frame in frames:
        yield {name: frame.column(i).to_pylist() for i, name in enumerate(frame.schema.names)}


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """An Arrow batch with the columns of ``schema`` in its order."""
    return pa.record_batch([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def carried(docs: DataFrame, keep: tuple[str, ...], **others: Column) -> DataFrame:
    """``row``, a struct of the columns to keep, the whole ``text``, and ``others``: no added column can clash with theirs."""
    named = [column.alias(name) for name, column in others.items()]
    return docs.select(F.struct(*[docs[name].alias(name) for name in keep]).alias("row"), whole_text(docs).alias("text"), *named)


def row_type(docs: DataFrame, keep: tuple[str, ...]) -> str:
    return f"struct<{', '.join(f'`{name}`: {docs.schema[name].dataType.simpleString()}' for name in keep)}>"


SKETCH_BITS = 20
_BLOCK = 1 << 14


def summed(frame: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int, kind=np.int64) -> np.ndarray:
    """The sum over all tasks of the array of ``size`` 64-bit numbers that ``count`` makes of a task's batches.

    Spark sums blocks of the arrays, so what reaches the driver has a fixed size whatever the input.
    """

    def emit(frames):
        counts = count(frames).astype(kind)
        for block, part in blocks_of(counts):
            yield pa.record_batch([pa.array([block]), pa.array([part])], names=["block", "counts"])

    return add_blocks(frame.mapInArrow(emit, "block long, counts binary"), size, kind)


def blocks_of(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The first place and the bytes of every part of an array that is not all 0."""
    for block in range(0, len(counts), _BLOCK):
        part = counts[block : block + _BLOCK]
        if part.any():
            yield block, part.tobytes()


def add_blocks(blocks: DataFrame, size: int, kind=np.int64) -> np.ndarray:
    """The array whose parts ``blocks`` holds: rows of ``block`` and ``counts``, as ``blocks_of`` gives them."""

    def add(frames):
        total: dict[int, np.ndarray] = {}
        for columns in batches(frames):
            for block, counts in zip(columns["block"], columns["counts"], strict=True):
                part = np.frombuffer(counts, kind)
                total[block] = total[block] + part if block in total else part
        if total:
            yield pa.record_batch([pa.array(list(total)), pa.array([x.tobytes() for x in total.values()])], names=["block", "counts"])

    whole = np.zeros(size, kind)
    dealt = blocks.repartition(max(1, min(64, size // _BLOCK)), "block")
    for row in dealt.mapInArrow(add, "block long, counts binary").collect():
        part = np.frombuffer(row["counts"], kind)
        whole[row["block"] : row["block"] + len(part)] = part
    return whole


def mixed(numbers: np.ndarray) -> np.ndarray:
    """64-bit numbers with all bits spread."""
    numbers = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return numbers ^ (numbers >> np.uint64(29))


def bucket_of(hashes: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def bucket_counts(hashes: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """How many of the 64-bit numbers fall in each of 2^``bits`` buckets."""
    return np.bincount(bucket_of(hashes, bits), minlength=1 << bits)


def sketch(numbers: DataFrame, bits: int = SKETCH_BITS) -> np.ndarray:
    """``bucket_counts`` of the one long column of ``numbers``."""

    def count(frames):
        counts = np.zeros(1 << bits, np.int64)
        for frame in frames:
            np.add.at(counts, bucket_of(frame.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits), 1)
        return counts

    return summed(numbers, count, 1 << bits)


def labelled(docs: DataFrame, labels: DataFrame, label: str, limit: int, folds: int = 4, held: int = 2) -> DataFrame:
    """``text, label`` of about ``limit`` labelled documents at most, spread by a hash of the id, without fold ``held``.

    Rows without an id or a label count as not labelled; a document is 1 if any of its labels is.
    """
    known = (
        labels.filter(labels["doc_id"].isNotNull() & labels[label].isNotNull() & (fold(labels["doc_id"], folds) != held))
        .groupBy("doc_id")
        .agg(F.max(labels[label].cast("int")).alias("label"))
    )
    share = min(1.0, limit / max(1, known.count()))
    # The hash as a number from 0 to 1; the sample is broadcast, its size follows from the limit.
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    texts = docs.select(docs["doc_id"].alias("doc_id"), whole_text(docs).alias("text"))
    chosen = texts.join(F.broadcast(known.filter(place < share)), "doc_id")
    return materialise(chosen.select("text", "label"))
