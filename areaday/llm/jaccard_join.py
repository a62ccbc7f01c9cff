"""Documents whose sets of word shingles have a Jaccard similarity of at least ``SHARE`` percent, and their components.

The search is for T-occurrence: a partner of a set must occur on enough of the inverted lists of its shingles. Since the
rarest shingles of a set come first in one global order, only the lists of its first ones need be gathered over all
documents; whoever shares none of these cannot reach the overlap. The candidates of a set are then searched for as a
block: short inverted lists are merged by a heap, and the long ones are probed by binary search for those that the merge
leaves over (DivideSkip). Documents that reach the overlap are linked.

Equal sets are one item, by a 64-bit hash of the set; shingles are compared by 64-bit hashes. Null and empty texts have
no shingles and are linked with nothing; a text of fewer words than a shingle is one shingle. Rows that repeat a
``doc_id`` count as one document. Components are named by their smallest ``doc_id``; null ids only name a component that
has no other. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaday.llm.common import SKETCH_BITS, add_blocks, blocks_of, bucket_counts, bucket_of, mixed, small_batches, whole_text
from areaday.llm.linking import Postings, Seen, levels, linked_components, shared_keys
from areaday.llm.words import hashes_of
from areaday.session import materialise

SHINGLE = 5
SHARE = 80
MARKS = 256
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                     0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingle_sets(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted hashes of the different shingles of each text, computed for all texts side by side."""
    numbers, ends = hashes_of(texts)
    whole = shingle_hashes(numbers, size) if len(numbers) >= size else np.empty(0, np.uint64)
    sets, start = [], 0
    for end in ends.tolist():
        count = end - start
        if count >= size:
            found = np.sort(whole[start : end - size + 1])
            sets.append(found[np.concatenate(([True], found[1:] != found[:-1]))])
        else:  # all words are one shingle
            sets.append(shingle_hashes(numbers[start:end], count) if count else np.empty(0, np.uint64))
        start = end
    return sets


def shingle_hashes(numbers: np.ndarray, width: int) -> np.ndarray:
    """The hash of each stretch of ``width`` word hashes."""
    n = len(numbers) - width + 1
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total += mixed(numbers[i : n + i] * _FACTORS[i % 8] + np.uint64(i))
    return mixed(total)


def item_of(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes())


def least_overlap(n: int, m: int, share: int) -> int:
    """The smallest intersection at which sets of these sizes are linked: 100 i >= share * (n + m - i)."""
    return -(-share * (n + m) // (100 + share))


def largest_partner(n: int, overlap: np.ndarray, share: int) -> np.ndarray:
    """The largest size of a set that a set of ``n`` can be linked with if they share ``overlap`` at most."""
    return (100 + share) * overlap // share - n


def prefix(shingles: np.ndarray, level: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles by which partners are found, rarest first, and the largest partner for whom each can be the first.

    From the place of a shingle on, at most the rest of the set can be shared.
    """
    levels, n = level[bucket_of(shingles)], len(shingles)
    ordered = shingles[np.argsort(levels, kind="stable")] if levels.any() else shingles
    most = largest_partner(n, n - np.arange(n), share)
    kept = most >= -(-share * n // 100)
    return ordered[kept], most[kept]


def documents_and_sketch(docs: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """``doc_id, n_shingles, item, mark`` of all rows (item is null for empty sets), and a count sketch of all shingles."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        names = ["doc_id", "n_shingles", "item", "mark", "block", "counts"]
        for frame in frames:
            sets = shingle_sets(frame.column("text").to_pylist(), size)
            if sets:
                counts += bucket_counts(np.concatenate(sets))
            items = np.array([item_of(s) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
            empty = np.array([not len(s) for s in sets], bool)
            none = pa.nulls(len(sets), pa.int64())
            yield pa.record_batch(
                [frame.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(items, mask=empty),
                 pa.array([mark_of(s) for s in sets], pa.binary()), none, pa.nulls(len(sets), pa.binary())], names=names,
            )
        none, no_mark = pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())
        for block, part in blocks_of(counts):
            yield pa.record_batch([none, none, none, no_mark, pa.array([block]), pa.array([part])], names=names)

    rows = docs.mapInArrow(run, "doc_id long, n_shingles long, item long, mark binary, block long, counts binary")
    written = materialise(rows)
    blocks = written.filter("block IS NOT NULL").select("block", "counts")
    return written.filter("block IS NULL").select("doc_id", "n_shingles", "item", "mark"), add_blocks(blocks, 1 << SKETCH_BITS)


def postings(share: int, size: int) -> Callable[[list[str], Seen, np.ndarray], Postings]:
    """The prefix postings of texts: ``a`` is the size of the set, ``b`` the largest partner."""
    def post(texts: list[str], seen: Seen, level: np.ndarray) -> Postings:
        keys, items, sizes, most = [], [], [], []
        for shingles in shingle_sets(texts, size):
            if len(shingles) and seen.new(item := item_of(shingles)):
                first, largest = prefix(shingles, level, share)
                keys.append(first)
                most.append(largest)
                items.append(np.full(len(first), item, np.uint64))
                sizes.append(np.full(len(first), len(shingles)))
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
        return {"key": join(keys, np.uint64), "item": join(items, np.uint64), "a": join(sizes, np.int32), "b": join(most, np.int32)}

    return post


def sets_of(size: int) -> Callable[[list[str]], Iterator[tuple[int, Callable[[], bytes]]]]:
    """The item of each text, and its set as bytes."""
    def content(texts: list[str]) -> Iterator[tuple[int, Callable[[], bytes]]]:
        for shingles in shingle_sets(texts, size):
            if len(shingles):
                yield item_of(shingles), shingles.tobytes

    return content


def mark_of(shingles: np.ndarray) -> bytes:
    """How many shingles fall in each of ``MARKS`` parts of the hash space; empty if a count is above 255."""
    counts = np.bincount((shingles & np.uint64(MARKS - 1)).astype(np.int64), minlength=MARKS)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def may_reach(share: int) -> Callable[[bytes, list[bytes]], np.ndarray]:
    """Whether the marks leave room for the overlap: no more can be shared in a part than the smaller count."""

    def check(one: bytes, others: list[bytes]) -> np.ndarray:
        known = np.array([len(other) == MARKS for other in others])
        if not len(one) or not known.any():
            return np.ones(len(others), bool)
        query = np.frombuffer(one, np.uint8).astype(np.int64)
        block = np.frombuffer(b"".join(other for other in others if len(other)), np.uint8).reshape(-1, MARKS).astype(np.int64)
        passed = np.ones(len(others), bool)
        passed[known] = np.minimum(query, block).sum(axis=1) >= least_overlap(query.sum(), block.sum(axis=1), share)
        return passed

    return check


#: Weight of the binary searches against the merge when lists are divided.
_PROBE_COST = 0.0085


def divide_skip(query: np.ndarray, block: list[np.ndarray], needed: list[int]) -> list[bool]:
    """Which sets of ``block`` share at least ``needed`` members with ``query``; all sets are sorted."""
    owner = np.repeat(np.arange(len(block)), [len(s) for s in block])
    members = np.concatenate(block)
    at = np.searchsorted(query, members)
    held = query[np.minimum(at, len(query) - 1)] == members
    at, owner = at[held], owner[held]
    order = np.argsort(at, kind="stable")  # owners stay sorted within a list
    bounds = np.flatnonzero(np.concatenate(([True], np.diff(at[order]) != 0, [True]))) if len(order) else np.array([0])
    lists = [owner[order[s:e]].tolist() for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
    least = max(1, min(needed))
    if len(lists) < least:
        return [False] * len(block)
    lists.sort(key=len)
    long = min(least - 1, math.ceil(least / (_PROBE_COST * math.log2(len(lists[-1])) + 1)))
    short, probed = lists[: len(lists) - long], lists[len(lists) - long :]
    linked, run, times = [False] * len(block), -1, 0
    for candidate in heapq.merge(*short, (len(block),)):
        if candidate == run:
            times += 1
            continue
        if run >= 0 and times >= needed[run] - long:
            linked[run] = times + sum(_holds(list_, run) for list_ in probed) >= needed[run]
        run, times = candidate, 1
    return linked


def _holds(sorted_list: list[int], value: int) -> bool:
    place = bisect_left(sorted_list, value)
    return place < len(sorted_list) and sorted_list[place] == value


def reaches(share: int) -> Callable[[bytes, list[bytes]], list[bool]]:
    def check(one: bytes, others: list[bytes]) -> list[bool]:
        query, block = np.frombuffer(one, np.uint64), [np.frombuffer(other, np.uint64) for other in others]
        return divide_skip(query, block, [least_overlap(len(query), len(other), share) for other in block])

    return check


def jaccard_join(docs: DataFrame, share: int = SHARE, size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    small_batches(docs.sparkSession)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    rows, counts = documents_and_sketch(texts, size)
    level = levels(counts)
    lists = shared_keys(texts.select("text"), postings(share, size), level)

    def admits(x: str, y: str):
        return (F.col(f"{x}.a") <= F.col(f"{y}.b")) & (F.col(f"{y}.a") <= F.col(f"{x}.b"))

    # The set with the most room for partners is the likeliest to be linked with all others of a list.
    room = F.col("a") - F.col("b")
    marks = materialise(rows.filter("item IS NOT NULL").groupBy("item").agg(F.any_value("mark").alias("content")))
    found = linked_components(
        texts.select("text"), lists, admits, room, sets_of(size), reaches(share), screen=(marks, may_reach(share))
    )
    classes = rows.join(found, "item", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "item").alias("class")
    )
    classes = materialise(classes)
    names = materialise(classes.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("name")))
    return classes.join(names, "class", "left").select(
        "doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("name")).alias("component_id")
    )
