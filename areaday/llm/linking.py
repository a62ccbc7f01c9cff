"""Links between items that share keys, without all pairs of a key, and the components that the links make.

An item is the 64-bit hash of a distinct content, so copies are one item. Postings say which keys an item has; two items
can be linked only if they share a key and admit each other. Of each key one item is the pivot, and the others are
compared with it. That gives as many pairs as postings, and joins nearly all of a large group of similar items. What is
left are items of a key that are in another component than its pivot: each of these is then compared with all others of
the key outside its component. A link inside a component changes no component, so none that matters is lost.

Keys that a count sketch shows to be frequent are dealt out by item where keys with one item are dropped, so a hot key
never meets in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaday.llm.common import SKETCH_BITS, bucket_of, sketch
from areaday.session import materialise, wide_partitions

HOT = 200
#: Links that one task joins up; beyond them all tasks do it in rounds.
FEW_LINKS = 100_000
_SEEN = 500_000

Postings = dict[str, np.ndarray]  # key, item: uint64; a, b: int32


def levels(counts: np.ndarray) -> np.ndarray:
    """0 for buckets of a count sketch that hold no frequent key, and above that the more the more frequent."""
    mean = counts.sum() / len(counts)
    excess = counts - mean - 6 * np.sqrt(mean)
    return np.where(excess < HOT, 0, np.floor(np.log2(np.maximum(excess, HOT) / HOT)) + 1).astype(np.int8)


class Seen:
    """Items this task has met, up to a bound: copies within a task are handled once."""

    def __init__(self) -> None:
        self.items: set[int] = set()

    def new(self, item: int) -> bool:
        if item in self.items:
            return False
        if len(self.items) >= _SEEN:
            self.items.clear()
        self.items.add(item)
        return True


def _signed(numbers: np.ndarray) -> pa.Array:
    return pa.array(numbers.view(np.int64))


def _placed(key: np.ndarray, item: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Where a posting is sent: by its key, or by key and item if the key is hot. The same step leads back to the key."""
    return np.where(hot, key ^ (item * np.uint64(0x9E3779B97F4A7C15)), key)


def shared_keys(texts: DataFrame, post: Callable[[list[str], Seen, np.ndarray], Postings], level: np.ndarray) -> DataFrame:
    """``key, item, a, b``: the postings of all keys that more than one item has, each once (with its smallest a, b)."""
    sent = texts.sparkSession.sparkContext.broadcast(level)

    def emit(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, level = Seen(), sent.value
        for frame in frames:
            p = post(frame.column("text").to_pylist(), seen, level)
            hot = level[bucket_of(p["key"])] > 0
            yield pa.record_batch(
                [_signed(_placed(p["key"], p["item"], hot)), pa.array(hot), _signed(p["item"]), pa.array(p["a"], pa.int32()),
                 pa.array(p["b"], pa.int32())],
                names=["place", "hot", "item", "a", "b"],
            )

    def repeated(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [frame for frame in frames if frame.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        item, hot = table["item"].to_numpy().view(np.uint64), table["hot"].to_numpy()
        key = _placed(table["place"].to_numpy().view(np.uint64), item, hot)
        a, b = table["a"].to_numpy(), table["b"].to_numpy()
        order = np.lexsort((b, a, item, key))
        key, item = key[order], item[order]
        same_key = np.concatenate(([False], key[1:] == key[:-1]))
        first = ~(same_key & np.concatenate(([False], item[1:] == item[:-1])))
        order, key, item = order[first], key[first], item[first]
        same = key[1:] == key[:-1]
        shared = np.concatenate(([False], same)) | np.concatenate((same, [False])) | hot[order]
        order = order[shared]
        yield pa.record_batch(
            [_signed(key[shared]), _signed(item[shared]), pa.array(a[order]), pa.array(b[order])], names=["key", "item", "a", "b"]
        )

    rows = texts.mapInArrow(emit, "place long, hot boolean, item long, a int, b int")
    dealt = rows.repartition(wide_partitions(texts.sparkSession), "place")
    return materialise(dealt.mapInArrow(repeated, "key long, item long, a int, b int"))


def payloads(texts: DataFrame, items: DataFrame, content: Callable[[list[str]], Iterator[tuple[int, Callable[[], bytes]]]]) -> DataFrame:
    """``item, content`` of ``items`` (a long column ``item``, with repeats), and of few others, taken from the texts once more.

    A sketch of the wanted items, of fixed size, goes to the tasks; the joins that follow drop what it lets through.
    """
    sent = texts.sparkSession.sparkContext.broadcast(sketch(items) > 0)

    def emit(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, wanted = Seen(), sent.value
        for frame in frames:
            found, blobs = [], []
            for item, make in content(frame.column("text").to_pylist()):
                if wanted[item >> (64 - SKETCH_BITS)] and seen.new(item):
                    found.append(item)
                    blobs.append(make())
            yield pa.record_batch([_signed(np.array(found, np.uint64)), pa.array(blobs, pa.binary())], names=["item", "content"])

    return materialise(texts.mapInArrow(emit, "item long, content binary").dropDuplicates(["item"]))


def verified(pairs: DataFrame, contents: DataFrame, check: Callable[[bytes, list[bytes]], list[bool]]) -> DataFrame:
    """The pairs ``one, other`` whose contents pass ``check`` (of one content against a block of others)."""
    with_other = pairs.join(contents.select(F.col("item").alias("other"), F.col("content").alias("others")), "other")
    both = with_other.join(contents.select(F.col("item").alias("one"), F.col("content").alias("ones")), "one")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            one, others = frame.column("one").to_numpy(), frame.column("others")
            linked = np.zeros(len(one), bool)
            edges = np.flatnonzero(np.concatenate(([True], one[1:] != one[:-1], [True]))) if len(one) else []
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                block = [blob.as_buffer() for blob in others[start:end]]
                linked[start:end] = check(frame.column("ones")[start].as_buffer(), block)
            yield pa.record_batch([frame.column("one"), frame.column("other")], names=["one", "other"]).filter(pa.array(linked))

    rows = both.select("one", "other", "ones", "others").mapInArrow(run, "one long, other long")
    return materialise(rows)


def components(links: DataFrame) -> DataFrame:
    """``item, component`` of every item in ``links`` (``one, other``): the smallest item it is joined to.

    Large-star and small-star steps in turn, until neither changes a link. Each step is a grouping and a join over links.
    A round costs some eight stages whatever it moves, so up to ``FEW_LINKS`` links are joined up in one stage instead.
    """
    links = links.filter("one != other")
    if links.count() <= FEW_LINKS:
        return materialise(links.select("one", "other").repartition(1).mapInArrow(_joined, "item long, component long"))
    edges = materialise(links.select(F.greatest("one", "other").alias("u"), F.least("one", "other").alias("v")).distinct())
    state = None
    while (now := _state(edges)) != state:
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        edges = materialise(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = materialise(edges.groupBy("u").agg(F.min("v").alias("m")))
        small = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        edges = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    roots = edges.select(F.col("v").alias("item"), F.col("v").alias("component")).distinct()
    return materialise(edges.select(F.col("u").alias("item"), F.col("v").alias("component")).unionByName(roots))


def _joined(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``components`` of few links: a forest whose roots are the smallest items."""
    above: dict[int, int] = {}

    def root(item: int) -> int:
        while (up := above.setdefault(item, item)) != item:
            above[item] = item = above[up]
        return item

    for frame in frames:
        for one, other in zip(frame.column("one").to_pylist(), frame.column("other").to_pylist(), strict=True):
            smaller, larger = sorted((root(one), root(other)))
            above[larger] = smaller
    found = [list(above), [root(item) for item in above]]
    yield pa.record_batch([pa.array(column, pa.int64()) for column in found], names=["item", "component"])


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def linked_components(
    texts: DataFrame,
    lists: DataFrame,
    admits: Callable[[str, str], Column],
    preference: Column,
    content: Callable,
    check: Callable[[bytes, list[bytes]], list[bool]],
    screen: tuple[DataFrame, Callable] | None = None,
) -> DataFrame:
    """``item, component`` of all items with a link.

    ``lists`` are postings from ``shared_keys``; ``admits`` tells whether two of them (by their aliases) can be linked;
    the pivot of a key has the smallest ``preference`` of ``lists``; ``content`` and ``check`` are those of ``payloads``
    and ``verified``. ``screen`` has small contents per item, and a check that only pairs without a link fail.
    """
    ranked = lists.select("key", "item", "a", "b", F.struct(preference.alias("order"), "item", "a", "b").alias("rank"))
    pivots = materialise(ranked.groupBy("key").agg(F.min("rank").alias("rank")).select("key", F.col("rank.item").alias("item"), F.col("rank.a").alias("a"), F.col("rank.b").alias("b")))
    x, y = lists.alias("x"), pivots.alias("y")
    first = x.join(y, F.col("x.key") == F.col("y.key")).filter((F.col("x.item") != F.col("y.item")) & admits("x", "y"))
    first = materialise(first.select(F.col("y.item").alias("one"), F.col("x.item").alias("other")).distinct())
    links = _links(texts, first, content, check, screen)
    found = components(links)

    # Items that are not in the component of the pivot of one of their keys.
    label = found.select(F.col("item").alias("of"), "component")
    placed = lists.join(label, F.col("item") == F.col("of"), "left").select(
        "key", "item", "a", "b", F.coalesce("component", "item").alias("component")
    )
    # Each pair of them once: the other one is no such item, or the larger one.
    pivot_label = pivots.join(label, F.col("item") == F.col("of"), "left").select(
        "key", F.coalesce("component", "item").alias("pivot_component")
    )
    away = (F.col("component") != F.col("pivot_component")).alias("away")
    placed = materialise(placed.join(materialise(pivot_label), "key").select(*placed.columns, away))
    x, y = placed.filter("away").alias("x"), placed.alias("y")
    apart = (F.col("x.component") != F.col("y.component")) & (~F.col("y.away") | (F.col("x.item") < F.col("y.item")))
    rest = x.join(y, (F.col("x.key") == F.col("y.key")) & apart & admits("x", "y"))
    rest = rest.select(F.least("x.item", "y.item").alias("one"), F.greatest("x.item", "y.item").alias("other")).distinct()
    tried = first.select(F.least("one", "other").alias("one"), F.greatest("one", "other").alias("other"))
    rest = materialise(rest.join(tried, ["one", "other"], "left_anti"))
    if rest.isEmpty():
        return found
    more = _links(texts, rest, content, check, screen)
    return found if more.isEmpty() else components(found.toDF("one", "other").unionByName(more))


def _links(texts: DataFrame, pairs: DataFrame, content: Callable, check: Callable, screen: tuple | None) -> DataFrame:
    if screen:
        pairs = verified(pairs, *screen)
    items = pairs.select(F.col("one").alias("item")).unionByName(pairs.select(F.col("other").alias("item")))
    return verified(pairs, payloads(texts, items, content), check)
