"""Benchmark passages in documents, by an FM-index per shard of the documents.

A window is ``WINDOW`` consecutive words of an item, or all its words if it has fewer. Each task cuts its documents into
shards and numbers the words of a shard. Its index holds all of them, whatever is searched for; equal texts of a shard
are in it once. Backward search over wavelet-tree ranks finds the windows, sampled suffix positions tell where they are,
and overlapping places are merged into spans. A shard of more than ``SHARD_WORDS`` words, as one long text can be, is
indexed in parts that overlap by the longest window.

The windows are prepared in blocks of at most ``BLOCK_BYTES`` of item text. All blocks are searched in the same index;
beyond ``PASS_BLOCKS`` blocks there is one more pass over the documents, so what is broadcast stays bounded however large
the benchmark is.

Null texts have no words, and neither documents nor items without words match anything. Repeated documents are searched
one by one, and repeated items count once by their id (a null id counts as an empty one). Other columns take no part,
except that those named in ``keep`` are handed on. An empty table on either side gives no spans.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaday.llm.common import carried, row_type, small_batches
from areaday.llm.fm_index import FMIndex
from areaday.session import materialise

WINDOW = 13
BLOCK_BYTES = 4_000_000
PASS_BLOCKS = 8
WINDOWS_AT_ONCE = 1 << 16
SHARD_WORDS = 1 << 20
SHARD_DOCUMENTS = 8 * 1000

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_SEPARATOR, _FIRST_WORD = 1, 2


def plain_words(text: str) -> list[bytes]:
    """Stretches of ASCII letters and digits and of all that is not ASCII, with A-Z lowered."""
    return text.encode().translate(_WORD_BYTES).split()


class Phrases:
    """The different windows of items, as places in the items' numbered words, and the items that have each."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        number: dict[bytes, int] = defaultdict(count().__next__)
        windows: dict[tuple[int, ...], int] = {}
        owners: list[set[int]] = []
        words, ends, lengths = [], [], []
        self.items = sorted({item_id for item_id, _ in items})
        place = {item_id: i for i, item_id in enumerate(self.items)}
        for item_id, text in items:
            found = [number[w] for w in plain_words(text)]
            length = min(window, len(found))
            for start in range(len(found) - length + 1) if found else ():
                key = tuple(found[start : start + length])
                if key not in windows:
                    windows[key] = len(ends)
                    owners.append(set())
                    ends.append(len(words) + start + length)
                    lengths.append(length)
                owners[windows[key]].add(place[item_id])
            words += found
        self.vocabulary = list(number)
        self.words = np.array(words, np.int32)
        self.ends, self.lengths = np.array(ends, np.int32), np.array(lengths, np.int32)
        self.owned = np.array([i for ids in owners for i in sorted(ids)], np.int32)
        self.owns_from = np.concatenate(([0], np.cumsum([len(ids) for ids in owners], dtype=np.int64))).astype(np.int64)

    def numbered(self, number: dict[bytes, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Windows all of whose words have a number, and a row of these per window, aligned to the right; in parts."""
        words = np.array([number.get(w, 0) for w in self.vocabulary], np.int64)[self.words]
        unknown = np.concatenate(([0], np.cumsum(words == 0)))
        known = np.flatnonzero(unknown[self.ends] == unknown[self.ends - self.lengths])
        for start in range(0, len(known), WINDOWS_AT_ONCE):
            part = known[start : start + WINDOWS_AT_ONCE]
            width = int(self.lengths[part].max())
            yield part, words[np.maximum(self.ends[part, None] - width + np.arange(width), 0)]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges of ``lengths`` from ``starts`` on."""
    return np.arange(lengths.sum()) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)


class Shard:
    """Documents that are indexed and searched together."""

    def __init__(self):
        self.number: dict[bytes, int] = defaultdict(count(_FIRST_WORD).__next__)
        self.text_of: list[int] = []
        self.places: dict[str, int] = {}
        self.symbols: list[np.ndarray] = []
        self.indexed = 0

    def add(self, texts: list[str]) -> None:
        for text in texts:
            place = self.places.setdefault(text, len(self.symbols))
            self.text_of.append(place)
            if place == len(self.symbols):
                words = plain_words(text)
                self.symbols.append(np.array([*map(self.number.__getitem__, words), _SEPARATOR], np.int32))
                self.indexed += len(words)

    def n_words(self) -> list[int]:
        return [len(self.symbols[place]) - 1 for place in self.text_of]

    def indexes(self, overlap: int) -> Iterator[tuple[int, FMIndex]]:
        """The parts of the shard's index, each with its place in the shard."""
        symbols = np.concatenate(self.symbols)
        step = -(-len(symbols) // max(1, -(-len(symbols) // SHARD_WORDS)))
        for start in range(0, len(symbols), step):
            yield start, FMIndex(symbols[start : start + step + overlap], _FIRST_WORD + len(self.number))

    def found(self, blocks: list[Phrases]) -> tuple[list[list[dict]], list[list[str]]]:
        """Per document its merged spans and the items with occurring windows."""
        spans: list[list[dict]] = [[] for _ in self.symbols]
        items: list[set[str]] = [set() for _ in self.symbols]
        longest = max((int(b.lengths.max()) for b in blocks if len(b.lengths)), default=0)
        if not self.indexed or not longest:
            return [[] for _ in self.text_of], [[] for _ in self.text_of]
        starts = np.concatenate(([0], np.cumsum([len(s) for s in self.symbols])))
        number = dict(self.number)
        edge = np.zeros(starts[-1] + 1, np.int64)
        for first, index in self.indexes(longest - 1):
            for block in blocks:
                for part, words in block.numbered(number):
                    low, high = index.search(words, block.lengths[part])
                    hits = np.flatnonzero(high > low)
                    times = (high - low)[hits]
                    at = first + index.locate(ranges(low[hits], times))
                    window = np.repeat(part[hits], times)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + block.lengths[window], -1)
                    # Each window of a text once, then each item of these.
                    text = np.searchsorted(starts, at, side="right") - 1
                    seen = np.unique(text * len(block.ends) + window)
                    text, window = seen // len(block.ends), seen % len(block.ends)
                    many = block.owns_from[window + 1] - block.owns_from[window]
                    owned = block.owned[ranges(block.owns_from[window], many)]
                    for pair in np.unique(np.repeat(text, many) * len(block.items) + owned).tolist():
                        items[pair // len(block.items)].add(block.items[pair % len(block.items)])
        covered = np.concatenate(([0], (np.cumsum(edge)[:-1] > 0).astype(np.int8), [0]))
        bounds = np.flatnonzero(np.diff(covered))
        text = np.searchsorted(starts, bounds[::2], side="right") - 1
        begins, ends = bounds[::2] - starts[text], bounds[1::2] - starts[text]
        for place, start, end in zip(text.tolist(), begins.tolist(), ends.tolist(), strict=True):
            spans[place].append({"start": start, "end": end})
        return [spans[place] for place in self.text_of], [sorted(items[place]) for place in self.text_of]


RESULT = "n_words long, spans array<struct<start: long, end: long>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def search(rows: DataFrame, row: str, blocks: list[Phrases]) -> DataFrame:
    """``rows`` (``row, text``) with the words, spans and items of each text, in one pass for all ``blocks``."""
    sent = [rows.sparkSession.sparkContext.broadcast(block) for block in blocks]

    def run(frames):
        held, shard = [], Shard()

        def emit():
            n_words, (spans, items) = shard.n_words(), shard.found([block.value for block in sent])
            at = 0
            for frame in held:
                part = slice(at, at := at + frame.num_rows)
                yield pa.record_batch(
                    [frame.column("row"), frame.column("text"), pa.array(n_words[part], pa.int64()),
                     pa.array(spans[part], _SPANS), pa.array(items[part], pa.list_(pa.string()))],
                    names=["row", "text", "n_words", "spans", "items"],
                )

        for frame in frames:
            held.append(frame)
            shard.add(frame.column("text").to_pylist())
            if shard.indexed >= SHARD_WORDS or len(shard.text_of) >= SHARD_DOCUMENTS:
                yield from emit()
                held, shard = [], Shard()
        if held:
            yield from emit()

    return rows.select("row", "text").mapInArrow(run, f"row {row}, text string, {RESULT}")


def passes(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[tuple[list[Phrases], bool]]:
    """The windows in blocks of about ``block_bytes`` of item text, fetched one at a time; those of a pass together."""
    items = benchmark.select(
        F.coalesce(benchmark["item_id"].cast("string"), F.lit("")).alias("item_id"), benchmark["text"].alias("text")
    ).filter(F.col("text").isNotNull()).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    many = max(1, math.ceil(size / block_bytes))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(many))
    for first in range(0, many, PASS_BLOCKS):
        part = range(first, min(many, first + PASS_BLOCKS))
        yield [
            Phrases([(r["item_id"], r["text"]) for r in items.filter(place == block).collect()], window) for block in part
        ], part.stop == many


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``row, n_words, spans, items`` of every document: ``row`` has the columns of ``keep``.

    ``spans`` are merged places of windows, in words from 0, ends exclusive; ``items`` are ids sorted as strings.
    """
    small_batches(docs.sparkSession)
    row, rows, so_far = row_type(docs, keep), carried(docs, keep), None
    for blocks, last in passes(benchmark, window, block_bytes):
        if so_far is None:
            found = search(rows, row, blocks)
        else:  # what was found before travels in the row
            found = search(
                so_far.select(F.struct("row", "spans", "items").alias("row"), "text"),
                f"struct<row: {row}, spans: array<struct<start: bigint, end: bigint>>, items: array<string>>",
                blocks,
            ).select("row.row", "text", "n_words", merged("row.spans", "spans"),
                     F.array_sort(F.array_union("row.items", "items")).alias("items"))
        so_far = found if last else materialise(found)
    return so_far.select("row", "n_words", "spans", "items")


def merged(one: str, other: str):
    """The union of two lists of spans."""
    return F.expr(
        f"""aggregate(array_sort(concat({one}, {other})), cast(array() as array<struct<start: bigint, end: bigint>>),
            (done, x) -> if(size(done) > 0 and element_at(done, -1).end >= x.start,
                concat(slice(done, 1, size(done) - 1),
                       array(named_struct('start', element_at(done, -1).start,
                                          'end', greatest(element_at(done, -1).end, x.end)))),
                concat(done, array(x))))"""
    ).alias("spans")


def hit_words(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


def contaminated(n_hit, n_words):
    """At least one word in twenty lies in a benchmark passage."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
