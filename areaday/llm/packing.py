"""Token pieces of documents, and best-two-fit packing of pieces into sequences.

A document is its token ids and one end id; only those longer than a sequence are cut. Pieces are dealt evenly over
packing groups of at most ``GROUP_PIECES``; each group fills its sequences by itself, so no task sees more than one
group, and a group leaves one or two sequences part-filled. A sequence takes the longest piece that fits until none
does; then its shortest piece makes way for two others that fill the gap more tightly.

Null texts count as empty and are one end id. Rows that repeat are packed once each. A null ``doc_id`` is kept as it
is. Other columns are not read. An empty table gives no pieces.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaday.llm.common import batches, record, small_batches, whole_text
from areaday.session import materialise

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 50_000
_CACHED_PARTS = 500_000
_AT_ONCE = 1000
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_ASCII_SPACE = re.compile("[ \t\n\r\x0b\x0c]+")
_PLAIN = re.compile("[ \t\n\r\x0b\x0c!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
_PART = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^ \t\n\r\x0b\x0c0-9{_LETTERS}]+")
PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids", pa.binary())])


class WordTokenizer:
    """Ids of texts by a tokenizer that first cuts a text into parts that it never joins, as little-endian numbers.

    Parts are runs of letters, digits, runs of other signs, and English endings; white space is dropped. Texts of plain
    Latin letters are cut by one pattern, others word by word. Only parts that are not known yet are encoded, many at
    once; the tokenizer marks the last id of each. Words beyond plain Latin letters, and special tokens, are encoded as
    they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ids = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(ids.values()) + 1, bool)
        self.ends[[i for token, i in ids.items() if token.endswith("</w>")]] = True
        self.parts: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.parts) > _CACHED_PARTS:
            self.parts = {}
        cut = [self.cut(text) for text in texts]
        wanted = sorted(set().union(*cut) - self.parts.keys())
        for start in range(0, len(wanted), _AT_ONCE):
            self.learn(wanted[start : start + _AT_ONCE])
        look = self.parts.__getitem__
        return [b"".join(map(look, parts)) for parts in cut]

    def cut(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return _PART.findall(text.lower())
        parts = []
        for word in _ASCII_SPACE.split(text):
            if word and _PLAIN.fullmatch(word) and "<|" not in word:
                parts += _PART.findall(word.lower())
            elif word:
                # The mark keeps a word that is encoded as it is apart from parts, which hold no white space.
                if f" {word}" not in self.parts:
                    self.parts[f" {word}"] = self.whole(word)
                parts.append(f" {word}")
        return parts

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, parts: list[str]) -> None:
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(parts):
            self.parts.update((part, self.whole(part)) for part in parts)
            return
        blob, start = ids.tobytes(), 0
        for part, end in zip(parts, (4 * ends).tolist(), strict=True):
            self.parts[part] = blob[start:end]
            start = end


@cache
def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, so that tasks that follow one another share what it knows."""
    return WordTokenizer(path)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids`` of every document; ``ids`` are little-endian unsigned 32-bit numbers."""
    small_batches(docs.sparkSession)
    end, step = np.array([END_ID], "<u4").tobytes(), 4 * capacity

    def cut(frames):
        words = tokenizer(vocabulary)
        for columns in batches(frames):
            out = {name: [] for name in PIECES.names}
            for doc_id, ids in zip(columns["doc_id"], words.encode(columns["text"]), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    for name, value in zip(PIECES.names, (doc_id, piece, at // 4, len(part) // 4, part), strict=True):
                        out[name].append(value)
            yield record(PIECES, **out)

    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    return texts.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


class Shelf:
    """Unpacked pieces by length, with the lengths that are there as bits of a number."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.capacity, self.present, self.mirrored = capacity, 0, 0
        self.places: list[list[int]] = [[] for _ in range(capacity + 1)]
        for place, length in enumerate(lengths.tolist()):
            self.put(place, length)

    def put(self, place: int, length: int) -> None:
        self.places[length].append(place)
        self.present |= 1 << length
        self.mirrored |= 1 << (self.capacity - length)

    def take(self, length: int) -> int:
        place = self.places[length].pop()
        if not self.places[length]:
            self.present &= ~(1 << length)
            self.mirrored &= ~(1 << (self.capacity - length))
        return place

    def longest(self, gap: int) -> int:
        """The largest length of at most ``gap``, or -1."""
        return (self.present & ((1 << (gap + 1)) - 1)).bit_length() - 1

    def two(self, above: int, gap: int) -> tuple[int, int] | None:
        """Two lengths whose sum is the largest over ``above`` and at most ``gap``."""
        for total in range(gap, above, -1):
            # Bit a: both a and total - a are there.
            both = self.present & (self.mirrored >> (self.capacity - total))
            while both:
                a = both.bit_length() - 1
                if 2 * a != total or len(self.places[a]) > 1:
                    return a, total - a
                both &= ~(1 << a)
        return None


def best_two_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset in it of each piece, for one group of pieces."""
    shelf, sequence, offset = Shelf(lengths, capacity), np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    number = 0
    while shelf.present:
        held: list[int] = []
        gap = capacity

        def fill() -> None:
            nonlocal gap
            while gap and (length := shelf.longest(gap)) > 0:
                held.append(shelf.take(length))
                gap -= length

        fill()
        smallest = int(lengths[held[-1]])
        if gap and (two := shelf.two(smallest, gap + smallest)):
            shelf.put(held.pop(), smallest)
            held += [shelf.take(length) for length in two]
            gap += smallest - sum(two)
            fill()
        at = 0
        for place in held:
            sequence[place], offset[place] = number, at
            at += int(lengths[place])
        number += 1
    return sequence, offset


def pack(lengths: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``lengths`` (with a column ``length`` from 1 to ``capacity``, and any others) with ``sequence_id, offset``."""
    written = materialise(lengths)
    groups = max(1, math.ceil(written.count() / group_pieces))

    def place(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = list(frames)
        if not group:
            return
        held = pa.Table.from_batches(group)
        sequence, offset = best_two_fit(held["length"].to_numpy(), capacity)
        first = TaskContext.get().partitionId() << 32
        placed = held.append_column("sequence_id", pa.array(first + sequence)).append_column("offset", pa.array(offset))
        yield from placed.to_batches()

    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in written.schema)}, sequence_id long, offset long"
    return written.repartition(groups).mapInArrow(place, schema)


def sequences(packed: DataFrame, ids: DataFrame) -> DataFrame:
    """The sequences themselves, ``sequence_id, ids``: ``packed`` rows joined to ``ids`` (from ``pieces``) in order."""
    one = packed.select("doc_id", "piece", "sequence_id", "offset").join(ids.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return one.groupBy("sequence_id").agg(joined.alias("ids"))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    cut = pieces(docs, vocabulary, capacity)
    return pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)
