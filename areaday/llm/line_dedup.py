"""Lines that repeat, exactly or with up to ``EDITS`` edits, by a segment-partition edit join.

Lines are compared in their text without white space at both ends: equal lines of at least ``LEAST_EXACT`` characters
are repeats, and lines of at least ``LEAST_CHARS`` also where they differ by a few edits. Shorter ones are left alone, as
they repeat by chance. A line is split into ``EDITS + 1`` segments of even length. A line within
``EDITS`` edits that is no shorter must hold one of them unchanged, near its place; so the segments are indexed by length
and place, lines probe the index with the few substrings that length and place allow, and candidates are verified by a
bit-parallel edit distance that is limited to a band around the diagonal.

Equal lines are one item, by a 64-bit hash. Linked lines are a class (with all that links join); the occurrence with the
smallest ``doc_id`` (null first) and line number stays, and all others are removed. Rows that repeat both ``doc_id`` and
text are one document and share the decision. Null texts count as empty: one empty line, which is never removed. Other
columns take no part, except that those named in ``keep`` are handed on. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaday.llm.common import SKETCH_BITS, bucket_counts, carried, mixed, row_type, small_batches, summed, whole_text
from areaday.llm.linking import Postings, Seen, levels, linked_components, shared_keys
from areaday.session import materialise

EDITS = 2
LEAST_CHARS = 40
LEAST_EXACT = 20
_INDEXED, _PROBE = 0, 1
_AT_ONCE = 1 << 17


def lines_of(text: str) -> list[str]:
    return text.split("\n")


def comparable(line: str, least: int = LEAST_CHARS) -> str | None:
    """The part of a line that is compared, or ``None``."""
    line = line.strip()
    return line if len(line) >= least else None


def item_of(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"))


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """Start and length of the ``edits + 1`` even segments of a line; the last ones are longer by one if need be."""
    parts = edits + 1
    short, longer = length // parts, length % parts
    out, start = [], 0
    for i in range(parts):
        size = short + (i >= parts - longer)
        out.append((start, size))
        start += size
    return out


def probes(length: int, edits: int) -> list[tuple[int, int, int, int]]:
    """``(indexed length, segment, start, size)`` of the substrings with which a line of ``length`` probes the index.

    A shift of more than the edits that can come before the segment, or of more than those that can come after it
    allow, would be found by another segment.
    """
    out = []
    for shorter in range(max(edits + 1, length - edits), length + 1):
        gap = length - shorter
        for i, (start, size) in enumerate(segments(shorter, edits)):
            low = max(0, start - i, start + gap - (edits - i))
            high = min(length - size, start + i, start + gap + (edits - i))
            out += [(shorter, i, at, size) for at in range(low, high + 1) if (gap, at) != (0, start)]
    return out


@cache
def plan(length: int, edits: int) -> tuple[np.ndarray, ...]:
    """Start, end, mark, and a number for the segment and the indexed length, of all postings of a line."""
    rows = [(start, start + size, _INDEXED, length * (edits + 1) + i) for i, (start, size) in enumerate(segments(length, edits))]
    rows += [(at, at + size, _PROBE, shorter * (edits + 1) + i) for shorter, i, at, size in probes(length, edits)]
    return tuple(np.array(column, np.int64) for column in zip(*rows, strict=True))


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2^``bits`` powers of an odd number and of its inverse modulo 2^64."""
    factor = 0xD6E8FEB86659FD93
    return tuple(np.cumprod(np.append(np.uint64(1), np.full((1 << bits) - 1, f, np.uint64))) for f in (factor, pow(factor, -1, 1 << 64)))


def substring_keys(lines: list[str], edits: int, classify_signs: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """For all postings of the lines: the number of the line, the key, the mark; and the kinds of signs per line.

    Substrings are hashed as differences of running sums of numbers per sign times powers of a factor, brought to the
    same power by its inverse. The kinds are counts of signs by two classifications, modulo 32, five bits a class.
    """
    lengths = np.array([len(line) for line in lines], np.int64)
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    up, down = _powers(max(16, int(len(codes)).bit_length()))
    usual, needed = codes.max() < _USUAL, 3 if classify_signs else 1
    numbers, *packed = (of[codes] for of in _SIGNS[:needed]) if usual else _signs(codes)[:needed]
    sums = _running(numbers * up[: len(codes)])
    first = np.cumsum(lengths) - lengths
    plans = [plan(n, edits) for n in lengths.tolist()]
    owner = np.repeat(np.arange(len(lines)), [len(p[0]) for p in plans])
    start, end, mark, place = (np.concatenate([p[i] for p in plans]) for i in range(4))
    start, end = start + first[owner], end + first[owner]
    keys = mixed((sums[end] - sums[start]) * down[start] + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    kinds = []
    for (classify, classes), ones in zip(_CLASSES, packed, strict=True) if classify_signs else ():
        running = _running(ones)
        counts = running[first + lengths] - running[first]
        found = sum(((counts >> np.uint64(10 * k)) & np.uint64(31)) << np.uint64(5 * k) for k in range(classes))
        for line in np.flatnonzero(lengths >= 1 << 10).tolist():  # too long for fields of ten bits
            own = np.bincount(classify(codes[first[line] : first[line] + lengths[line]]), minlength=classes) & 31
            found[line] = int((own << (5 * np.arange(classes))).sum())
        kinds.append(found.astype(np.int64))
    return owner, keys, mark, kinds


def _running(numbers: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(numbers)))


#: How signs are classified, and into how many classes.
_CLASSES = ((lambda codes: codes % 6, 6), (lambda codes: codes // 6 % 5, 5))


def _signs(codes: np.ndarray) -> list[np.ndarray]:
    """A random number per sign, and for both classifications a 1 in the field of its class, ten bits each."""
    codes = codes.astype(np.uint64)
    ones = [np.uint64(1) << (np.uint64(10) * classify(codes).astype(np.uint64)) for classify, _ in _CLASSES]
    return [mixed(codes + np.uint64(1)) | np.uint64(1), *ones]


_USUAL = 1024
_SIGNS = _signs(np.arange(_USUAL))


def new_lines(texts: list[str], seen: Seen, least: int) -> Iterator[tuple[list[str], list[int]]]:
    """The lines that are compared and were not seen before, with their items, some at a time."""
    lines, items, size = [], [], 0
    for text in texts:
        for line in lines_of(text):
            if (line := comparable(line, least)) is not None and seen.new(item := item_of(line)):
                lines.append(line)
                items.append(item)
                size += len(line)
                if size >= _AT_ONCE:
                    yield lines, items
                    lines, items, size = [], [], 0
    if lines:
        yield lines, items


def postings(edits: int, least: int) -> Callable[[list[str], Seen, np.ndarray], Postings]:
    """Postings of the different lines of texts.

    ``a`` holds the mark and one classification of the signs, ``b`` the length modulo 64 and the other one.
    """

    def post(texts: list[str], seen: Seen, level: np.ndarray) -> Postings:
        parts = []
        for lines, items in new_lines(texts, seen, least):
            owner, keys, mark, kinds = substring_keys(lines, edits)
            sizes = np.array([len(line) for line in lines]) & 63
            a, b = (kinds[0][owner] << 1) | mark, (kinds[1][owner] << 6) | sizes[owner]
            parts.append((keys, np.array(items, np.uint64)[owner], a, b))
        kinds = (np.uint64, np.uint64, np.int32, np.int32)
        made = [np.concatenate([p[i] for p in parts]) if parts else np.empty(0) for i in range(4)]
        return {name: x.astype(kind) for name, x, kind in zip(("key", "item", "a", "b"), made, kinds, strict=True)}

    return post


def may_be_close(x: str, y: str, edits: int) -> Column:
    """Whether two postings can be those of linked lines: one is indexed, and neither lengths nor signs differ too much.

    An edit changes the number of signs of a class by one, in two classes at most.
    """

    def apart(field: str, shift: int, size: int) -> Column:
        one, other = (F.shiftright(F.col(f"{name}.{field}"), shift).bitwiseAND(size - 1) for name in (x, y))
        return F.least(F.pmod(one - other, F.lit(size)), F.pmod(other - one, F.lit(size)))

    indexed = (F.col(f"{x}.a").bitwiseAND(1) == _INDEXED) | (F.col(f"{y}.a").bitwiseAND(1) == _INDEXED)
    alike = apart("b", 0, 64) <= edits
    for field, first, (_, classes) in (("a", 1, _CLASSES[0]), ("b", 6, _CLASSES[1])):
        alike = alike & (reduce(add, [apart(field, first + 5 * k, 32) for k in range(classes)]) <= 2 * edits)
    return indexed & alike


def contents(least: int) -> Callable[[list[str]], Iterator[tuple[int, Callable[[], bytes]]]]:
    def content(texts: list[str]) -> Iterator[tuple[int, Callable[[], bytes]]]:
        for text in texts:
            for line in lines_of(text):
                if (line := comparable(line, least)) is not None:
                    yield item_of(line), lambda line=line: line.encode("utf-8", "surrogatepass")

    return content


def within(one: str, other: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``, by columns of a band of bits around the diagonal.

    Equal starts and ends are cut off first. Bit ``i`` of the band of row ``r`` stands for column ``r + i - edits``; the
    vertical differences of neighbouring cells are kept as one number for +1 and one for -1 (bit-parallel).
    """
    if abs(len(one) - len(other)) > edits:
        return False
    start, end = 0, 0
    most = min(len(one), len(other))
    while start < most and one[start] == other[start]:
        start += 1
    while end < most - start and one[-1 - end] == other[-1 - end]:
        end += 1
    one, other = one[start : len(one) - end], other[start : len(other) - end]
    if not one or not other:
        return max(len(one), len(other)) <= edits
    if len(one) > len(other):
        one, other = other, one
    m, n = len(one), len(other)
    where: dict[str, int] = {}
    for i, c in enumerate(one):
        where[c] = where.get(c, 0) | 1 << i
    plus, minus, distance = (1 << m) - 1, 0, m
    last, whole = 1 << (m - 1), (1 << m) - 1
    for column, c in enumerate(other):
        # Only rows within the band of this column can lie on a path of at most ``edits`` edits.
        low, high = max(0, column - edits), min(m, column + edits + 1)
        band = ((1 << high) - 1) ^ ((1 << low) - 1)
        match = where.get(c, 0) & band
        zero = (((match & plus) + plus) ^ plus) | match | minus
        across_plus, across_minus = minus | ~(zero | plus) & whole, plus & zero
        distance += (1 if across_plus & last else 0) - (1 if across_minus & last else 0)
        across_plus, across_minus = (across_plus << 1 | 1) & whole, (across_minus << 1) & whole
        plus, minus = across_minus | ~(zero | across_plus) & whole, across_plus & zero
        if distance - (n - 1 - column) > edits:
            return False
    return distance <= edits


def close(edits: int) -> Callable[[bytes, list[bytes]], list[bool]]:
    def check(one: bytes, others: list[bytes]) -> list[bool]:
        line = bytes(one).decode("utf-8", "surrogatepass")
        return [within(line, bytes(other).decode("utf-8", "surrogatepass"), edits) for other in others]

    return check


def line_classes(texts: DataFrame, edits: int = EDITS, least: int = LEAST_CHARS) -> DataFrame:
    """``item, component`` of the lines in ``texts`` (a column ``text``) that are linked with another line."""
    post = postings(edits, least)

    def count(frames):
        seen, counts = Seen(), np.zeros(1 << SKETCH_BITS, np.int64)
        for frame in frames:
            for lines, _ in new_lines(frame.column("text").to_pylist(), seen, least):
                counts += bucket_counts(substring_keys(lines, edits, classify_signs=False)[1])
        return counts

    level = levels(summed(texts, count, 1 << SKETCH_BITS))
    lists = shared_keys(texts, post, level)

    def admits(x: str, y: str) -> Column:
        return may_be_close(x, y, edits)

    # An indexed line comes first, as all that probe may be linked with it.
    return linked_components(texts, lists, admits, F.col("a").bitwiseAND(1), contents(least), close(edits))


def occurrences(texts: DataFrame, least: int) -> DataFrame:
    """``doc_id, text_hash, line, item`` of every line that is compared, from ``doc_id, text``."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            row, line_no, items = [], [], []
            for i, text in enumerate(frame.column("text").to_pylist()):
                for number, line in enumerate(lines_of(text)):
                    if (line := comparable(line, least)) is not None:
                        row.append(i)
                        line_no.append(number)
                        items.append(item_of(line))
            owner = pa.array(row, pa.int64())
            yield pa.record_batch(
                [frame.column("doc_id").take(owner), frame.column("text_hash").take(owner), pa.array(line_no, pa.int32()),
                 pa.array(np.array(items, np.uint64).view(np.int64))],
                names=["doc_id", "text_hash", "line", "item"],
            )

    keyed = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return keyed.mapInArrow(run, "doc_id long, text_hash long, line int, item long")


def line_dedup(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), edits: int = EDITS, least: int = LEAST_CHARS, exact: int = LEAST_EXACT
) -> DataFrame:
    """``row, n_lines, removed, text`` of every document: the line numbers that go (from 0), and the text that is left."""
    small_batches(docs.sparkSession)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    linked = line_classes(texts.select("text"), edits, least)
    found = occurrences(texts, min(exact, least)).join(linked, "item", "left").select(
        "doc_id", "text_hash", "line", F.coalesce("component", "item").alias("class")
    )
    found = materialise(found)
    place = F.struct("doc_id", "line", "text_hash")
    # Copies of a row are one document: the smallest and the largest place tell whether a class has more than one.
    firsts = found.groupBy("class").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first != last")
    gone = found.join(materialise(firsts.select("class", "first")), "class").filter(~place.eqNullSafe(F.col("first")))
    gone = materialise(gone.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("line")).alias("removed")))
    rows = carried(docs, keep, id=docs["doc_id"].cast("long"), hash=F.xxhash64(whole_text(docs)))
    held = rows.join(gone, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")), "left")

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            n_lines, left, removed = [], [], []
            for text, numbers in zip(frame.column("text").to_pylist(), frame.column("removed").to_pylist(), strict=True):
                lines, numbers = lines_of(text), numbers or []
                out = set(numbers)
                n_lines.append(len(lines))
                removed.append(numbers)
                left.append("\n".join(line for i, line in enumerate(lines) if i not in out) if out else text)
            yield pa.record_batch(
                [frame.column("row"), pa.array(n_lines, pa.int64()), pa.array(removed, pa.list_(pa.int32())), pa.array(left, pa.string())],
                names=["row", "n_lines", "removed", "text"],
            )

    schema = f"row {row_type(docs, keep)}, n_lines long, removed array<int>, text string"
    return held.select("row", "text", "removed").mapInArrow(cut, schema)
