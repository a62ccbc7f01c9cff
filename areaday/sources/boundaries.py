"""Records of large files, cut by many tasks: CSV whose quoted fields hold line breaks, and the elements of JSON documents.

A file is read in Spark's own splits, as pieces that end at a sign: lines for CSV, stretches up to a closing brace for
JSON. Whether a split starts within quotes, and how deep within brackets, follows from all splits before it; each split
tells by itself how it changes that. So a first pass counts quotes and brackets per split, the driver adds up one small row
per split (as many as its plan of the scan holds), and a second pass cuts the records of all splits side by side. Records
that lie across splits come out in fragments, at most two per split, which are put together by file and place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from areaday.session import materialise, new_path

RECORD, HEAD, TAIL, CONTEXT, STRAY = range(5)
_BOM = b"\xef\xbb\xbf"


class Split(NamedTuple):
    file: str
    start: int
    length: int
    size: int


class Starts(NamedTuple):
    """In what state splits start, and how large all but a file's last are; ``states`` leaves out the state 0."""

    whole: int | None
    states: dict[tuple[str, int], object]

    def at(self, split: Split, nothing):
        last = split.start + split.length == split.size
        cut_alike = split.start == 0 and last if self.whole is None else split.start % self.whole == 0 and (last or split.length == self.whole)
        if not cut_alike:
            raise ValueError(f"{split.file} was cut into other splits than when it was first read; read it again")
        return self.states.get((split.file, split.start), nothing)


def pieces(spark: SparkSession, path: str | list[str], end: str) -> DataFrame:
    """The stretches of files that end at ``end``, without it, as bytes, with the split that each starts in."""
    text = spark.read.option("lineSep", end).text(path)
    return text.select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_block_length").alias("length"),
        F.col("_metadata.file_size").alias("size"),
    )


SPLIT = list(Split._fields)


def by_split(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple[Split, pa.RecordBatch]]:
    """The batches, cut where a split ends."""
    for frame in frames:
        if not frame.num_rows:
            continue
        files = frame.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts = frame.column("start").to_numpy()
        edges = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), frame.num_rows], strict=True):
            part = frame.slice(a, b - a)
            yield Split(*(part.column(name)[0].as_py() for name in SPLIT)), part


def whole_length(splits: list[Split]) -> int | None:
    """The length of splits that are not their file's last; null if every file is one split."""
    return max((s.length for s in splits if s.start + s.length < s.size), default=None)


def in_order(splits: list) -> dict[str, list]:
    """The rows of each file by place; rows start with the fields of a split."""
    files: dict[str, list] = {}
    for row in sorted(splits, key=lambda r: (r[0], r[1])):
        files.setdefault(row[0], []).append(row)
    return files


_ROWS = "file string, start long, place int, wanted boolean, value binary"
_ROWS_ARROW = pa.schema([("file", pa.string()), ("start", pa.int64()), ("place", pa.int32()), ("wanted", pa.bool_()), ("value", pa.binary())])


def cut(rows: DataFrame, new_cutter, starts: Starts, nothing, places: tuple[int, ...], *columns: str) -> DataFrame:
    """``file, start, place, wanted, value`` of what the cutters of all splits give, of the given places only."""

    def run(frames):
        cutter, now, out = None, None, []

        def emit():
            kept = [row for row in out if row[2] in places]
            out.clear()
            if kept:
                columns = [pa.array(column, field.type) for column, field in zip(zip(*kept, strict=True), _ROWS_ARROW, strict=True)]
                yield pa.record_batch(columns, schema=_ROWS_ARROW)

        for split, frame in by_split(frames):
            if split != now:
                if cutter is not None:
                    out += [(now.file, now.start, *row) for row in cutter.finish()]
                cutter, now = new_cutter(split, starts.at(split, nothing)), split
            given = [frame.column(name).to_pylist() for name in ("value", *columns)]
            out += [(now.file, now.start, *row) for row in cutter.feed(*given)]
            yield from emit()
        if cutter is not None:
            out += [(now.file, now.start, *row) for row in cutter.finish()]
            yield from emit()

    return rows.mapInArrow(run, _ROWS)


def stitched(fragments: DataFrame, glue: str) -> DataFrame:
    """Fragments put together: each tail with what follows it in its file, up to the head that ends it.

    ``file``, the ``start`` of the split it begins in, ``wanted`` of the tail, and the whole ``value``.
    """
    in_file = Window.partitionBy("file").orderBy("start", "place")
    numbered = fragments.withColumn("record", F.count_if(F.col("place") == TAIL).over(in_file))
    part = F.struct("start", "place", F.col("value").cast("string").alias("text"))
    whole = numbered.groupBy("file", "record").agg(
        F.sort_array(F.collect_list(part)).alias("parts"), F.bool_or("wanted").alias("wanted"), F.min("start").alias("start")
    )
    text = F.array_join(F.transform("parts", lambda p: p["text"]), glue)
    return whole.select("file", "start", "wanted", text.cast("binary").alias("value"))


# CSV ------------------------------------------------------------------------------------------------------------------


class LinesToRecords:
    """Joins the lines of a split to records: a record ends at the end of a line that leaves no quote open."""

    def __init__(self, split: Split, odd: bool):
        self.odd, self.cut, self.at_top, self.open = bool(odd), bool(odd), split.start == 0, []
        self.file_starts = split.start == 0

    def feed(self, lines: list[bytes], quotes: list[int]):
        if self.file_starts and lines:
            lines[0], self.file_starts = lines[0].removeprefix(_BOM), False
        odd = (np.cumsum(np.array(quotes, np.int64)) + self.odd) % 2
        first = 0
        for last in np.flatnonzero(odd == 0).tolist():
            record = b"\n".join([*self.open, *lines[first : last + 1]]).removesuffix(b"\r")
            self.open, first = [], last + 1
            if self.cut:
                yield HEAD, False, record
            elif record:  # empty lines between records do not count
                yield RECORD, self.at_top, record
            self.cut = False
            self.at_top = self.at_top and not record
        self.open += lines[first:]
        self.odd = bool(odd[-1]) if len(odd) else self.odd

    def finish(self):
        if self.open:
            yield (HEAD if self.cut else TAIL), self.at_top, b"\n".join(self.open)


def quoted_records(spark: SparkSession, path: str | list[str], quote: str = '"') -> DataFrame:
    """``record`` and whether it is the first of its file, as ``header``, of delimited files with line breaks in quotes.

    Lines end with a line feed, or a carriage return and one. Quotes are ASCII and stand around fields only; within them
    they are doubled. Empty lines between records do not count. A file that ends within quotes raises an error here.
    """
    quotes = (F.octet_length("value") - F.octet_length(F.replace(F.col("value").cast("string"), F.lit(quote), F.lit("")))).alias("quotes")
    lines = pieces(spark, path, "\n").withColumn("quotes", quotes)
    counted = lines.groupBy(*SPLIT).agg((F.sum("quotes") % 2 == 1).alias("odd")).collect()
    odd_starts, edges = {}, set()
    for file, rows in in_order(counted).items():
        odd = False
        for row in rows:
            if odd:
                odd_starts[file, row.start] = True
            if odd or odd != row.odd:
                edges.add((file, row.start))
            odd ^= row.odd
        if odd:
            raise ValueError(f"{file} ends within quotes")
    starts = Starts(whole_length([Split(*row[:4]) for row in counted]), odd_starts)
    found = cut(lines, LinesToRecords, starts, False, (RECORD,), "quotes").select("value", "wanted")
    if edges:
        # Only splits with a record across one of their ends are read again, for its fragments.
        at_edges = F.concat_ws("\n", "file", F.col("start").cast("string")).isin([f"{file}\n{start}" for file, start in sorted(edges)])
        fragments = cut(lines.filter(at_edges), LinesToRecords, starts, False, (HEAD, TAIL), "quotes")
        whole = stitched(fragments, "\n").select(F.rtrim(F.col("value").cast("string"), F.lit("\r")).cast("binary").alias("value"), "wanted")
        found = found.unionByName(whole)
    return found.select(F.col("value").cast("string").alias("record"), F.col("wanted").alias("header"))


# JSON -----------------------------------------------------------------------------------------------------------------

_QUOTE, _OPEN, _CLOSE = ord('"'), [ord("{"), ord("[")], [ord("}"), ord("]")]


def without_escapes(text: bytes) -> bytes:
    """The text with escaped signs in strings blanked, byte by byte in place."""
    return text.replace(rb"\\", b"\0\0").replace(b'\\"', b"\0\0")


def brackets(plain: bytes, inside: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of the brackets outside strings, +1 or -1 for each, and whether the text ends in a string."""
    signs = np.frombuffer(plain, np.uint8)
    in_string = (np.cumsum(signs == _QUOTE) + inside) % 2
    at = np.flatnonzero(np.isin(signs, _OPEN + _CLOSE) & (in_string == 0))
    return at, np.where(np.isin(signs[at], _OPEN), 1, -1), int(in_string[-1]) if len(signs) else inside


class PiecesToElements:
    """Cuts the objects out of a list at a depth: of the list that a document is, or of those below a key of its object."""

    def __init__(self, split: Split, state: tuple[int, int], key: str | None):
        self.inside, self.depth = state
        self.level = 1 if key is None else 2
        self.key = None if key is None else re.compile(b'"' + re.escape(key.encode()) + rb'"\s*:\s*\Z')
        self.wanted: bool | None = None if split.start else False  # is the list that is open one to take? None: not known here
        self.context: bool | None = self.wanted
        self.open: list[bytes] | None = [] if self.depth > self.level else None
        self.cut = self.open is not None
        self.between = b","
        self.rest = b""

    def feed(self, given: list[bytes]):
        text = b"}".join([*given, b""])
        plain = without_escapes(text)
        at, change, inside = brackets(plain, self.inside)
        depth = self.depth + np.cumsum(change)
        level = np.flatnonzero((depth == self.level) | ((depth == self.level + 1) & (change > 0)) | ((depth == self.level - 1) & (change < 0)))
        begin = mark = 0
        for i in level.tolist():
            place, up, now = int(at[i]), change[i] > 0, int(depth[i])
            if up and now == self.level:  # a list or an object opens
                before = plain[int(at[i - 1]) + 1 if i else 0 : place]
                self.wanted = self.context = text[place] == _OPEN[1] and (self.key is None or self.key.search(before) is not None)
                mark, self.between, self.rest = place + 1, b"", b""
            elif up:  # an element opens
                if self.wanted is not False:
                    if (self.rest + text[mark:place]).strip() != self.between or text[place] != _OPEN[0]:
                        yield self.odd()
                    self.open, begin = [], place
            elif now == self.level:  # an element ends
                if self.open is not None:
                    value = b"".join([*self.open, text[begin : place + 1]])
                    yield (HEAD if self.cut else RECORD), None if self.cut else self.wanted, value
                    self.open, self.cut = None, False
                mark, self.between, self.rest = place + 1, b",", b""
            else:  # the list or object ends
                if self.wanted is not False and (self.rest + text[mark:place]).strip():
                    yield self.odd()
                self.wanted = self.context = False
        if self.open is not None:
            self.open.append(text[begin:])
        elif self.wanted is not False:
            self.rest += text[mark:]
        self.inside, self.depth = inside, int(depth[-1]) if len(depth) else self.depth

    def odd(self):
        if self.wanted:
            raise ValueError("a list of objects holds something else")
        return STRAY, None, b""

    def finish(self):
        if self.open is not None:
            yield (HEAD if self.cut else TAIL), None if self.cut else self.wanted, b"".join(self.open)
        yield CONTEXT, self.context, b""


_CHANGES = "file string, start long, length long, size long, odd long, even_net long, odd_net long, bytes long"


def bracket_changes(frames):
    """Per split: whether its quotes are odd, and how deep it leads if it starts outside of strings, or in one."""
    totals: dict[Split, list[int]] = {}
    for split, frame in by_split(frames):
        text = b"}".join([*frame.column("value").to_pylist(), b""])
        total = totals.setdefault(split, [0, 0, 0, 0])
        plain = without_escapes(text)
        for inside in (0, 1):
            _, change, last = brackets(plain, (inside + total[0]) % 2)
            total[1 + inside] += int(change.sum())
        total[0] = (last + 1) % 2  # of the text that starts in a string
        total[3] += len(text)
    if totals:
        rows = [(*split, *total) for split, total in totals.items()]
        names = [field.split()[0] for field in _CHANGES.split(", ")]
        yield pa.record_batch([pa.array(column) for column in zip(*rows, strict=True)], names=names)


def bracket_starts(counted: list) -> Starts:
    """Whether splits start in a string, and how deep, from what ``bracket_changes`` gives for all of them."""
    states = {}
    for file, rows in in_order(counted).items():
        inside, depth = 0, 0
        for row in rows:
            if inside or depth:
                states[file, row.start] = inside, depth
            inside, depth = inside ^ row.odd, depth + (row.odd_net if inside else row.even_net)
        # The last piece has a closing brace only if the file ends with it.
        phantom = sum(row.bytes for row in rows) > rows[-1].size
        if inside or depth + phantom:
            raise ValueError(f"{file} is cut off, or its brackets do not match")
    return Starts(whole_length([Split(*row[:4]) for row in counted]), states)


def json_elements(spark: SparkSession, path: str | list[str], key: str | None = None) -> DataFrame:
    """The objects, as JSON text, of the lists that documents are, or that stand below ``key`` of documents that are objects.

    Each file holds a document, or several one after the other; keys are compared as they are written. A document that
    is cut off and a list that holds anything else than objects raise an error here, except that nothing checks what
    stands outside those lists. The elements are a written table, read by as many tasks as it has parts.
    """
    text = pieces(spark, path, "}")
    starts = bracket_starts(text.mapInArrow(bracket_changes, _CHANGES).collect())
    every = (RECORD, HEAD, TAIL, CONTEXT, STRAY)
    found = cut(text, lambda split, state: PiecesToElements(split, state, key), starts, (0, 0), every)
    folder = new_path(spark, "elements")
    found.write.partitionBy("place").parquet(folder)
    found = spark.read.schema(found.schema).parquet(folder)
    of_place = lambda *places: found.filter(F.col("place").isin(*places))

    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    contexts = materialise(of_place(CONTEXT).select("file", "start", F.last("wanted", ignorenulls=True).over(before).alias("_known")))
    resolved = lambda rows: rows.join(contexts, ["file", "start"], "left").filter(F.coalesce("wanted", "_known", F.lit(False)))
    if not resolved(of_place(STRAY)).isEmpty():
        raise ValueError("a list of objects holds something else")
    whole = of_place(RECORD).select("file", "start", "wanted", "value")
    across = stitched(of_place(HEAD, TAIL), "")
    return resolved(whole.unionByName(across)).select(F.col("value").cast("string").alias("element"))
