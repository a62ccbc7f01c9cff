"""Stretches of words that repeat with a period, by block convolution.

A run is a stretch of consecutive words whose smallest period ``q`` repeats at least twice, of at least ``LEAST`` words,
that no neighbouring word extends. Its words equal those ``q`` later over at least ``q`` places, so for periods from
``2B`` to ``4B - 1`` one of the blocks of ``B`` words lies within that stretch and occurs again ``q`` words later. At each
dyadic scale ``B`` the sums of squared differences of every block and the window that follows it are computed exactly by
number-theoretic transforms; where a sum is 0 the block occurs, and the distance seeds an extension to both sides, word by
word. Scale 2 also takes the periods below 4, as runs have 12 words at least.

Words are numbered within a text, so sums are below ``B`` times the squared number of different words. Where that exceeds
a prime, blocks with a residue of 0 are computed again modulo further primes until their product exceeds it: a zero is a
match, and no match is missed. Blocks are at most ``TOP`` words; for larger scales they lie further apart, and their
windows are taken in pieces. A multiple of a period gives the same stretch as the period itself and is left out.

The work is Python on Arrow batches of bounded size, without a shuffle. Texts are taken whole; a null or empty text, or
one of fewer than ``LEAST`` words, has no runs. Repeated rows are read one by one. Of runs with the greatest length, that
with the smallest start and then period is the longest. Other columns are not read, except that those named in ``keep``
are handed on in the struct ``row``. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaday.llm.common import carried, row_type, small_batches
from areaday.llm.residues import LONGEST, PRIMES, squared_differences

LEAST = 12
TOP = LONGEST // 4
#: Numbers in the arrays that are worked on at once.
CELLS = 1 << 17


def matching(numbers: np.ndarray, at: np.ndarray, lag: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from each place on, forwards or backwards, equal those ``lag`` later; ``room`` at most."""
    done = np.zeros(len(at), np.int64)
    open_, width = np.flatnonzero(room > 0), 8
    while len(open_):
        going = []
        for part in np.array_split(open_, max(1, len(open_) * width // CELLS)):
            offsets = done[part, None] + np.arange(width)
            places = np.clip(at[part, None] + step * offsets, 0, len(numbers) - 1)
            later = np.minimum(places + lag[part, None], len(numbers) - 1)
            same = (offsets < room[part, None]) & (numbers[places] == numbers[later])
            first = np.where(same.all(axis=1), width, same.argmin(axis=1))
            done[part] += first
            going.append(part[first == width])
        open_, width = np.concatenate(going), min(2 * width, CELLS)
    return done


class Words:
    """The words of several texts as numbers in one array."""

    def __init__(self, texts: list[list[bytes]]):
        sizes = np.array([len(words) for words in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.sizes = sizes
        self.numbers = np.zeros(int(sizes.sum()), np.int64)
        self.different = np.zeros(len(texts), np.int64)
        for i, words in enumerate(texts):
            if len(words) >= LEAST:
                known: dict[bytes, int] = {}
                self.numbers[self.starts[i] : self.ends[i]] = [known.setdefault(w, len(known)) for w in words]
                self.different[i] = len(known)

    def seeds(self, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of blocks, distances at which they occur again, and the ends of their texts."""
        length = min(scale, TOP)
        first, lags = (1, 7) if scale == 2 else (2 * scale, 2 * length)
        texts = np.flatnonzero(self.sizes >= max(LEAST, 4 * scale if scale > 2 else 0))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(texts):
            # The last block is followed by the shortest distance and a block in the same text.
            blocks = (self.sizes[texts] - first - length) // scale + 1
            owner = np.repeat(texts, blocks)
            at = self.starts[owner] + scale * (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks))
            limit, different = self.ends[owner], self.different[owner]
            for away in range(first, 4 * scale, lags):
                there = np.flatnonzero(at + away + length <= limit)
                for part in np.array_split(there, max(1, len(there) * (lags + length) // CELLS)):
                    row, lag = self._zeros(at[part], away, length, lags, limit[part], different[part])
                    found.append((at[part][row], away + lag, limit[part][row]))
        none = np.empty(0, np.int64)
        return tuple(map(np.concatenate, zip(*found, strict=True))) if found else (none, none, none)

    def _zeros(self, at, away, length, lags, limit, different) -> tuple[np.ndarray, np.ndarray]:
        """Rows and lags at which all words of a block occur again ``away`` and ``lag`` words later."""
        last = len(self.numbers) - 1
        rows, zero, modulus = np.arange(len(at)), None, 1
        for prime in PRIMES:
            if not len(rows):
                break
            block = self.numbers[at[rows, None] + np.arange(length)].astype(np.float64)
            window = np.minimum(at[rows, None] + away + np.arange(lags + length - 1), last)
            window = self.numbers[window].astype(np.float64)
            if modulus > 1 or different[rows].max() > prime:
                block, window = block % prime, window % prime
            hit = squared_differences(block, window, lags, prime) == 0
            if zero is None:
                # Windows may reach into the next text; a match may not.
                zero = hit & (at[:, None] + away + np.arange(lags) + length <= limit[:, None])
            else:
                zero[rows] &= hit
            modulus *= prime
            rows = np.flatnonzero(zero.any(axis=1) & (length * different.astype(np.float64) ** 2 >= modulus))
        return np.nonzero(zero) if zero is not None else (rows, rows)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and periods of all runs, by start and then period; places count over all texts."""
        none = np.empty(0, np.int64)
        starts, ends, periods = none, none, none
        scale = 2
        while len(self.sizes) and (scale == 2 or 4 * scale <= self.sizes.max()):
            start, end, period = self._extended(scale, starts, ends, periods)
            starts, ends, periods = map(np.concatenate, ((starts, start), (ends, end), (periods, period)))
            # The smallest of the distances that give a stretch is its period, and the others are multiples of it.
            order = np.lexsort((periods, ends, starts))
            starts, ends, periods = starts[order], ends[order], periods[order]
            new = np.ones(len(starts), bool)
            new[1:] = (starts[1:] != starts[:-1]) | (ends[1:] != ends[:-1])
            starts, ends, periods = starts[new], ends[new], periods[new]
            scale *= 2
        order = np.lexsort((periods, starts))
        return starts[order], ends[order], periods[order]

    def _extended(self, scale, starts, ends, periods) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The runs that the seeds of a scale lie in, without those within the runs given that have a period dividing theirs."""
        length = min(scale, TOP)
        at, lag, limit = self.seeds(scale)
        order = np.lexsort((at, lag))
        at, lag, limit = at[order], lag[order], limit[order]
        # Blocks side by side that occur at one distance are one stretch.
        head = np.ones(len(at), bool)
        head[1:] = (lag[1:] != lag[:-1]) | (at[1:] - at[:-1] != length)
        heads = np.flatnonzero(head)
        tails = np.append(heads[1:], len(at))[: len(heads)] - 1
        first, last, lag, limit = at[heads], at[tails] + length, lag[heads], limit[heads]

        keep, by_place = np.ones(len(first), bool), np.argsort(first, kind="stable")
        long = np.flatnonzero(ends - starts >= 3 * length)
        low, high = np.searchsorted(first[by_place], starts[long]), np.searchsorted(first[by_place], ends[long])
        for run, a, b in zip(long.tolist(), low.tolist(), high.tolist(), strict=True):
            inside = by_place[a:b]
            known = (lag[inside] % periods[run] == 0) & (first[inside] + lag[inside] + length <= ends[run])
            keep[inside[known]] = False
        first, last, lag, limit = first[keep], last[keep], lag[keep], limit[keep]

        text = np.searchsorted(self.ends, first, side="right")
        left = matching(self.numbers, first - 1, lag, first - self.starts[text], -1)
        right = matching(self.numbers, last, lag, limit - lag - last, 1)
        start, end = first - left, last + right + lag
        enough = end - start >= np.maximum(LEAST, 2 * lag)
        return start[enough], end[enough], lag[enough]


def read_texts(texts: list[str]) -> tuple[list[list[dict]], list[str]]:
    """Per text its runs, and its words without repetitions, joined by single spaces."""
    split = [text.encode().split() for text in texts]  # of bytes, split() cuts at ASCII white space only
    words = Words(split)
    starts, ends, periods = words.runs()
    runs: list[list[dict]] = [[] for _ in texts]
    owner = np.searchsorted(words.ends, starts, side="right")
    local = starts - words.starts[owner]
    for i, start, length, period in zip(owner.tolist(), local.tolist(), (ends - starts).tolist(), periods.tolist(), strict=True):
        runs[i].append({"start": start, "length": length, "period": period})
    cut = np.zeros(len(words.numbers) + 1, np.int64)
    np.add.at(cut, starts + periods, 1)
    np.add.at(cut, ends, -1)
    kept = np.cumsum(cut[:-1]) == 0
    collapsed = []
    for i, parts in enumerate(split):
        if runs[i]:
            keep = kept[words.starts[i] : words.ends[i]]
            parts = [w for w, k in zip(parts, keep.tolist(), strict=True) if k]
        collapsed.append(b" ".join(parts).decode())
    return runs, collapsed


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUNS = "array<struct<start: long, length: long, period: long>>"


def periodic_runs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row, runs, collapsed`` of every document.

    ``runs`` are ``start, length, period`` in words from 0, by start and then period; ``collapsed`` has the words that no run
    holds beyond its first period, joined by single spaces.
    """
    small_batches(docs.sparkSession)

    def read(frames):
        for frame in frames:
            runs, collapsed = read_texts(frame.column("text").to_pylist())
            yield pa.record_batch(
                [frame.column("row"), pa.array(runs, _RUNS), pa.array(collapsed, pa.string())],
                names=["row", "runs", "collapsed"],
            )

    rows = carried(docs, keep).select("row", "text")
    return rows.mapInArrow(read, f"row {row_type(docs, keep)}, runs {RUNS}, collapsed string")


def longest(runs: Column) -> Column:
    """The run of greatest length, then smallest start, then smallest period; null without runs."""
    ranked = F.transform(
        runs, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"), r.alias("run"))
    )
    return F.array_min(ranked)["run"]
