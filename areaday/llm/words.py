"""Words between ASCII white space, A-Z lowered, as 64-bit hashes that are computed for many texts side by side."""

from __future__ import annotations

import re

import numpy as np

from areaday.llm.common import mixed

_NEXT_SPACE = re.compile(rb"\s")
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LETTER = np.where(_SPACE, np.uint64(0), mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1))
_PIECE = 1 << 18


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The start and the hash of each word between white space, piece by piece of the bytes.

    A hash is the sum of a number per byte times a power for its place in the word, so all words are hashed at once.
    """
    starts, hashes, first = [], [], 0
    while first < len(text):
        last = first + _PIECE
        if last < len(text):  # go on to the end of the word
            found = _NEXT_SPACE.search(text, last)
            last = found.end() if found else len(text)
        piece = np.frombuffer(text[first:last], np.uint8)
        inside = ~_SPACE[piece]
        at = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1])))
        if len(at):
            lengths = np.diff(np.append(at, len(piece)))
            place = np.arange(at[0], len(piece), dtype=np.int64) - np.repeat(at, lengths)
            powers = np.cumprod(np.full(int(place.max()) + 1, 0xD6E8FEB86659FD93, np.uint64))
            numbers = _LETTER[piece[at[0] :]] * powers[place]
            starts.append(at + first)
            hashes.append(np.add.reduceat(numbers, at - at[0]))
        first = last
    none = np.empty(0, np.int64)
    return np.concatenate(starts or [none]), np.concatenate(hashes or [none.astype(np.uint64)])


def hashes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of all texts one after the other, and where the words of each text end."""
    encoded = [text.encode().lower() for text in texts]  # of bytes, lower() changes A-Z only
    starts, numbers = word_hashes(b"\n".join(encoded))
    return numbers, np.searchsorted(starts, np.cumsum([len(text) + 1 for text in encoded]))


class Places:
    """The place of each hash in a list of different hashes, by a table that is probed for many hashes at once."""

    def __init__(self, hashes: np.ndarray):
        self.bits = max(4, int(2 * len(hashes)).bit_length() + 1)
        self.hashes, self.slots = hashes, np.full(1 << self.bits, -1, np.int32)
        open_ = np.arange(len(hashes))
        at = self._first(hashes)
        while len(open_):  # each round, one of those that want a free slot gets it
            free = self.slots[at] < 0
            self.slots[at[free]] = open_[free]
            left = self.slots[at] != open_
            open_, at = open_[left], (at[left] + 1) & (len(self.slots) - 1)

    def _first(self, hashes: np.ndarray) -> np.ndarray:
        return (mixed(hashes) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        out, at = np.full(len(hashes), -1, np.int32), self._first(hashes)
        open_ = np.arange(len(hashes))
        while len(open_):
            place = self.slots[at]
            hit = place >= 0
            open_, at, place = open_[hit], at[hit], place[hit]
            same = self.hashes[place] == hashes[open_]
            out[open_[same]] = place[same]
            open_, at = open_[~same], (at[~same] + 1) & (len(self.slots) - 1)
        return out
