"""Exact sums by number-theoretic transforms, for many rows at once.

A transform of up to ``DIRECT`` numbers is one product with the matrix of the powers of a root of unity; a longer one is
split into two shorter ones and a twist between them. All numbers are below a prime of less than 23 bits and at most 128
products are added, so sums stay below 2^53 and float64 holds them exactly. Residues are those closest to 0.
"""

from __future__ import annotations

from functools import cache

import numpy as np

DIRECT = 128
#: Each prime is a multiple of 2^18 and 1, so it has roots of unity of all sizes up to 2^18.
PRIMES = (7_340_033, 5_767_169, 786_433)
LONGEST = 1 << 18


def reduced(numbers: np.ndarray, prime: int) -> np.ndarray:
    """Whole numbers below 2^53 in size modulo ``prime``, in place, as the residues closest to 0; multiples become 0."""
    times = numbers * (1.0 / prime)
    np.rint(times, out=times)
    times *= prime
    numbers -= times
    return numbers


@cache
def root(size: int, prime: int) -> int:
    """A number whose first power to be 1 modulo ``prime`` is that of ``size``, a power of two."""
    for base in range(2, prime):
        found = pow(base, (prime - 1) // size, prime)
        if size == 1 or pow(found, size // 2, prime) == prime - 1:
            return found
    raise ValueError(f"no root of order {size} modulo {prime}")


@cache
def powers(rows: int, columns: int, size: int, prime: int, inverse: bool) -> np.ndarray:
    """The matrix of ``w^(row * column)`` for the root ``w`` of ``size``, or for its inverse."""
    base = root(size, prime)
    base = pow(base, prime - 2, prime) if inverse else base
    line, at = np.ones(size, np.int64), 1
    while at < size:  # w^0 to w^(at-1) give the next as many
        line[at : 2 * at] = line[:at] * pow(base, at, prime) % prime
        at *= 2
    places = np.arange(rows, dtype=np.int64)[:, None] * np.arange(columns, dtype=np.int64)
    return line[places % size].astype(np.float64)


def transform(rows: np.ndarray, size: int, prime: int, inverse: bool = False) -> np.ndarray:
    """The transform of each row, which counts as filled up to ``size`` with 0; not divided by ``size``."""
    given = rows.shape[1]
    if size <= DIRECT:
        return reduced(rows @ powers(given, size, size, prime, inverse), prime)
    if given < size:
        rows = np.concatenate((rows, np.zeros((len(rows), size - given))), axis=1)
    first, rest = DIRECT, size // DIRECT
    # Number s = s1 * rest + s2 goes to place k = k1 + first * k2.
    parts = rows.reshape(-1, first, rest).transpose(0, 2, 1) @ powers(first, first, first, prime, inverse)
    parts = reduced(reduced(parts, prime) * powers(rest, first, size, prime, inverse), prime)
    done = transform(parts.transpose(0, 2, 1).reshape(-1, rest), rest, prime, inverse)
    return done.reshape(-1, first, rest).transpose(0, 2, 1).reshape(-1, size)


def squared_differences(blocks: np.ndarray, windows: np.ndarray, lags: int, prime: int) -> np.ndarray:
    """For each row and lag, the sum of squared differences of the block and the window from there, as a residue.

    ``windows`` have at least ``lags`` and the block's length less 1 numbers; all are whole and below ``prime``.
    """
    length = blocks.shape[1]
    if windows.shape[1] < lags + length - 1:
        raise ValueError("windows are too short")
    size = 1 << (windows.shape[1] - 1).bit_length()
    if size > LONGEST:
        raise ValueError(f"windows of more than {LONGEST} numbers")
    spectrum = transform(blocks, size, prime, inverse=True)
    spectrum = reduced(spectrum * transform(windows, size, prime), prime)
    products = transform(spectrum, size, prime, inverse=True)[:, :lags]
    products = reduced(products * float(pow(size, prime - 2, prime)), prime)
    squares = np.cumsum(np.pad(reduced(windows * windows, prime), ((0, 0), (1, 0))), axis=1)
    own = reduced(blocks * blocks, prime).sum(axis=1, keepdims=True)
    return reduced(own + squares[:, length : length + lags] - squares[:, :lags] - 2 * products, prime)
