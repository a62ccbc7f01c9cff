import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from areaday.llm import periodic_runs as pr
from areaday.llm.periodic_runs import LEAST, longest, periodic_runs, read_texts
from areaday.llm.queries import op13_periodic_runs, planted
from areaday.llm.residues import PRIMES, squared_differences, transform


def plain_runs(words):
    """``start, length, period`` of all runs: every period, smallest first, tried at every place."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - at >= max(LEAST, 2 * q):
                found.setdefault((at, end + q), q)
            at = end + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def random_words(rng):
    n, kinds = rng.choice([0, 1, 11, 12, 13, 30, 60, 130, 220]), rng.choice([1, 2, 3, 5, 50])
    words = [str(rng.randrange(kinds)) for _ in range(n)]
    if rng.random() < 0.6 and n > 3:
        first = rng.randrange(n)
        period = 1 + rng.randrange(max(1, (n - first) // 2))
        words = words[:first] + [words[first + (i - first) % period] for i in range(first, n)]
        if rng.random() < 0.3:
            words = [*words, "z", *words]
    return words


def check(texts):
    runs, collapsed = read_texts([" ".join(t) for t in texts])
    for words, found, left in zip(texts, runs, collapsed, strict=True):
        want = plain_runs(words)
        assert [(r["start"], r["length"], r["period"]) for r in found] == want
        assert left == plain_collapsed(words, want)


def test_runs_equal_those_of_all_periods():
    rng = random.Random(7)
    for _ in range(40):
        check([random_words(rng) for _ in range(20)])


def test_blocks_of_bounded_size_with_windows_in_pieces(monkeypatch):
    monkeypatch.setattr(pr, "TOP", 4)
    rng = random.Random(8)
    for _ in range(15):
        check([random_words(rng) for _ in range(12)])


def test_sums_beyond_a_prime_are_told_apart_by_further_ones(monkeypatch):
    # 5 * 15 = 75 is a multiple of every prime below in turn, so one prime alone would report matches.
    monkeypatch.setattr(pr, "PRIMES", (3, 5, 7, 786_433))
    seen = []

    def by_definition(blocks, windows, lags, prime):
        seen.append(prime)
        out = np.array([[((b - w[k : k + len(b)]) ** 2).sum() for k in range(lags)] for b, w in zip(blocks, windows, strict=True)])
        return out.reshape(len(blocks), lags) % prime

    monkeypatch.setattr(pr, "squared_differences", by_definition)
    rng = random.Random(9)
    check([random_words(rng) for _ in range(60)])
    assert {3, 5, 7, 786_433} <= set(seen)


@pytest.mark.parametrize("prime", PRIMES)
def test_sums_by_transforms_equal_sums(prime):
    rng = np.random.default_rng(prime)
    for length, lags in ((2, 7), (8, 16), (64, 128), (256, 512)):
        blocks = rng.integers(0, prime, (3, length)).astype(float)
        windows = rng.integers(0, prime, (3, lags + length - 1)).astype(float)
        got = squared_differences(blocks, windows, lags, prime)
        want = [[sum((int(b[k]) - int(w[d + k])) ** 2 for k in range(length)) % prime for d in range(lags)] for b, w in zip(blocks, windows, strict=True)]
        assert (got % prime == np.array(want)).all()


@pytest.mark.parametrize("size", [2, 128, 512, 32768])
def test_a_transform_is_undone_by_its_inverse(size):
    prime = PRIMES[0]
    rows = np.random.default_rng(size).integers(0, prime, (2, size)).astype(float)
    back = transform(transform(rows, size, prime), size, prime, inverse=True)
    assert ((back - rows * size) % prime == 0).all()


def test_repetitions_across_texts_are_none():
    words = [str(i) for i in range(6)]
    check([words, words, words, words])


def test_words_are_cut_at_ascii_white_space_only(spark, documents):
    text = "a\xa0b c\x1cd " * 6 + "\x0b\f\r\n\t"
    found = periodic_runs(documents([text])).first()
    assert [tuple(r) for r in found.runs] == [(0, 12, 2)] and found.collapsed == "a\xa0b c\x1cd"


def test_very_long_texts(documents):
    n = 300_000
    texts = ["a " * n, " ".join(str(i % 7) for i in range(n)), " ".join(str(i) for i in range(n // 2)) + " " + " ".join(str(i) for i in range(n // 2))]
    found = {r.row.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs(documents(texts)).collect()}
    assert found == {0: [(0, n, 1)], 1: [(0, n, 7)], 2: [(0, n, n // 2)]}


def test_nulls_repeated_rows_clashing_names_and_empty_tables(documents, rows):
    text = "x " * 12
    docs = documents([(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "a b")])
    for name in ("runs", "collapsed", "row", "start"):
        docs = docs.withColumn(name, F.lit("mine"))
    found = periodic_runs(docs, tuple(docs.columns)).select("row.doc_id", F.size("runs").alias("n"), "collapsed", "row.runs")
    assert rows(found) == sorted(
        [(1, 1, "x", "mine"), (1, 1, "x", "mine"), (None, 1, "x", "mine"), (2, 0, "", "mine"), (3, 0, "", "mine"), (4, 0, "a b", "mine")],
        key=repr,
    )
    assert periodic_runs(documents([])).count() == 0


def test_the_longest_run_by_length_then_start_then_period(spark):
    frame = spark.createDataFrame(
        [([(5, 12, 3), (2, 14, 7), (2, 14, 5), (9, 14, 1)],), ([],)], "runs array<struct<start: long, length: long, period: long>>"
    )
    assert [None if r.top is None else tuple(r.top) for r in frame.select(longest(F.col("runs")).alias("top")).collect()] == [(2, 14, 5), None]


def plain_planted(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_the_query_equals_a_plain_reading(spark, sf):
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    found = op13_periodic_runs(spark, sf).collect()
    assert len(found) == len(texts)
    for row in found:
        words = plain_planted(row.doc_id, texts[row.doc_id])
        if len(words) > 1500:  # the plain reading takes the square of the words
            continue
        runs = plain_runs(words)
        assert row.n_runs == len(runs)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        assert (row.start, row.length, row.period) == top
        assert row.exponent_milli == (1000 * top[1] // top[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()


def test_planting_of_odd_rows(documents, rows):
    docs = documents([(i, t) for i in range(40) for t in ("", None, "one", "a b c d e f g h i j")] + [(None, "a b c d")])
    got = docs.select("doc_id", "text", planted(F.col("doc_id"), F.coalesce("text", F.lit(""))).alias("planted")).collect()
    for row in got:
        assert row.planted.split() == plain_planted(row.doc_id, row.text)
