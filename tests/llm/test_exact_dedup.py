import hashlib

import pytest
from pyspark.sql import functions as F

from areaday.llm import exact_dedup as ed


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(pairs):
    groups = {}
    for doc_id, text in pairs:
        groups.setdefault(lowered(text), []).append(doc_id)
    out = []
    for doc_id, text in pairs:
        ids = groups[lowered(text)]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(lowered(text).encode()).hexdigest()))
    return sorted(out, key=repr)


CASES = [
    [],
    [(1, None), (2, ""), (3, " ")],
    [(1, "Abc É"), (5, "aBC É"), (3, "abc é"), (4, "abc É")],
    [(1, "x"), (1, "x"), (None, "x"), (None, "y")],
    [(i, f"t{i % 7}") for i in range(300)] + [(1000 + i, "hot") for i in range(200)],
    [(1, "long " * 40_000), (2, "LONG " * 40_000)],
]


@pytest.mark.parametrize("pairs", CASES)
@pytest.mark.parametrize("capacity", [2, 50_000])
def test_equals_brute_force(documents, rows, pairs, capacity):
    found = ed.exact_dedup(documents(pairs), capacity)
    assert rows(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute(pairs)


def test_buckets_split_until_none_is_overfull(documents):
    found = ed.entries(documents([f"text {i}" for i in range(500)]))
    buckets, depth = ed.directory(found, 4)
    rows = buckets.collect()
    assert sum(r.n for r in rows) == 500 and max(r.n for r in rows) <= 4 and len({r.depth for r in rows}) > 1
    # The buckets cover every slot of the deepest directory at most once.
    slots = [s for r in rows for s in range(r.prefix << (depth - r.depth), (r.prefix + 1) << (depth - r.depth))]
    assert len(slots) == len(set(slots))


def test_texts_of_one_key_are_chained(documents, rows, monkeypatch):
    monkeypatch.setattr(ed, "key_of", lambda text: F.length(text).cast("long"))
    pairs = [(1, "ab"), (2, "cd"), (3, "AB"), (4, "xyz")]
    # "ab" and "cd" have the key 2, "xyz" has 3; which of the two comes first depends on their digests.
    found = rows(ed.index(documents(pairs), 1)[0], "chain", "group_size")
    assert sorted(chain for chain, _ in found) == [0, 0, 1] and sorted(size for _, size in found) == [1, 1, 2]
    assert rows(ed.exact_dedup(documents(pairs), 1), "doc_id", "keep_id") == [(1, 3), (2, 2), (3, 3), (4, 4)]


@pytest.mark.parametrize("capacity", [1, 50_000])
def test_bytes_decide_within_a_chain(documents, rows, monkeypatch, capacity):
    monkeypatch.setattr(ed, "key_of", lambda text: F.pmod(F.length(text), F.lit(3)).cast("long") * (1 << 61))
    pairs = [(i, chr(97 + i % 5) * (1 + i % 4)) for i in range(80)] + [(None, "A"), (200, None), (201, "")]
    assert ed.index(documents(pairs), capacity)[0].agg(F.max("texts")).first()[0] > 5
    found = ed.exact_dedup(documents(pairs), capacity)
    assert rows(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute(pairs)


def test_the_result_comes_from_the_index(documents, rows):
    docs = documents([f"text {i % 60}" for i in range(100)])
    found, slots, depth = ed.index(docs, 4)
    whole = rows(ed.probe(docs, found, slots, depth))
    assert depth > 1 and len(whole) == 100
    # Without one bucket its rows find nothing; with the buckets of two slots exchanged neither's do.
    lost = found.groupBy("bucket").agg(F.sum("group_size").alias("n")).orderBy("bucket").first()
    left = rows(ed.probe(docs, found.filter(found["bucket"] != lost.bucket), slots, depth))
    assert len(left) == 100 - lost.n and set(left) < set(whole)
    a, b = [r.bucket for r in slots.select("bucket").distinct().orderBy("bucket").limit(2).collect()]
    other = F.when(F.col("bucket") == a, b).when(F.col("bucket") == b, a).otherwise(F.col("bucket"))
    assert len(rows(ed.probe(docs, found, slots.withColumn("bucket", other), depth))) < 100
    # What a bucket says of a key is what its rows get.
    changed = found.withColumn("keep_id", F.lit(-1).cast("long"))
    assert {r[1] for r in rows(ed.probe(docs, changed, slots, depth))} == {-1}


def test_buckets_cover_ranges_of_keys_in_order(documents):
    found, slots, depth = ed.index(documents([f"text {i}" for i in range(300)]), 10)
    ranges = found.groupBy("bucket").agg(F.min("key").alias("low"), F.max("key").alias("high")).orderBy("bucket").collect()
    unsigned = [(r.low % (1 << 64), r.high % (1 << 64)) for r in ranges if (r.low < 0) == (r.high < 0)]
    assert all(x[1] < y[0] for x, y in zip(unsigned, unsigned[1:])) and len(ranges) > 30
    assert slots.count() == slots.select("slot").distinct().count() <= 1 << depth


def test_only_texts_of_repeated_keys_move(documents):
    found = ed.index(documents([f"text {i}" for i in range(50)] + ["text 1"]))[0]
    assert found.filter("norm is not null").isEmpty() and found.agg(F.sum("group_size")).first()[0] == 51
    assert ed.entries(documents(["a", "A", "b"])).count() == 2


def test_extra_columns_and_no_python(documents):
    docs = documents(["a", "A"]).withColumn("key", F.lit(1)).withColumn("norm", F.lit("n")).withColumn("kept", F.lit(0))
    found = ed.exact_dedup(docs)
    assert found.count() == 2
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
