import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from areaday.llm import decontamination as dc
from areaday.llm.fm_index import FMIndex, WaveletTree, suffix_array


def words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if ord(c) > 127 or c.isdigit() or "a" <= c <= "z":
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def brute(texts, items, window):
    windows = {}
    for item_id, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + window]), set()).add("" if item_id is None else str(item_id))
    result = []
    for doc_id, text in texts:
        w, hit, found = words(text), set(), set()
        for length in {len(k) for k in windows}:
            for i in range(len(w) - length + 1):
                if (ids := windows.get(tuple(w[i : i + length]))) is not None:
                    hit |= set(range(i, i + length))
                    found |= ids
        result.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(result, key=repr)


def run(spark, documents, texts, items, window=13, **options):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = dc.contamination(documents(texts), benchmark, window=window, **options)
    return sorted(
        ((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.withColumn("n_hit", dc.hit_words()).select("row.doc_id", "n_words", "n_hit", "items").collect()),
        key=repr,
    )


def random_case(seed):
    rng = random.Random(seed)
    draw = lambda n: " ".join(rng.choice(["a", "B", "c", "é", "d2"]) for _ in range(n))
    items = [(i, draw(rng.randint(0, 6))) for i in range(6)] + [(3, "a b"), (None, "c c a"), (9, None)]
    return [(i, draw(rng.randint(0, 60))) for i in range(25)], items


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block_bytes", [30, 4_000_000])
def test_equals_brute_force(spark, documents, seed, block_bytes):
    texts, items = random_case(seed)
    assert run(spark, documents, texts, items, 3, block_bytes=block_bytes) == brute(texts, items, 3)


def test_blocks_are_searched_in_one_pass(spark, documents, monkeypatch):
    texts, items = random_case(5)
    passes = []
    search = dc.search
    monkeypatch.setattr(dc, "search", lambda rows, row, blocks: passes.append(len(blocks)) or search(rows, row, blocks))
    size = sum(len((text or "").encode()) + 16 for _, text in set(items) if text is not None)
    assert run(spark, documents, texts, items, 3, block_bytes=-(-size // 3)) == brute(texts, items, 3) and passes == [3]


def test_all_words_are_indexed(sf, spark):
    texts = sorted({r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()})
    shard = dc.Shard()
    shard.add(texts + texts[:5])
    assert shard.indexed == sum(len(words(t)) for t in texts) and len(shard.n_words()) == len(texts) + 5
    ((first, index),) = shard.indexes(0)
    assert first == 0 and len(index.last) == shard.indexed + len(texts) + 1


def test_long_shards_are_indexed_in_parts(monkeypatch):
    monkeypatch.setattr(dc, "SHARD_WORDS", 7)
    texts, items = random_case(11)
    shard = dc.Shard()
    shard.add([text for _, text in texts])
    spans, found = shard.found([dc.Phrases([(str(i or ""), t) for i, t in items if t is not None], 3)])
    hit = [sum(x["end"] - x["start"] for x in s) for s in spans]
    expected = {r[0]: (r[2], r[3]) for r in brute(texts, [(i or "", t) for i, t in items], 3)}
    assert {i: (hit[i], found[i]) for i in range(len(texts))} == expected


def test_given_tables(spark, documents, sf):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    expected = brute(texts, items, 13)
    assert run(spark, documents, texts, items) == expected and any(r[2] for r in expected)


def test_small_shards_change_nothing(spark, documents, monkeypatch):
    texts, items = random_case(7)
    expected = run(spark, documents, texts, items, 3)
    monkeypatch.setattr(dc, "SHARD_DOCUMENTS", 2)
    assert run(spark, documents, texts, items, 3) == expected


@pytest.mark.parametrize(
    "texts, items",
    [
        ([], [(1, "a b")]),
        ([(1, None), (2, ""), (3, "..."), (None, "a b")], [(1, "a b"), (2, "")]),
        ([(1, "a b c")], []),
        ([(1, "x " * 30_000 + "a b " + "x " * 30_000), (1, "a b"), (1, "a b")], [(1, "A, b")]),
    ],
)
def test_odd_tables(spark, documents, texts, items):
    assert run(spark, documents, texts, items) == brute(texts, items, 13)


def test_kept_columns_may_have_any_name(spark, documents):
    docs = documents(["a b", "c"]).withColumn("spans", F.lit(1)).withColumn("row", F.lit(2)).withColumn("items", F.lit(3))
    benchmark = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    rows = dc.contamination(docs, benchmark, tuple(docs.columns)).collect()
    assert {(r.row.doc_id, r.row.row, r.row.spans, tuple(r["items"])) for r in rows} == {(0, 2, 1, ("1",)), (1, 2, 1, ())}


def test_contamination_rule(spark):
    rows = spark.createDataFrame([(0, 0), (1, 20), (1, 21), (5, 100), (0, 9)], "h long, n long")
    assert [r[0] for r in rows.select(dc.contaminated(F.col("h"), F.col("n"))).collect()] == [False, True, False, True, False]


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(1)
    for size in (1, 2, 17, 300):
        text = rng.integers(1, 4, size)
        index = FMIndex(text, 4, sample=5)
        for length in (1, 2, 4):
            phrase = rng.integers(1, 4, length)
            low, high = index.search(phrase[None], np.array([length]))
            at = sorted(index.locate(np.arange(low[0], high[0])).tolist())
            assert at == [i for i in range(size - length + 1) if (text[i : i + length] == phrase).all()]


def test_suffixes_and_ranks():
    text = np.array([2, 1, 2, 1, 2, 1, 0])
    assert suffix_array(text).tolist() == sorted(range(7), key=lambda i: text[i:].tolist())
    rng = np.random.default_rng(2)
    for size in (1, 5, 200):
        for text_ in (rng.integers(1, 3, size), np.ones(size, np.int64), rng.integers(1, 1 << 20, size)):
            whole = np.append(text_, 0)
            assert suffix_array(whole).tolist() == sorted(range(size + 1), key=lambda i: whole[i:].tolist())
    tree = WaveletTree(text, 3)
    assert tree.rank(np.array([1, 2, 0]), np.array([4, 3, 7])).tolist() == [2, 2, 1]
