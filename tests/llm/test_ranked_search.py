import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from areaday.llm import ranked_search as rs
from areaday.llm.ranked_search import Shard, length_parts, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def plain_search(docs, items, k=50):
    """All scores of all pairs, sorted."""
    counted = [(doc_id, terms(text)) for doc_id, text in docs]
    counted = [(doc_id, found) for doc_id, found in counted if found]
    n_docs, total = len(counted), sum(len(found) for _, found in counted)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(terms(text))
    out = []
    for item_id, wanted in asked.items():
        weight = {}
        for term in wanted:
            df = sum(term in found for _, found in counted)
            weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        scored = []
        for doc_id, found in counted:
            m = 50 + 50 * len(found) * n_docs // total
            score = sum(w * (10**9 * found.count(t) // (1000 * found.count(t) + 20 * m)) for t, w in weight.items())
            if score > 0:
                scored.append((-score, doc_id is None, doc_id, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=repr)


@pytest.fixture
def benchmark(spark):
    return lambda items: spark.createDataFrame(items, "item_id long, text string")


def random_text(rng, words, n):
    return " ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=n))


def corpus(seed, n_docs):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["ÉTÉ", "Straße", "日本"]
    docs = [(i, random_text(rng, words, rng.randint(0, 60))) for i in range(n_docs)]
    docs += [(n_docs + i, docs[i][1]) for i in range(20)]  # ties
    items = [(i, random_text(rng, words, rng.randint(0, 12))) for i in range(12)]
    return docs, items


def test_ranks_equal_those_of_all_pairs(documents, benchmark, rows):
    docs, items = corpus(1, 250)
    for k in (1, 7, 50):
        found = ranked_search(documents(docs), benchmark(items), k)
        assert rows(found, "item_id", "rank", "doc_id", "score") == plain_search(docs, items, k)


def test_small_shards_and_blocks_change_nothing(spark, documents, benchmark, rows):
    docs, items = corpus(2, 120)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    found = ranked_search(documents(docs).coalesce(2), benchmark(items), 5, block_bytes=60, shard_documents=10)
    assert rows(found, "item_id", "rank", "doc_id", "score") == plain_search(docs, items, 5)


def shard_of(lists, n_docs, size):
    """A shard of documents 0 to ``n_docs`` from the documents of each term; every count is 1 and every length the same."""
    terms_of = [[t for t in range(size) if d in lists[t]] for d in range(n_docs)]
    arrays = [np.array(t, np.int32) for t in terms_of]
    return Shard(
        np.arange(n_docs), np.zeros(n_docs, bool), np.full(n_docs, 100, np.int64), arrays, [np.ones_like(a) for a in arrays], size
    )


def test_no_accumulators_are_made_once_they_cannot_reach_the_best():
    # Ten documents have the rare term; a thousand have only the frequent one, whose bound is far below.
    shard = shard_of([set(range(10)), set(range(1000))], 1000, 2)
    weight = np.array([1000, 10])
    found, scores = shard.search(np.array([0, 1]), weight, 5, 0)
    assert found.tolist() == list(range(10))
    share = 10**9 // (1000 + 20 * 100)
    assert scores.tolist() == [1010 * share] * 10  # survivors go on being updated
    found, _ = shard.search(np.array([0, 1]), weight, 11, 0)  # the eleventh best has the frequent term only
    assert len(found) == 1000


def test_a_newcomer_that_can_draw_level_still_gets_an_accumulator():
    # Document 5 has the second term only, whose weight is equal: its score equals those of 6 to 9, and its id is smaller.
    shard = shard_of([set(range(6, 10)), {5}], 10, 2)
    found, scores = shard.search(np.array([0, 1]), np.array([100, 100]), 4, 0)
    assert 5 in found.tolist() and len(set(scores.tolist())) == 1


def test_shards_share_the_limit_of_the_best_so_far():
    shard = shard_of([set(range(10)), set(range(1000))], 1000, 2)
    share = 10**9 // (1000 + 20 * 100)
    found, _ = shard.search(np.array([1]), np.array([1000, 10]), 5, 10 * share)
    assert len(found) == 1000  # the first list still counts in full
    found, _ = shard.search(np.array([0, 1]), np.array([1000, 10]), 500, 1000 * share)
    assert len(found) == 10  # too few for the 500th, but the limit is known


def test_random_shards_hold_the_best():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n_docs, size = int(rng.integers(1, 60)), int(rng.integers(1, 8))
        lists = [set(rng.choice(n_docs, rng.integers(0, n_docs + 1), replace=False).tolist()) for _ in range(size)]
        shard, weight = shard_of(lists, n_docs, size), rng.integers(1, 50, size)
        order = np.array(sorted(range(size), key=lambda t: len(lists[t])))
        k = int(rng.integers(1, 12))
        found, scores = shard.search(order, weight, k, 0)
        share = 10**9 // (1000 + 20 * 100)
        full = {d: sum(int(weight[t]) for t in range(size) if d in lists[t]) * share for d in range(n_docs)}
        top = sorted((x for x in full.items() if x[1]), key=lambda x: (-x[1], x[0]))[:k]
        got = sorted(zip(found.tolist(), scores.tolist(), strict=True), key=lambda x: (-x[1], x[0]))[:k]
        assert got == top
        assert all(full[d] == s for d, s in zip(found.tolist(), scores.tolist(), strict=True))


def test_very_long_documents_do_not_overflow():
    n = np.array([1, 3_000_000_000_000], np.int64)
    assert length_parts(n, 10**9, 4 * 10**12).tolist() == [50, 50 + 50 * 3_000_000_000_000 * 10**9 // (4 * 10**12)]


def test_nulls_ties_repeated_rows_and_empty_tables(spark, documents, benchmark, rows):
    docs = [(3, "apple pie"), (3, "apple pie"), (None, "Apple PIE"), (1, "apple pie"), (2, None), (4, "!!! ..."), (5, ""), (9, "x " * 30)]
    items = [(1, "APPLE apple"), (1, "pie"), (None, "pie"), (2, None), (3, "..."), (4, "none of these")]
    found = ranked_search(documents(docs), benchmark(items))
    assert rows(found, "item_id", "rank", "doc_id", "score") == plain_search(docs, items)
    assert [r.doc_id for r in found.filter("item_id = 1").orderBy("rank").collect()] == [1, 3, 3, None]
    assert ranked_search(documents([]), benchmark(items)).count() == 0
    assert ranked_search(documents(docs), benchmark([])).count() == 0


def test_columns_with_clashing_names_and_text_ids(spark, documents, rows):
    docs = documents([(1, "apple"), (2, "pear"), (3, "plum")])
    items = spark.createDataFrame([("a", "apple plum")], "item_id string, text string")
    for name in ("item_id", "n", "terms", "times", "score", "rank", "part"):
        docs = docs.withColumn(name, F.lit("x"))
    items = items.withColumn("doc_id", F.lit(1)).withColumn("score", F.lit(2))
    found = ranked_search(docs, items)
    assert [r[:2] for r in rows(found, "item_id", "doc_id", "rank")] == [("a", 1), ("a", 3)]


def test_the_merge_keeps_groups_small(documents, benchmark):
    docs, items = corpus(4, 50)
    plan = ranked_search(documents(docs), benchmark(items))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # partial tops before each exchange


def test_counts_are_those_of_the_whole_texts(documents):
    docs, items = corpus(5, 80)
    counted = rs.term_counts(documents(docs), rs.Queries(items))
    assert counted.count() == sum(1 for _, text in docs if terms(text))
    assert counted.agg(F.sum("n")).first()[0] == sum(len(terms(text)) for _, text in docs)
