"""Ranked lexical search, term at a time, with accumulators only for documents that can still get among the best.

A query is the set of an item's terms. Its postings are read rarest term first. While the bounds of the terms still to
come add up to the ``k``-th best partial score so far or more, documents met for the first time get an accumulator;
afterwards no document outside can reach the best, and the rest of the postings only updates the accumulators there are,
so the scores of the survivors are exact. Bounds are a term's weight times the greatest share any document of the shard
gives it.

Documents are read once for each block of items (at most ``BLOCK_BYTES`` of their text, which bounds what is broadcast):
their counts of the block's terms go to a table in the shared folder, from which document frequencies are added up and
each task inverts its part, in shards of bounded size. A task keeps the best ``k`` per item over its shards, whose worst
also limits new accumulators; the bests of all tasks are merged by hash groups of documents first, so that no group
grows with the number of tasks.

Terms are stretches of ASCII letters and digits and of all that is not ASCII, with A-Z lowered. Null texts have no terms;
items and documents without terms match nothing. Rows that repeat a ``doc_id`` are documents of their own. Rows that share
an ``item_id``, null included, are one item with the terms of all of them. Equal scores go by ascending ``doc_id``, null
last. Ids of documents are whole numbers. Other columns are not read. An empty table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from areaday.llm.common import small_batches, summed, whole_text
from areaday.llm.decontamination import plain_words
from areaday.session import materialise

BEST = 50
BLOCK_BYTES = 4_000_000
SHARD_POSTINGS = 1 << 21
SHARD_DOCUMENTS = 1 << 16
MERGE_GROUPS = 64


class Queries:
    """The items of a block, and the numbers of their terms."""

    def __init__(self, items: list[tuple[object, str]]):
        terms: dict[object, set[bytes]] = {}
        for item_id, text in items:
            terms.setdefault(item_id, set()).update(plain_words(text))
        self.number = {term: i for i, term in enumerate(sorted(set().union(*terms.values())))} if terms else {}
        self.ids = list(terms)
        self.terms = [np.array(sorted(self.number[t] for t in found), np.int64) for found in terms.values()]


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[object, str]]]:
    """The rows of items in blocks of about ``block_bytes`` of text, fetched one at a time; an item is in one block."""
    rows = items.select(items["item_id"].alias("item_id"), items["text"].alias("text")).filter(F.col("text").isNotNull()).distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    count = max(1, math.ceil(size / block_bytes))
    place = F.pmod(F.xxhash64("item_id"), F.lit(count))
    for block in range(count):
        yield [(r["item_id"], r["text"]) for r in rows.filter(place == block).collect()]


def term_counts(docs: DataFrame, queries: Queries) -> DataFrame:
    """``doc_id, n, terms, times`` of documents with terms: ``n`` of all, the numbers of those asked for, and their counts."""
    sent = docs.sparkSession.sparkContext.broadcast(queries.number)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))

    def count(frames):
        number = sent.value
        look, size = number.get, max(1, len(number))
        for frame in frames:
            words = [plain_words(text) for text in frame.column("text").to_pylist()]
            n = np.array([len(w) for w in words], np.int64)
            found = np.array([look(w, -1) for one in words for w in one], np.int64)
            keys, times = np.unique((np.repeat(np.arange(len(n)), n) * size + found)[found >= 0], return_counts=True)
            ends = np.searchsorted(keys, np.arange(1, len(n) + 1) * size)
            terms, times = (keys % size).astype(np.int32), times.astype(np.int32)
            starts = np.concatenate(([0], ends[:-1])) if len(n) else ends
            bounds = list(zip(starts.tolist(), ends.tolist(), strict=True))
            out = pa.record_batch(
                [frame.column("doc_id"), pa.array(n), pa.array([terms[a:b].tobytes() for a, b in bounds], pa.binary()),
                 pa.array([times[a:b].tobytes() for a, b in bounds], pa.binary())],
                names=["doc_id", "n", "terms", "times"],
            )
            yield out.filter(pa.array(n > 0))

    return rows.mapInArrow(count, "doc_id long, n long, terms binary, times binary")


def document_frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """In how many rows each term number occurs."""

    def count(frames):
        total = np.zeros(size, np.int64)
        for frame in frames:
            for terms in frame.column(0).to_pylist():
                total[np.frombuffer(terms, np.int32)] += 1
        return total

    return summed(counted.select("terms"), count, size)


def weights(documents: int, frequencies: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequencies.tolist()], np.int64)


def length_parts(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The part of each document's length in its score: 50 for none, 100 for the average."""
    if 50 * int(n.max(initial=0)) * documents < 1 << 63:
        return 50 + (50 * n * documents) // total
    return np.array([50 + 50 * x * documents // total for x in n.tolist()], np.int64)


class Shard:
    """Inverted lists of some documents: per term the places of its documents, in order, and what it gives them."""

    def __init__(self, doc_ids, missing, parts, terms, times, size):
        self.doc_ids, self.missing = doc_ids, missing
        counts = np.array([len(t) for t in terms], np.int64)
        owner = np.repeat(np.arange(len(counts)), counts)
        term = np.concatenate(terms) if terms else np.empty(0, np.int32)
        time = (np.concatenate(times) if times else np.empty(0, np.int32)).astype(np.int64)
        order = np.argsort(term, kind="stable")
        self.places = owner[order].astype(np.int32)
        self.shares = ((1_000_000_000 * time) // (1000 * time + 20 * parts[owner]))[order]
        self.bounds = np.searchsorted(term[order], np.arange(size + 1))
        self.most = np.zeros(size, np.int64)
        present = np.flatnonzero(np.diff(self.bounds))
        if len(present):
            self.most[present] = np.maximum.reduceat(self.shares, self.bounds[present])
        # Scratch space of all searches, cleared after each.
        self.score = np.zeros(len(counts), np.int64)
        self.has = np.zeros(len(counts), bool)

    def search(self, terms: np.ndarray, weight: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the documents with accumulators; ``terms`` come rarest first.

        All that belong to the best ``k`` are among them, save some with scores below ``floor``.
        """
        terms = terms[self.bounds[terms] < self.bounds[terms + 1]]
        limits = weight[terms] * self.most[terms]
        rest = np.cumsum(limits[::-1])[::-1] - limits
        creating, greatest, held = True, 0, np.empty(0, np.int64)
        for term, left in zip(terms.tolist(), rest.tolist(), strict=True):
            span = slice(self.bounds[term], self.bounds[term + 1])
            places, shares = self.places[span], self.shares[span]
            if creating:
                self.score[places] += weight[term] * shares
                self.has[places] = True
                greatest = max(greatest, int(self.score[places].max()))
                if left < max(greatest, floor):
                    held = np.flatnonzero(self.has)
                    partial = self.score[held]
                    kth = int(np.partition(partial, len(held) - k)[len(held) - k]) if len(held) >= k else 0
                    # A newcomer could at most draw level with the k-th where bounds are equal, and win by its id.
                    creating = left >= max(kth, floor)
            elif len(held) * 16 < len(places):
                at = np.minimum(np.searchsorted(places, held), len(places) - 1)
                there = places[at] == held
                self.score[held[there]] += weight[term] * shares[at[there]]
            else:
                there = self.has[places]
                self.score[places[there]] += weight[term] * shares[there]
        found = np.flatnonzero(self.has)
        scores = self.score[found]
        self.score[found] = 0
        self.has[found] = False
        return found, scores


def best_of(scores: np.ndarray, doc_ids: np.ndarray, missing: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` greatest scores above 0; equal ones by id, missing ids last."""
    order = np.lexsort((doc_ids, missing, -scores))[:k]
    return order[scores[order] > 0]


def search_block(
    counted: DataFrame, queries: Queries, id_type: str, documents: int, total: int, k: int, shard_documents: int
) -> DataFrame:
    """``item_id, doc_id, score``: for each item the best ``k`` documents of each task."""
    size = len(queries.number)
    frequencies = document_frequencies(counted, size)
    weight = weights(documents, frequencies)
    rarest_first = [t[np.lexsort((t, frequencies[t]))] for t in queries.terms]
    rarest_first = [t[(frequencies[t] > 0) & (weight[t] > 0)] for t in rarest_first]
    sent = counted.sparkSession.sparkContext.broadcast((weight, rarest_first, queries.ids))
    arrow_id = pa.int64() if id_type in ("bigint", "int", "smallint", "tinyint") else None

    def run(frames):
        weight, items, ids = sent.value
        none = np.empty(0, np.int64)
        best = [(none, none, none.astype(bool))] * len(items)  # scores, ids, whether the id is missing

        def add(rows):
            doc_ids, missing, n, terms, times = (np.concatenate(x) if i < 3 else sum(x, []) for i, x in enumerate(zip(*rows, strict=True)))
            shard = Shard(doc_ids, missing, length_parts(n, documents, total), terms, times, size)
            for i, asked in enumerate(items):
                scores, held, gone = best[i]
                found, new = shard.search(asked, weight, k, int(scores[-1]) if len(scores) == k else 0)
                if len(found):
                    scores, held = np.concatenate((scores, new)), np.concatenate((held, doc_ids[found]))
                    gone = np.concatenate((gone, missing[found]))
                    top = best_of(scores, held, gone, k)
                    best[i] = scores[top], held[top], gone[top]

        rows, postings, many = [], 0, 0
        for frame in frames:
            ids_there = frame.column("doc_id")
            terms, times = ([np.frombuffer(x, np.int32) for x in frame.column(c).to_pylist()] for c in ("terms", "times"))
            rows.append((ids_there.fill_null(0).to_numpy(), ids_there.is_null().to_numpy(zero_copy_only=False),
                         frame.column("n").to_numpy(), terms, times))
            postings += sum(map(len, terms))
            many += frame.num_rows
            if postings >= SHARD_POSTINGS or many >= shard_documents:
                add(rows)
                rows, postings, many = [], 0, 0
        if many:
            add(rows)
        for item_id, (scores, held, gone) in zip(ids, best, strict=True):
            if len(scores):
                yield pa.record_batch(
                    [pa.array([item_id] * len(scores), arrow_id), pa.array(held, mask=gone), pa.array(scores)],
                    names=["item_id", "doc_id", "score"],
                )

    return counted.mapInArrow(run, f"item_id {id_type}, doc_id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` per item with their ranks, merged by hash groups of documents before they are merged per item."""
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    group = F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_GROUPS))
    dealt = found.withColumn("part", group)
    first = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order)))
    few = first.filter(F.col("rank") <= k).drop("part", "rank")
    last = few.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return last.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = BEST, block_bytes: int = BLOCK_BYTES, shard_documents: int = SHARD_DOCUMENTS
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item with scores above 0; ranks start at 1."""
    if k < 1:
        raise ValueError("k must be positive")
    small_batches(docs.sparkSession)
    id_type = items.schema["item_id"].dataType.simpleString()
    result = None
    for block in item_blocks(items, block_bytes):
        queries = Queries(block)
        counted = materialise(term_counts(docs, queries))
        documents, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        found = ranked(search_block(counted, queries, id_type, documents, total, k, shard_documents), k)
        result = found if result is None else result.unionByName(found)
    return result
