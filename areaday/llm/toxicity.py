"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased, and everything in ASCII but letters and digits becomes a space. The features are whether a text
holds an n-gram of ``ORDERS`` characters, hashed to 2^``BITS`` numbers. Each is scaled by the logarithm of how much more
often it is in toxic than in other training texts, and a logistic regression is fitted on the scaled features.

The fit takes about ``FIT_ROWS`` labelled texts at most, and the ``FEATURES`` whose shares differ the most; scoring
covers every whole text. Nothing but the text goes into a score. Null and empty texts have no n-grams and get the score
of the intercept. Repeated rows get equal scores. Without labels of both kinds every score is 0 or 1, as all labels are,
or 0 without any. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaday.llm.common import batches, carried, labelled, row_type, small_batches, summed

ORDERS = (3, 4, 5)
BITS = 18
FIT_ROWS = 20_000
FEATURES = 1 << 13
LEAST_TEXTS = 3
PENALTY = 1e-4
ROUNDS = 150
TOXIC = 0.3
_FIT_CHUNK = 1000

_KEEP = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_STEP, _MIX = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def ngrams(text: str) -> np.ndarray:
    """The hashed n-grams of a text, with repeats."""
    clean = b" ".join((b"", *text.lower().encode("utf-8", "replace").translate(_KEEP).split(), b""))
    codes = np.frombuffer(clean.decode().encode("utf-32-le"), np.uint32)
    rolled, found = codes, []
    for order in range(2, max(ORDERS) + 1):
        if len(codes) < order:
            break
        rolled = rolled[:-1] * _STEP + codes[order - 1 :]
        if order in ORDERS:
            found.append((((rolled + np.uint32(order)) * _MIX) >> np.uint32(32 - BITS)).astype(np.int32))
    return np.concatenate(found) if found else np.empty(0, np.int32)


@dataclass
class Model:
    """``column`` has the place of each hashed n-gram among the weights, or -1."""

    column: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, text: str) -> float:
        columns = self.column[ngrams(text)]
        present = np.unique(columns[columns >= 0])
        return float(1 / (1 + np.exp(-np.clip(self.intercept + self.weights[present].sum(), -700, 700))))


def texts_with(rows: DataFrame) -> np.ndarray:
    """For both labels: how many texts hold each n-gram, and last how many texts there are."""
    width = (1 << BITS) + 1

    def count(frames):
        counts = np.zeros(2 * width, np.int64)
        for columns in batches(frames):
            for text, label in zip(columns["text"], columns["label"], strict=True):
                first = width * (label > 0)
                counts[first + np.unique(ngrams(text))] += 1
                counts[first + width - 1] += 1
        return counts

    return summed(rows, count, 2 * width).reshape(2, width)


def fit_weights(columns: list[np.ndarray], ratios: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on presence times ``ratios`` with an L2 penalty, by Adam over all rows.

    Rows are gone through in chunks, so that beside the columns little is held at once.
    """
    n, chunks = len(columns), []
    for start in range(0, n, _FIT_CHUNK):
        part = columns[start : start + _FIT_CHUNK]
        chunks.append((slice(start, start + len(part)), np.concatenate(part), np.array([len(c) for c in part])))
    weights, intercept = np.zeros(len(ratios) + 1), np.log(labels.sum() / (n - labels.sum()))
    weights[-1] = intercept
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, ROUNDS + 1):
        slope, scaled = np.zeros_like(weights), weights[:-1] * ratios
        for rows, flat, sizes in chunks:
            held = sizes > 0
            margin = np.full(len(sizes), weights[-1])
            if held.any():
                margin[held] += np.add.reduceat(scaled[flat], (np.cumsum(sizes) - sizes)[held])
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[rows]
            slope[:-1] += np.bincount(flat, np.repeat(error, sizes), len(ratios))
            slope[-1] += error.sum()
        slope[:-1] = slope[:-1] * ratios + n * PENALTY * weights[:-1]
        slope /= n
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        weights = weights - 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return weights[:-1] * ratios, float(weights[-1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = FIT_ROWS) -> Model:
    small_batches(docs.sparkSession)
    rows = labelled(docs, labels, label, limit)
    counts = texts_with(rows)
    n = counts[:, -1]
    if not n[0] or not n[1]:
        return Model(np.full(1 << BITS, -1, np.int32), np.empty(0), 700.0 if n[1] else -700.0)
    held = counts[:, :-1]
    ratio = np.log((held[1] + 1) / (n[1] + 2)) - np.log((held[0] + 1) / (n[0] + 2))
    share = held.sum(axis=0) / n.sum()
    apart = (held[1] / n[1] - held[0] / n[0]) ** 2 / np.maximum(share * (1 - share), 1e-9)
    apart[held.sum(axis=0) < LEAST_TEXTS] = 0
    chosen = np.sort(np.argsort(-apart, kind="stable")[:FEATURES])
    chosen = chosen[apart[chosen] > 0]
    column = np.full(1 << BITS, -1, np.int32)
    column[chosen] = np.arange(len(chosen))
    sent = docs.sparkSession.sparkContext.broadcast(column)

    def present(frames):
        for columns in batches(frames):
            found = [sent.value[ngrams(text)] for text in columns["text"]]
            blobs = [np.unique(c[c >= 0]).astype(np.int32).tobytes() for c in found]
            yield pa.record_batch([pa.array(blobs, pa.binary()), pa.array(columns["label"], pa.int32())], names=["columns", "label"])

    fit = rows.mapInArrow(present, "columns binary, label int").limit(2 * limit).toArrow()
    held = [np.frombuffer(blob, np.int32) for blob in fit["columns"].to_pylist()]
    weights, intercept = fit_weights(held, ratio[chosen], (fit["label"].to_numpy() > 0).astype(float))
    return Model(column, weights, intercept)


def toxicity(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` with the columns of ``keep``, and the ``score`` of every document."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames):
        for frame in frames:
            scores = [sent.value.score(text) for text in frame.column("text").to_pylist()]
            yield pa.record_batch([frame.column("row"), pa.array(scores, pa.float64())], names=["row", "score"])

    return carried(docs, keep).mapInArrow(run, f"row {row_type(docs, keep)}, score double")


def rejected(score):
    return F.coalesce(score >= TOXIC, F.lit(False))
