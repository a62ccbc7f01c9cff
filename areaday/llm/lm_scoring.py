"""Log-likelihoods of whole documents by a gated recurrent language model that is trained here.

Words are told apart by 64-bit hashes and counted over all training documents. The ``SHORT`` most frequent words at most go to the tasks with their
counts; the ``MODEL_WORDS`` most frequent of these are the words of the recurrent model. All other words are one class
of its output, within which a word has the probability ``(c + 1) / (sum of c + 1 over them and one unknown word)``, so
the model spreads the probability of 1 over the known words and one unknown word, as the base model does. Counts of
words that are not sent are joined.

Every training document trains the model once: in each of ``ROUNDS`` rounds every task trains on its share of the
documents from the common weights by truncated backpropagation, and the weights are averaged by the tokens seen.

Training documents are those whose fold is not ``HELD`` of ``FOLDS``. Null texts count as empty and are one token, the
end. Rows that repeat are counted, trained on and scored one by one. A null ``doc_id`` is of fold 0. Without training
documents the counts are 0 and only the unknown word is left. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaday.llm.common import batches, fold, small_batches, summed, whole_text
from areaday.llm.gru import Model, Trainer, log_likelihoods
from areaday.llm.words import Places, hashes_of
from areaday.session import materialise

FOLDS, HELD = 7, 2
SHORT = 1 << 17
MODEL_WORDS = 1023
PER_CLASS = 32
HIDDEN, INPUTS = 24, 16
ROUNDS = 2
CHUNK_TOKENS = 1 << 22
#: The end of a document in place of the hash of a word.
END = 0
_LOG10 = np.log(10.0)


def word_counts(training: DataFrame) -> DataFrame:
    """``hash, c`` of every word of the texts, the end included; tasks count before they send."""

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["hash", "c"])

        for columns in batches(frames):
            held += [hashes_of(columns["text"])[0], np.full(len(columns["text"]), END, np.uint64)]
            size += len(held[-2])
            if size >= CHUNK_TOKENS:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return materialise(training.mapInArrow(count, "hash long, c long").groupBy("hash").agg(F.sum("c").alias("c")))


@dataclass
class Vocabulary:
    """``short`` has the place and the count of the sent words; places below ``words`` are words of the model."""

    hashes: np.ndarray
    counts: np.ndarray
    words: int
    tokens: int
    different: int

    @property
    def rest_weight(self) -> int:
        """The sum of c + 1 over the known words that are not words of the model, and the unknown word."""
        known = int((self.counts[: self.words] > 0).sum())
        return int(self.tokens - self.counts[: self.words].sum() + self.different - known + 1)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The most frequent words: those above the smallest count that lets at most ``SHORT`` pass."""
    step = F.floor(F.log2("c") * 16).cast("int").alias("step")
    sizes = sorted((r["step"], r["n"]) for r in counts.groupBy(step).agg(F.count("*").alias("n")).collect())
    kept, least = 0, 1 << 30
    for place, n in reversed(sizes):
        if kept + n > SHORT:
            break
        kept, least = kept + n, place
    rows = counts.filter((F.floor(F.log2("c") * 16) >= least) | (F.col("hash") == END)).collect()
    # The end is word 0, the others follow by count.
    rows.sort(key=lambda r: (r["hash"] != END, -r["c"], r["hash"]))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    hashes, found = [r["hash"] for r in rows], [r["c"] for r in rows]
    if not rows or hashes[0] != END:
        hashes, found = [END, *hashes], [0, *found]
    return Vocabulary(
        np.array(hashes, np.int64).view(np.uint64), np.array(found, np.int64), min(len(hashes), MODEL_WORDS), total[0], total[1]
    )


def new_model(words: Vocabulary) -> Model:
    model = Model(words.words, PER_CLASS, HIDDEN, INPUTS)
    model.start(words.counts[: words.words], words.rest_weight)
    return model


def numbers_of(places: np.ndarray, model: Model) -> np.ndarray:
    """A text as numbers of the model: its words, ``rest`` for any other, and the end."""
    return np.append(np.where((places < 0) | (places >= model.words), model.rest, places), 0).astype(np.int32)


def train(numbered: DataFrame, words: Vocabulary) -> Model:
    """The model after each training document, given as ``numbers``, has been trained on once."""
    model = new_model(words)
    context = numbered.sparkSession.sparkContext
    for turn in range(ROUNDS):
        sent = context.broadcast((words, model.flat))

        def run(frames: Iterator[pa.RecordBatch], sent=sent) -> np.ndarray:
            words, flat = sent.value
            model, tokens = new_model(words), 0
            model.set(flat)
            trainer, held, size = Trainer(model), [], 0

            def learn() -> None:
                trainer.train(held, max(8, min(512, len(held) // 4)))

            for frame in frames:
                held += read_numbers(frame)
                size += sum(map(len, held[len(held) - frame.num_rows :]))
                if size >= CHUNK_TOKENS:
                    learn()
                    tokens, held, size = tokens + size, [], 0
            if held:
                learn()
                tokens += size
            return np.append(model.flat.astype(np.float64) * tokens, tokens)

        part = numbered.select("numbers").filter(F.pmod(F.xxhash64("numbers"), F.lit(ROUNDS)) == turn)
        total = summed(part, run, len(model.flat) + 1, np.float64)
        if total[-1]:
            model.set(total[:-1] / total[-1])
    return model


def read_numbers(frame: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int16).astype(np.int32) for x in frame.column("numbers").to_pylist()]


_NUMBERED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_short", pa.int64()),
                       ("short_log", pa.float64()), ("n_rest", pa.int64()), ("rest_log", pa.float64()),
                       ("rare", pa.list_(pa.struct([("hash", pa.int64()), ("times", pa.int32())]))),
                       ("numbers", pa.binary())])
NUMBERED = (
    "row long, doc_id long, n_tokens long, n_short long, short_log double, n_rest long, rest_log double,"
    " rare array<struct<hash: long, times: int>>"
)


def number_documents(texts: DataFrame, words: Vocabulary) -> DataFrame:
    """Per document its ``numbers`` for the model, 16 bits each, the sums over sent words, and its other words' hashes.

    Texts are read and looked up here, once; training and scoring take the numbers.
    """
    sent = texts.sparkSession.sparkContext.broadcast(words)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value
        model, vocabulary = new_model(words), Places(words.hashes)
        logs = np.log10(words.counts + 1.0)
        known = words.counts > 0
        first, done = TaskContext.get().partitionId() << 33, 0

        def counted(doc_id: int | None, hashes: np.ndarray, places: np.ndarray) -> dict:
            short = np.append(places[places >= 0], 0)
            rare, times = np.unique(hashes[places < 0], return_counts=True)
            numbers = numbers_of(places, model)
            return {
                "doc_id": doc_id, "numbers": numbers.astype(np.int16).tobytes(), "n_tokens": len(numbers), "n_short": int(known[short].sum()),
                "short_log": float(logs[short].sum()), "n_rest": int((numbers == model.rest).sum()),
                "rest_log": float(logs[short[short >= words.words]].sum()),
                "rare": (rare.view(np.int64), times.astype(np.int32)),
            }

        for columns in batches(frames):
            hashes, ends = hashes_of(columns["text"])
            parts = zip(columns["doc_id"], np.split(hashes, ends[:-1]), np.split(vocabulary.find(hashes), ends[:-1]), strict=True)
            held = [counted(*part) for part in parts]
            if not held:
                continue
            rare = [row.pop("rare") for row in held]
            sizes = np.cumsum([0, *(len(hashes) for hashes, _ in rare)])
            pair = [pa.array(np.concatenate([x[i] for x in rare])) for i in (0, 1)]
            made = {name: [row[name] for row in held] for name in held[0]}
            made["row"] = first + done + np.arange(len(held))
            done += len(held)
            listed = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(pair, ["hash", "times"]))
            yield pa.record_batch([listed if f.name == "rare" else pa.array(made[f.name], f.type) for f in _NUMBERED], schema=_NUMBERED)

    return materialise(texts.select("doc_id", "text").mapInArrow(run, f"{NUMBERED}, numbers binary"))


def read_documents(numbered: DataFrame, words: Vocabulary, model: Model) -> DataFrame:
    """``numbered`` with what the model says of each document, as ``log_likelihood``, in place of its numbers."""
    sent = numbered.sparkSession.sparkContext.broadcast((words, model.flat))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, flat = sent.value
        model = new_model(words)
        model.set(flat)

        def finish() -> Iterator[pa.RecordBatch]:
            likely = np.split(log_likelihoods(model, texts), np.cumsum([frame.num_rows for frame in held])[:-1])
            for frame, found in zip(held, likely, strict=True):
                yield frame.drop_columns("numbers").append_column("log_likelihood", pa.array(found))

        held, texts, size = [], [], 0
        for frame in frames:
            held.append(frame)
            texts += read_numbers(frame)
            size += sum(map(len, texts[len(texts) - frame.num_rows :]))
            if size >= CHUNK_TOKENS:
                yield from finish()
                held, texts, size = [], [], 0
        if texts:
            yield from finish()

    return materialise(numbered.mapInArrow(run, f"{NUMBERED}, log_likelihood double"))


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    small_batches(docs.sparkSession)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    held_out = fold(F.col("doc_id"), FOLDS) == HELD
    training = texts.filter(~held_out)
    counts = word_counts(training)
    words = vocabulary(counts)
    numbered = number_documents(texts, words)
    model = train(numbered.filter(~held_out), words)
    read = read_documents(numbered, words, model)
    rare = read.select("row", F.explode("rare").alias("w")).select("row", "w.hash", "w.times")
    joined = rare.join(counts, "hash").groupBy("row").agg(
        F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("rare_log")
    )
    whole = read.drop("rare").join(materialise(joined), "row", "left").fillna({"rare_known": 0, "rare_log": 0.0})
    space = float(np.log10(words.tokens + words.different + 1))
    rest_space = float(np.log10(words.rest_weight))
    # Of the words that are not words of the model, some have their counts among those sent.
    return whole.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", (F.col("n_short") + F.col("rare_known")).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("short_log") + F.col("rare_log") - F.col("n_tokens") * F.lit(space)).alias("base_score"),
        (F.col("log_likelihood") / F.lit(float(_LOG10)) + F.col("rest_log") + F.col("rare_log") - F.col("n_rest") * F.lit(rest_space)).alias("score"),
    )
