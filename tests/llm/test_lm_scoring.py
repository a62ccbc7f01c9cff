import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from areaday.llm import gru
from areaday.llm import lm_scoring as lm


def small_model(words=7, seed=1):
    model = gru.Model(words, per_class=3, hidden=4, inputs=3)
    rng = np.random.default_rng(seed)
    model.start(rng.integers(1, 20, words), 9.0)
    model.flat += rng.normal(0, 0.3, len(model.flat)).astype(np.float32)
    model.word_b[-1, words % 3 :] = -1e4
    return model


def naive(model, text):
    """The log-probability of one text, word by word."""
    state, word, total = np.zeros(model.hidden), 0, 0.0
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    h = model.hidden
    for y in text:
        given, own = model.embed[word] @ model.w + model.b, state @ model.u
        z, r = sigmoid(given[:h] + own[:h]), sigmoid(given[h : 2 * h] + own[h : 2 * h])
        new = np.tanh(given[2 * h :] + r * own[2 * h :])
        state = (1 - z) * new + z * state
        logits = state @ model.class_w + model.class_b
        group = min(y // model.per_class, model.classes)
        total += logits[group] - np.log(np.exp(logits).sum())
        if group < model.classes:
            logits = state @ model.word_w[group] + model.word_b[group]
            total += logits[y % model.per_class] - np.log(np.exp(logits).sum())
        word = y
    return total


def random_texts(model, n=40):
    rng = random.Random(3)
    choices = [*range(1, model.words), model.rest]
    return [np.array([*(rng.choice(choices) for _ in range(rng.choice([0, 1, 5, 40, 90]))), 0]) for _ in range(n)]


def test_whole_texts_across_windows_and_lanes(monkeypatch):
    model = small_model()
    texts = random_texts(model)
    expected = [naive(model, t) for t in texts]
    for lanes, window in ((1, 4), (7, 16), (512, 3)):
        monkeypatch.setattr(gru, "LANES", lanes)
        monkeypatch.setattr(gru, "WINDOW", window)
        assert np.allclose(gru.log_likelihoods(model, texts), expected, rtol=1e-4)
    assert len(gru.log_likelihoods(model, [])) == 0


def test_probabilities_of_all_words_sum_to_one():
    model = small_model()
    states = np.random.default_rng(0).normal(size=(1, model.hidden)).astype(np.float32)
    words = np.array([*range(model.words), model.rest])
    found, _ = model.predict(np.repeat(states, len(words), axis=0), words)
    assert math.isclose(np.exp(found.astype(float)).sum(), 1, rel_tol=1e-4)


def test_gradients_equal_differences():
    model = small_model()
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 7, (5, 3)), rng.integers(0, 7, (5, 3))
    y[2, 1], x[3, 1] = model.rest, model.rest
    fresh = np.zeros((5, 3), bool)
    fresh[0], fresh[2, 0] = True, True
    x[fresh] = 0
    zero = np.zeros((3, model.hidden), np.float32)

    def loss():
        states, held = model.read(x, fresh, zero)
        return states, held, -model.predict(states.reshape(-1, model.hidden), y.ravel())[0].astype(float).sum()

    states, held, _ = loss()
    flat = np.zeros_like(model.flat)
    slopes = model.views(flat)
    _, back = model.predict(states.reshape(-1, model.hidden), y.ravel(), slopes)
    model.back(x, fresh, held, back.reshape(states.shape), slopes)
    for place in rng.choice(len(flat), 80, replace=False):
        kept = model.flat[place]
        values = []
        for step in (1e-2, -1e-2):
            model.flat[place] = kept + np.float32(step)
            values.append(loss()[2])
        model.flat[place] = kept
        assert abs((values[0] - values[1]) / 2e-2 - flat[place]) < 2e-2 * max(1, abs(flat[place]))


def test_training_lowers_the_loss():
    rng = random.Random(2)
    texts = [np.array([*([1, 2, 3, 4] * rng.randint(2, 9)), 0]) for _ in range(200)]
    model = gru.Model(5, 3, 8, 6)
    model.start(np.bincount(np.concatenate(texts), minlength=5), 1.0)
    before = gru.log_likelihoods(model, texts).sum()
    trainer = gru.Trainer(model)
    for _ in range(8):
        trainer.train(texts, 16)
    assert gru.log_likelihoods(model, texts).sum() > 0.4 * before


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    return [*(w for w in lowered.split(" ") if w), None]


def base(pairs):
    held = [zlib.crc32(str(d).encode()) % 7 == 2 if d is not None else False for d, _ in pairs]
    counts = Counter(w for (_, text), h in zip(pairs, held, strict=True) if not h for w in words(text))
    total, different = sum(counts.values()), len(counts)
    return [
        (d, h, len(words(t)), sum(counts[w] > 0 for w in words(t)), total,
         sum(math.log10((counts[w] + 1) / (total + different + 1)) for w in words(t)))
        for (d, t), h in zip(pairs, held, strict=True)
    ]


def check(documents, pairs):
    rows = sorted(lm.score(documents(pairs)).collect(), key=lambda r: (str(r.doc_id), r.base_score))
    expected = sorted(base(pairs), key=lambda r: (str(r[0]), r[-1]))
    assert [tuple(r)[:5] for r in rows] == [e[:5] for e in expected]
    assert np.allclose([r.base_score for r in rows], [e[5] for e in expected])
    assert all(math.isfinite(r.score) and r.score <= 1e-6 for r in rows)
    return rows


@pytest.mark.parametrize("short, model_words", [(1 << 17, 575), (64, 20)])
def test_given_documents(spark, sf, documents, monkeypatch, short, model_words):
    monkeypatch.setattr(lm, "SHORT", short)
    monkeypatch.setattr(lm, "MODEL_WORDS", model_words)
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = check(documents, pairs)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_tables(documents):
    check(documents, [(i, t) for i, t in enumerate([None, "", " \n", "A a\tA", "é É", "w " * 60_000, "same", "same"])] + [(None, "x"), (6, "same")])
    assert lm.score(documents([])).collect() == []
    only_held = [(i, "a b") for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2]
    check(documents, only_held)


def test_probabilities_of_the_vocabulary_sum_to_one(documents):
    """One-word texts over all known words and an unknown one, with everything that may follow a word, stay below 1."""
    known = [f"w{i}" for i in range(30)]
    train = [(i, " ".join(known[: 5 + i % 25])) for i in range(60) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(1000, 1400) if zlib.crc32(str(i).encode()) % 7 == 2][:32]
    pairs = [*train, (held[0], ""), *zip(held[1:], [*known, "unknown"], strict=True)]
    rows = {r.doc_id: r.score for r in lm.score(documents(pairs)).collect()}
    assert 0 < sum(10 ** rows[i] for i in held) <= 1.000001


def test_extra_columns(documents):
    docs = documents(["a b", "c"]).withColumn("hash", F.lit(1)).withColumn("row", F.lit(2)).withColumn("score", F.lit(3))
    assert lm.score(docs).count() == 2


def test_the_model_has_all_its_words_and_units(documents):
    """1,022 words and the end have outputs of their own, whatever the time it takes."""
    counts = lm.word_counts(documents([" ".join(f"w{i}" for i in range(n)) for n in (1500, 1100, 1022)]))
    model = lm.new_model(lm.vocabulary(counts))
    assert (model.words, model.hidden, model.embed.shape[1]) == (1023, 24, 16)
