import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from areaday.llm import quality as ql
from areaday.llm import toxicity as tx
from areaday.llm.common import fold

TOXIC = ["zurk", "blaghmo", "frentix"]
PLAIN = ["the", "river", "house", "walks", "green", "apple", "stone", "under", "cloud", "paper"]


def toxic_texts(n=400):
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(n):
        words = [rng.choice(PLAIN) for _ in range(rng.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(TOXIC) + rng.choice(["s", "", "ing"])
        texts.append(" ".join(words))
        labels.append((i, int(toxic), int(not toxic)))
    return texts, labels


@pytest.fixture
def label_table(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int, quality int")


def held(frame):
    return frame.filter(fold(F.col("row.doc_id"), 4) == 2)


def test_toxicity_on_rows_it_has_not_seen(documents, label_table):
    texts, labels = toxic_texts()
    model = tx.train(documents(texts), label_table(labels))
    rows = held(tx.toxicity(documents(texts), model)).collect()
    assert len(rows) > 50
    assert np.mean([(r.score >= tx.TOXIC) == (r.row.doc_id % 4 == 0) for r in rows]) > 0.95
    # Labels of the held-out fold take no part.
    hidden = [(d, 1 - t if (d in {r.row.doc_id for r in rows}) else t, q) for d, t, q in labels]
    other = tx.train(documents(texts), label_table(hidden))
    assert np.allclose(other.weights, model.weights)


def test_toxicity_of_odd_texts(documents, label_table):
    texts, labels = toxic_texts(120)
    model = tx.train(documents(texts), label_table([*labels, (None, 1, 0), (3, None, None), (999, 1, 1), (1, 0, 1)]))
    docs = documents([None, "", "é" * 10, "a " * 60_000, "zurk", "zurk"]).withColumn("score", F.lit("x"))
    rows = {r.row.doc_id: r for r in tx.toxicity(docs, model, ("doc_id", "score")).collect()}
    scores = [rows[i].score for i in range(6)]
    assert all(0 <= s <= 1 for s in scores) and scores[0] == scores[1] and scores[4] == scores[5]
    assert rows[0].row.score == "x"


@pytest.mark.parametrize("module, label, alone", [(tx, "toxic", 0.0), (ql, "quality", 1.0)])
def test_labels_of_one_kind_or_none(documents, label_table, module, label, alone):
    docs = documents(["a b c", "d e f", None])
    score = tx.toxicity if module is tx else ql.quality
    for rows, expected in ([], alone), ([(0, 1, 1), (1, 1, 1)], 1.0), ([(0, 0, 0), (1, 0, 0)], 0.0):
        model = module.train(docs, label_table(rows))
        assert [round(r.score, 6) for r in score(docs, model).collect()] == [expected] * 3
        assert score(documents([]), model).collect() == []


def quality_texts(n=400):
    rng = random.Random(2)
    texts, labels = [], []
    for i in range(n):
        words = [rng.choice(PLAIN) for _ in range(rng.randint(10, 80))]
        bad = i % 3 == 0
        if bad:
            words = [w.upper() + "!!" if i % 2 else w + "$$$" for w in words]
        texts.append(" ".join(words) + ".")
        labels.append((i, 0, int(not bad)))
    return texts, labels


def test_quality_on_rows_it_has_not_seen(documents, label_table):
    texts, labels = quality_texts()
    model = ql.train(documents(texts), label_table(labels))
    assert 0 < len(model.rules) < 80
    scored = ql.quality(documents(texts), model)
    rows = held(scored).collect()
    assert np.mean([(r.score >= ql.GOOD) == (r.row.doc_id % 3 != 0) for r in rows]) > 0.95
    plan = scored._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quality_of_odd_texts(documents, label_table):
    texts, labels = quality_texts(120)
    model = ql.train(documents(texts), label_table(labels))
    docs = documents([None, "", " \n ", "x" * 100_000, "a b\n" * 30_000]).withColumn("stat", F.lit(1)).withColumn("chars", F.lit(2))
    scores = {r.row.doc_id: r.score for r in ql.quality(docs, model, tuple(docs.columns)).collect()}
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores.values()) and scores[0] == scores[1]


def test_rules_are_paths(spark):
    rule = ql.Rule((("words", True, 3.0), ("chars", False, 5.0)))
    rows = spark.createDataFrame([((3.0, 6.0),), ((4.0, 6.0),), ((3.0, 5.0),)], "stat struct<words: double, chars: double>")
    assert [r[0] for r in rows.select(rule.column()).collect()] == [1.0, 0.0, 0.0]


def test_ngrams_do_not_depend_on_case_or_signs():
    assert (np.unique(tx.ngrams("Zurk, you!")) == np.unique(tx.ngrams("  zurk you"))).all()
    assert len(tx.ngrams("")) == 0 and len(tx.ngrams("abc")) == 3 + 2 + 1
