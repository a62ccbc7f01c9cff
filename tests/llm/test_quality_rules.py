import re

import pytest
from pyspark.sql import functions as F

from areaday.llm.quality_rules import BASE, MEASURES, RULES, STOP_WORDS, Rule, quality_rules

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def plain_measures(text):
    """The measures by simple loops."""
    text = text or ""
    words = [w for w in SPACE.split(text) if w]
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 3)}
    lowered = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    ends = [x.rstrip(" \t\n\x0b\f\r") for x in lines]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": len(repeated),
        "n_lines": len(lines),
        "n_stop_words": sum(w.translate(lowered).strip(".,;:!?()\"'") in STOP_WORDS for w in words),
        "n_letter_words": sum(any(c.isascii() and c.isalpha() or c > "\x7f" for c in w) for w in words),
        "n_bullet_lines": sum(x.lstrip(" \t\n\x0b\f\r").startswith(("-", "*", "•")) for x in lines),
        "n_cut_lines": sum(x.endswith(("...", "…")) for x in ends),
    }


def holds(rule, m):
    value = m[rule.measure] * (1 if rule.over is None else 1000)
    scale = 1 if rule.over is None else m[rule.over]
    return (rule.least is None or value >= rule.least * scale) and (rule.most is None or value <= rule.most * scale)


GOOD = " ".join(f"the wordy{i} of" for i in range(40))
TEXTS = [
    None,
    "",
    " \t\n\x0b\f\r ",
    "one",
    "a b c",
    "a b c a b c",
    "a a a a a",
    "a a a b a a a",
    GOOD,
    GOOD + "\n" + GOOD,
    GOOD + " # * $ % & | < >" * 3,
    "The, (of) 'und' QUE! Ünd le \xa0la x\x1cy",
    "- one\n  * two\n\t• three\n\nfour...\nfive…  \n...\nfour...",
    "line\r\nline\r\n line\nline",
    "é" * 60 + " 12 34 😀 😀😀\n😀",
    "12 34 56 " * 30,
    "\n".join(["the same line of words here"] * 12),
    " ".join(["x y z", "q"] * 20),
]


def test_measures_and_verdicts_equal_those_of_loops(spark, documents):
    found = quality_rules(documents(list(enumerate(TEXTS))))
    for row in found.select("row.doc_id", *MEASURES, "base_failed", "kept", "failed").collect():
        want = plain_measures(TEXTS[row.doc_id])
        assert {name: row[name] for name in MEASURES} == want, TEXTS[row.doc_id]
        base = [rule.name for rule in BASE if not holds(rule, want)]
        others = [rule.name for rule in RULES if not holds(rule, want)]
        assert row.failed == base + others
        assert row.base_failed == bool(base) == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        assert row.kept == (not base and not others)


def test_a_given_document_is_measured_as_by_loops(spark, sf, rows):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    for row in quality_rules(docs).select("row.doc_id", *MEASURES).collect():
        assert {name: row[name] for name in MEASURES} == plain_measures(texts[row.doc_id])


def test_bounds_are_inclusive_and_shares_exact(documents):
    words = " ".join(["ab"] * 3)
    table = (
        Rule("least", "n_words", least=3),
        Rule("most", "n_words", most=3),
        Rule("share", "word_chars", "n_words", least=2000, most=2000),
        Rule("too_low", "word_chars", "n_words", most=1999),
        Rule("too_high", "n_words", least=4),
    )
    row = quality_rules(documents([words]), rules=table, base=()).first()
    assert row.failed == ["too_low", "too_high"] and not row.base_failed and not row.kept


def test_rules_without_bounds_or_measures_are_refused(documents):
    with pytest.raises(ValueError):
        quality_rules(documents(["a"]), rules=(Rule("none", "n_words"),))
    with pytest.raises(ValueError):
        quality_rules(documents(["a"]), rules=(Rule("odd", "n_vowels", most=1),))


def test_the_plan_is_one_pass_without_user_functions(documents):
    plan = quality_rules(documents(TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_repeated_rows_extra_columns_and_empty_tables(spark, documents, rows):
    docs = documents([(1, GOOD), (1, GOOD), (None, GOOD)])
    for name in ("n_words", "kept", "failed", "m", "row", "base"):
        docs = docs.withColumn(name, F.lit("mine"))
    found = quality_rules(docs, tuple(docs.columns))
    assert rows(found, "row.doc_id", "row.kept", "kept") == [(1, "mine", True), (1, "mine", True), (None, "mine", True)]
    assert quality_rules(documents([])).count() == 0


def test_a_very_long_text_takes_time_in_proportion(documents):
    words = 300_000
    text = " ".join(f"w{i % 70_000}" for i in range(words)) + "\n" + "the of\n" * 5
    row = quality_rules(documents([text])).first()
    assert row.n_words == words + 10 and row.n_repeat_words == words + 10 and row.n_dup_lines == 4
