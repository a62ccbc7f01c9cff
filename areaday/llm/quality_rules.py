"""Quality rules: a table of thresholds that becomes one projection of measures and verdicts, without user functions.

A rule bounds a measure, or a measure's share of another, from below or above; shares are compared in thousandths by
whole numbers. Adding a row to the table adds columns to the same projection: no shuffle, no Python, one pass over the
texts. Intermediate lists (words, lines, windows) are bound once per text through a lambda, since Catalyst would
otherwise put their expressions into each place that uses them, which is quadratic in a text's length.

Null texts count as empty: all measures are 0. Texts are taken whole, however long. Repeated rows are judged one by one.
A share of nothing is within all bounds. Columns other than the text take no part; those named in ``keep`` are handed on
in the struct ``row``, so that no column of theirs can clash. An empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaday.llm.common import carried

# White space between words, and the signs that count as symbols.
SPACE = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 3

#: Very common words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "in", "is",
    "der", "die", "das", "und", "zu", "den", "mit", "von", "nicht", "ist",
    "le", "la", "les", "de", "des", "et", "un", "une", "en", "est",
    "el", "los", "las", "y", "que", "por", "del", "se", "con", "es",
)
PUNCTUATION = ".,;:!?()\"'"
BULLETS = ("-", "*", "•")
ELLIPSES = ("...", "…")
LETTER = r"[A-Za-z]|[^\x00-\x7F]"


class Rule(NamedTuple):
    """``least <= measure <= most``, or the same of thousandths of ``over`` where that is named."""

    name: str
    measure: str
    over: str | None = None
    least: int | None = None
    most: int | None = None

    def holds(self, value: Callable[[str], Column]) -> Column:
        found = value(self.measure) if self.over is None else 1000 * value(self.measure)
        bounds = []
        for bound, within in ((self.least, found.__ge__), (self.most, found.__le__)):
            if bound is not None:
                bounds.append(within(F.lit(bound) if self.over is None else bound * value(self.over)))
        if not bounds:
            raise ValueError(f"rule {self.name} has no bound")
        return bounds[0] if len(bounds) == 1 else bounds[0] & bounds[1]


#: The rules whose failure fails a text before all others.
BASE = (
    Rule("enough_words", "n_words", least=50),
    Rule("few_repeated_words", "n_repeat_words", "n_words", most=500),
)
RULES = (
    Rule("not_too_many_words", "n_words", most=100_000),
    Rule("usual_word_length", "word_chars", "n_words", least=2_500, most=12_000),
    Rule("few_symbols", "n_symbols", "n_words", most=100),
    Rule("some_stop_words", "n_stop_words", least=2),
    Rule("enough_stop_words", "n_stop_words", "n_words", least=20),
    Rule("words_with_letters", "n_letter_words", "n_words", least=800),
    Rule("few_repeated_lines", "n_dup_lines", "n_lines", most=300),
    Rule("few_bullets", "n_bullet_lines", "n_lines", most=900),
    Rule("few_cut_lines", "n_cut_lines", "n_lines", most=300),
)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def many(values: Column) -> Column:
    return F.size(values).cast("long")


def repeated_words(words: Column) -> Column:
    """How many words lie in windows of ``WINDOW`` words that occur twice or more, the first occurrence included.

    Windows are sorted by a hash, then by their words, so equal ones are neighbours whatever collides. The places of
    those with an equal neighbour are sorted, and each covers the words up to the next place, ``WINDOW`` at most.
    """

    def window(i: Column) -> Column:
        parts = [F.get(words, i + k) for k in range(WINDOW)]
        return F.struct(F.xxhash64(*parts).alias("hash"), *[p.alias(f"w{k}") for k, p in enumerate(parts)], i.alias("at"))

    def same(x: Column, y: Column) -> Column:
        return F.coalesce(
            (x["hash"] == y["hash"]) & (F.struct(*[x[f"w{k}"] for k in range(WINDOW)]) == F.struct(*[y[f"w{k}"] for k in range(WINDOW)])),
            F.lit(False),
        )

    def places(windows: Column) -> Column:
        twice = F.filter(windows, lambda x, k: same(x, F.get(windows, k - 1)) | same(x, F.get(windows, k + 1)))
        return F.sort_array(F.transform(twice, lambda x: x["at"]))

    def covered(at: Column) -> Column:
        lengths = F.transform(at, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(lengths, F.lit(0).cast("long"), lambda total, x: total + x)

    windows = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), window))
    found = bound(windows, lambda w: bound(places(w), covered))
    return F.when(F.size(words) > WINDOW, found).otherwise(F.lit(0).cast("long"))


def measures(text: Column) -> Column:
    """The struct of all measures of a text that is not null."""
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    plain = lambda w: F.btrim(F.translate(w, string.ascii_uppercase, string.ascii_lowercase), F.lit(PUNCTUATION))
    either = lambda test, signs: lambda x: F.array_contains(F.transform(F.array(*map(F.lit, signs)), lambda s: test(x, s)), True)

    def of_lines(w: Column, x: Column) -> Column:
        length = lambda c: F.char_length(c).cast("long")
        bullet = either(lambda line, s: F.startswith(F.ltrim(line, F.lit(SPACE)), s), BULLETS)
        cut = either(lambda line, s: F.endswith(F.rtrim(line, F.lit(SPACE)), s), ELLIPSES)
        return F.struct(
            many(w).alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda total, one: total + F.char_length(one)).alias("word_chars"),
            (length(text) - length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
            (many(x) - many(F.array_distinct(x))).alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            many(x).alias("n_lines"),
            many(F.filter(w, lambda one: plain(one).isin(*STOP_WORDS))).alias("n_stop_words"),
            many(F.filter(w, lambda one: one.rlike(LETTER))).alias("n_letter_words"),
            many(F.filter(x, bullet)).alias("n_bullet_lines"),
            many(F.filter(x, cut)).alias("n_cut_lines"),
        )

    return bound(words, lambda w: bound(lines, lambda x: of_lines(w, x)))


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_stop_words", "n_letter_words", "n_bullet_lines", "n_cut_lines",
)


def quality_rules(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE
) -> DataFrame:
    """``row, text``, the measures, ``base_failed``, ``kept``, and the names of the rules that fail as ``failed``."""
    unknown = {m for rule in (*base, *rules) for m in (rule.measure, rule.over) if m is not None} - set(MEASURES)
    if unknown:
        raise ValueError(f"no measures {sorted(unknown)}")

    def judged(m: Column) -> Column:
        value = lambda name: m[name]
        failing = lambda table: [F.when(~rule.holds(value), F.lit(rule.name)) for rule in table]
        return F.struct(
            *[m[name].alias(name) for name in MEASURES],
            F.array_compact(F.array(*failing(base), F.lit(None).cast("string"))).alias("base"),
            F.array_compact(F.array(*failing(rules), F.lit(None).cast("string"))).alias("others"),
        )

    rows = carried(docs, keep)
    found = rows.select("row", "text", bound(measures(F.col("text")), judged).alias("m"))
    return found.select(
        "row", "text", *[F.col(f"m.{name}") for name in MEASURES],
        (F.size("m.base") > 0).alias("base_failed"),
        ((F.size("m.base") == 0) & (F.size("m.others") == 0)).alias("kept"),
        F.concat("m.base", "m.others").alias("failed"),
    )
