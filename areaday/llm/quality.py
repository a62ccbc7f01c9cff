"""Quality: a sparse ensemble of rules on text statistics, compiled into Spark column expressions.

Boosted trees are grown on the statistics of labelled texts. Every path from a root to a node is a rule: a conjunction
of comparisons. A lasso logistic regression keeps few rules, and these with their weights become one column expression,
so scoring is a plan of built-in functions.

The fit takes about ``FIT_ROWS`` labelled texts at most; scoring covers every whole text. Nothing but the text goes into
a score. Null counts as empty; empty texts have zeros for all statistics and get a score from them. Repeated rows get
equal scores. Without labels of both kinds every score is 0 or 1, as all labels are, or 1 without any (nothing is known
against the texts). An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaday.llm.common import labelled, whole_text
from areaday.session import materialise

FIT_ROWS = 20_000
TREES = 12
DEPTH = 3
PENALTY = 0.002
GOOD = 0.7


def statistics(text: Column) -> dict[str, Column]:
    """Counts that the shares of ``shares`` are made of; one pass of a pattern each."""
    words, lines = F.split(text, r"\s+"), F.split(text, "\n")
    return {
        "chars": F.char_length(text),
        "bytes": F.octet_length(text),
        "words": F.regexp_count(text, F.lit(r"\S+")),
        "different_words": F.size(F.array_distinct(words)),
        "lines": F.size(lines),
        "different_lines": F.size(F.array_distinct(lines)),
        "upper": F.regexp_count(text, F.lit(r"\p{Lu}")),
        "digits": F.regexp_count(text, F.lit(r"[0-9]")),
        "symbols": F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,]")),
        "stops": F.regexp_count(text, F.lit(r"[.!?](?=\s|$)")),
        "commas": F.regexp_count(text, F.lit(r"[,;:]")),
        "letter_words": F.regexp_count(text, F.lit(r"(?<!\S)\p{L}+[.,]?(?!\S)")),
        "short_words": F.regexp_count(text, F.lit(r"(?<!\S)\S{1,3}(?!\S)")),
        "line_stops": F.regexp_count(text, F.lit(r"[.!?]\s*(?=\n|$)")),
    }


def shares(column=F.col) -> dict[str, Column]:
    """The statistics that rules compare: sizes, and shares that do not depend on the size of the text."""

    def per(part: str, whole: str) -> Column:
        return F.when(column(whole) > 0, column(part) / column(whole)).otherwise(F.lit(0.0))

    pairs = [
        ("chars", "words"), ("chars", "lines"), ("bytes", "chars"), ("different_words", "words"),
        ("different_lines", "lines"), ("upper", "chars"), ("digits", "chars"), ("symbols", "words"), ("stops", "words"),
        ("commas", "words"), ("letter_words", "words"), ("short_words", "words"), ("line_stops", "lines"),
        ("words", "lines"),
    ]
    sizes = {name: column(name).cast("double") for name in ("chars", "words", "lines", "different_words")}
    return sizes | {f"{part}_per_{whole}": per(part, whole) for part, whole in pairs}


def measured(rows: DataFrame, text: Column, *others: Column) -> DataFrame:
    """``others`` and the statistics of ``text`` as the struct ``stat``."""
    counts = rows.select(*others, F.struct(*[c.alias(name) for name, c in statistics(text).items()]).alias("count"))
    named = shares(lambda name: F.col(f"count.{name}"))
    kept = [F.col(name) for name in counts.columns if name != "count"]
    return counts.select(*kept, F.struct(*[c.alias(name) for name, c in named.items()]).alias("stat"))


@dataclass(frozen=True)
class Rule:
    """A conjunction of ``(statistic, is_at_most, threshold)``."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        holds = F.lit(True)
        for name, at_most, threshold in self.terms:
            value = F.col(f"stat.{name}")
            holds = holds & (value <= threshold if at_most else value > threshold)
        return holds.cast("double")


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self) -> Column:
        margin = F.lit(self.intercept)
        for rule, weight in self.rules:
            margin = margin + F.lit(weight) * rule.column()
        return 1 / (1 + F.exp(-margin))


def paths(tree, names: list[str]) -> set[Rule]:
    """The rules of a fitted tree: one for each node but the root, terms on one statistic merged."""
    found: set[Rule] = set()
    # Each node with the comparisons that lead to it: the tightest bound for each statistic and direction.
    open_ = [(tree._call_java("rootNode"), {})]
    while open_:
        node, bounds = open_.pop()
        if bounds:
            found.add(Rule(tuple(sorted((name, at_most, value) for (name, at_most), value in bounds.items()))))
        if node.subtreeDepth() == 0:
            continue
        name, threshold = names[node.split().featureIndex()], node.split().threshold()
        for child, at_most in ((node.leftChild(), True), (node.rightChild(), False)):
            tightest = min if at_most else max
            bound = tightest(threshold, bounds.get((name, at_most), threshold))
            open_.append((child, {**bounds, (name, at_most): bound}))
    return found


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = FIT_ROWS) -> RuleModel:
    rows = labelled(docs, labels, label, limit)
    names = list(shares())
    data = materialise(measured(rows, F.col("text"), F.col("label").cast("double").alias("label")).select("label", "stat.*", "stat"))
    counts = {r["label"]: r["count"] for r in data.groupBy("label").count().collect()}
    if len(counts) < 2:
        return RuleModel((), -40.0 if 0.0 in counts else 40.0)
    trees = GBTClassifier(labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, subsamplingRate=0.8, seed=7)
    grown = trees.fit(VectorAssembler(inputCols=names, outputCol="features").transform(data)).trees
    rules = sorted(set().union(*(paths(tree, names) for tree in grown)), key=lambda rule: rule.terms)
    held = data.select("label", *[rule.column().alias(f"r{i}") for i, rule in enumerate(rules)])
    lasso = LogisticRegression(labelCol="label", regParam=PENALTY, elasticNetParam=1.0, maxIter=60, standardization=False)
    fitted = lasso.fit(
        VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(held)
    )
    weights = fitted.coefficients.toArray().tolist()
    return RuleModel(tuple((rule, w) for rule, w in zip(rules, weights, strict=True) if w), fitted.intercept)


def quality(docs: DataFrame, model: RuleModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` with the columns of ``keep``, and the ``score`` of every document."""
    row = F.struct(*[docs[name].alias(name) for name in keep]).alias("row")
    return measured(docs, whole_text(docs), row).select("row", model.score().alias("score"))


def good(score):
    return score >= GOOD
