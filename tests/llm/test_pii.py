import hashlib
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from areaday.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    spans = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(number) <= 19 and luhn(number)):
                continue
            if kind == "phone" and not 9 <= len(number) <= 15:
                continue
            spans.append((m.start(), rank, m.end(), kind))
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans)]


def run(documents, texts):
    rows = pii.find(documents(texts)).select("doc_id", pii.joined(F.col("base")).alias("base"), pii.joined(pii.all_spans()).alias("all")).collect()
    return rows


TEXTS = [
    None, "", "mail a.b+c@d-e.co.uk, x@y z@w.", "a@b.c%d@e.f a@b@c.de é🙂 q@r.st", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.255",
    "4111 1111 1111 1111, 4111-1111-1111-1112 5500005555555559 12 34", "call +1 (555) 123-4567. or +12 or +123456789012345678",
    "1" * 30 + " 4111111111111111", "+49.30.1234567 1.2.3.4 +1+2 345 678 90", "a@b" + ".c" * 20_000, "1 " * 30_000, "a" * 50_000,
    "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "x 300.1.1.1.1 9.9.9.99999999999999999999", "4111  1111 1111 1111 1111",
]


def test_base_spans_equal_the_plain_patterns(documents):
    found = {r.doc_id: r.base for r in run(documents, TEXTS)}
    for i, text in enumerate(TEXTS):
        assert found[i] == ",".join(brute(text)), (text or "")[:80]


def test_random_texts(documents):
    rng = random.Random(4)
    texts = ["".join(rng.choice("19 .-+@a(é") for _ in range(60)) for _ in range(1500)]
    texts += ["".join(rng.choice("0123456789 -") for _ in range(24)) for _ in range(1500)]
    found = {r.doc_id: r.base for r in run(documents, texts)}
    assert all(found[i] == ",".join(brute(text)) for i, text in enumerate(texts))


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.find(docs).select("doc_id", pii.joined(F.col("base")).alias("base")).collect()
    assert len(rows) == len(texts) and all(r.base == ",".join(brute(texts[r.doc_id])) for r in rows)


LETTERS = r"[^\W\d_]+"


def entity_of(kind, value):
    return kind + ":" + (re.sub("[^0-9]", "", value) if kind in ("card", "phone") else value.lower())


def plain_terms(texts):
    """For each text the places and shares of revealing terms, by loops over all texts, entities and words."""
    different = sorted({t or "" for t in texts})
    mentions, free = {}, {}
    for text in different:
        spans = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in brute(text))]
        mentions[text] = []
        for kind, pattern in BASE.items():
            found = list(re.finditer(pattern, text))
            for i, m in enumerate(found):
                if (m.start(), m.end(), kind) in spans:
                    first = max(m.start() - pii.NEAR, found[i - 1].end() if i else 0)
                    last = min(m.end() + pii.NEAR, found[i + 1].start() if i + 1 < len(found) else len(text))
                    mentions[text].append((entity_of(kind, m[0]), first, m.start(), m.end(), last))
        touches = lambda w, spans=spans: any(w.start() <= e and w.end() >= s for s, e, _ in spans)
        free[text] = [w for w in re.finditer(LETTERS, text) if len(w[0]) >= 3 and not touches(w)]
    held = {text: {w[0].lower() for w in free[text]} for text in different}
    of_term, of_entity, joint, near = {}, {}, {}, {}
    for text in different:
        for term in {w.lower() for w in re.findall(LETTERS, text) if len(w) >= 3}:
            of_term[term] = of_term.get(term, 0) + 1
        for e in {m[0] for m in mentions[text]}:
            of_entity[e] = of_entity.get(e, 0) + 1
            for term in held[text]:
                joint[e, term] = joint.get((e, term), 0) + 1
        close = {
            (e, w[0].lower())
            for e, first, start, end, last in mentions[text]
            for w in re.finditer(LETTERS, text)
            if len(w[0]) >= 3 and (first <= w.start() and w.end() <= start or end <= w.start() and w.end() <= last)
        }
        for e, term in close:
            if term in held[text]:
                near[e, term] = near.get((e, term), 0) + 1
    share = {p: (n + near.get(p, 0)) / (of_term[p[1]] + near.get(p, 0) + 1) for p, n in joint.items()}
    out = {}
    for i, text in enumerate(texts):
        entities = {m[0] for m in mentions[text or ""]}
        for w in free[text or ""]:
            most = max((share[e, w[0].lower()] for e in entities), default=0)
            if most > pii.GENERALISE:
                out.setdefault(i, {})[w.start(), w.end()] = most
    return out


def random_corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("kor", "mél", "tan", "siv") for b in ("ab", "ec", "ido", "une")]
    texts = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(3, 60))]
        for _ in range(i % 3):
            person = rng.randrange(6)
            put = [f"p{person}@mail.org", f"10.0.0.{person}", f"+1 555 000 111{person}", "4111 1111 1111 1111", f"{person}@x.y1.2.3.4"]
            words.insert(rng.randrange(len(words)), rng.choice(put))
            words.insert(rng.randrange(len(words)), f"nick{'abcdef'[person]}")
            words.insert(rng.randrange(len(words)), f"Once{''.join(rng.choices('abcdef', k=6))}")
        texts.append(rng.choice([" ", ", ", "\n", "é "]).join(words))
    return texts + texts[: n // 5] + [None, "", "jo@site.org"]


def own_words(mark, texts):
    """The texts with words and addresses that no other case has."""
    return [re.sub(r"[A-Za-z]{2,}", lambda w: w[0] + mark, text) for text in texts]


_FILLER = "the office is open about it please mail or ask " * 4
CASES = {
    "revealed": own_words("qa", ["Please ask Quillon about it, mail jo@site.org or the office", "the office of quillon is open, jo@site.org", "about the office",
                 "please mail the office about it", "mail me at me@other.org about the office",
                 *[f"the office is open about it please mail me or ask at one of them {i}" for i in range(12)]]),
    "kept_company": own_words("qb", [f"ask Quillon {i}, jo@site.org, the office {i}" for i in range(6)] + [f"the office ask {i}" for i in range(30)]),
    "beside": own_words("qc", [f"farword {_FILLER} nearword jo@site.org {_FILLER}", *[f"{_FILLER} {i}" for i in range(9)]]),
    "far": own_words("qd", [f"Quillon {_FILLER * 15}jo@site.org {_FILLER * 15}quillon", f"jo@site.org {_FILLER * 15} quillon", f"{_FILLER} quillonxx", *[f"{_FILLER} {i}" for i in range(12)]]),
    "copies": own_words("qe", [f"ask quillon, mail jo@site.org {'x' * i}" for i in range(2)] * 20 + ["ask about the office by mail"] * 9),
    "random": random_corpus(1, 90),
}


class Corpus:
    """All cases in one table: what is found and what is left, and the same by loops. Cases share no words."""

    def __init__(self, spark):
        self.texts = [text for case in CASES.values() for text in case]
        docs = spark.createDataFrame(list(enumerate(self.texts)), "doc_id long, text string")
        self.found = {r.doc_id: {(t.start, t.end): t.share for t in r.terms} for r in pii.find(docs).collect() if r.terms}
        self.clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
        self.want = plain_terms(self.texts)

    def case(self, name):
        """The number of a case's first text, its texts, and the words that are wanted in each of them."""
        first = sum(len(texts) for other, texts in CASES.items() if list(CASES).index(other) < list(CASES).index(name))
        texts = CASES[name]
        words = {i: {texts[i][a:b].lower(): s for (a, b), s in self.want[first + i].items()} for i in range(len(texts)) if first + i in self.want}
        return first, texts, words


@pytest.fixture(scope="module")
def corpus(spark):
    return Corpus(spark)


def test_terms_equal_counts_over_all_documents(corpus):
    assert {i: set(x) for i, x in corpus.found.items()} == {i: set(x) for i, x in corpus.want.items()}
    assert all(math.isclose(corpus.found[i][place], share) for i, x in corpus.want.items() for place, share in x.items())


def test_sanitising_equals_a_plain_replacement(corpus):
    for i, clean in corpus.clean.items():
        text, at, out = corpus.texts[i] or "", 0, ""
        spans = [(int(s), int(e), f"[{k}]") for k, s, e in (x.split(":") for x in brute(text))]
        spans += [(a, b, "" if s > pii.REMOVE else "[term]") for (a, b), s in corpus.want.get(i, {}).items()]
        for start, end, put in sorted(spans, key=lambda s: s[0]):
            out += text[at:start] + (put if start >= at else "")
            at = max(at, end)
        assert clean == out + text[at:], text


def test_terms_that_reveal_an_entity(corpus):
    first, _, words = corpus.case("revealed")
    assert words == {0: {"quillonqa": 4 / 5}, 1: {"quillonqa": 4 / 5}}
    assert corpus.clean[first] == "Pleaseqa askqa [term] aboutqa itqa, mailqa [email] orqa theqa officeqa"


def test_terms_that_keep_company_are_removed(corpus):
    first, _, words = corpus.case("kept_company")
    assert len(words) == 6 and all(set(x) == {"quillonqb"} and x["quillonqb"] > pii.REMOVE for x in words.values())
    assert corpus.clean[first] == "askqb  0, [email], theqb officeqb 0"


def test_words_seen_once_go_only_beside_the_mention(corpus):
    """A word that is seen once, away from the mention, may be there by chance: it is left; beside it, it goes."""
    assert corpus.case("beside")[2] == {0: {"nearwordqc": 2 / 3}}


def test_terms_far_from_the_mention(corpus):
    """A revealing term goes wherever it stands in a document with the entity, near the mention or not."""
    first, texts, words = corpus.case("far")
    assert set(words) == {0, 1} and len(corpus.want[first]) == 2
    assert "uillon" not in corpus.clean[first] + corpus.clean[first + 1] and corpus.clean[first + 2] == texts[2]


def test_copies_count_once_for_terms(corpus):
    """Copies of a text, as other documents or as repeated rows, neither raise nor lower the share of a term."""
    words = corpus.case("copies")[2]
    assert len(words) == 40 and {x["quillonqe"] for x in words.values()} == {4 / 5}


def test_shares_do_not_rise_with_the_corpus(corpus):
    """A share depends on the documents of the term and the entity; with any others it stays the same."""
    for name in CASES:
        first, texts, _ = corpus.case(name)
        alone = plain_terms(texts)
        assert alone == {i - first: x for i, x in corpus.want.items() if first <= i < first + len(texts)}


def test_one_text_with_very_many_entities_takes_time_in_proportion(documents):
    n = 20_000
    text = " ".join(f"user{i}@mail{i}.org wrote on {i}.1.2.3" for i in range(n))
    docs = documents([text]).withColumn("base", pii.base_spans(F.col("text")))
    began = time.time()
    row = docs.select(F.size("base").alias("n"), F.length(pii.masked(F.col("text"))).alias("length")).first()
    assert (row.n, row.length) == (n + 256, len(text)) and time.time() - began < 60


def test_running_sums(spark):
    lists = [[(7 * i) % 11 for i in range(n)] for n in (0, 1, 63, 64, 65, 4097)]
    frame = spark.createDataFrame([(v,) for v in lists], "v array<long>").select("v", pii.sums_of(F.col("v")).alias("s"))
    assert all(row.s == [sum(row.v[:i]) for i in range(len(row.v))] for row in frame.collect())


def test_repeated_rows_extra_columns_and_no_python(documents):
    docs = documents([(1, "a@b.cd 1"), (1, "a@b.cd 1"), (1, "other"), (None, "a@b.cd")]).withColumn("base", F.lit(1)).withColumn("hash", F.lit(2))
    found = pii.find(docs)
    assert sorted((r.doc_id or 0, len(r.base)) for r in found.collect()) == [(0, 1), (1, 0), (1, 1), (1, 1)]
    assert sorted(r.text for r in pii.sanitise(docs).collect()) == ["[email]", "[email] 1", "[email] 1", "other"]
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert pii.find(documents([])).collect() == []


def test_digest_of_no_spans(documents, spark):
    rows = pii.find(documents([None])).select(F.sha2(pii.joined(F.col("base")), 256).alias("h")).collect()
    assert rows[0].h == hashlib.sha256(b"").hexdigest()
