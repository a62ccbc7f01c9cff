import random
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from areaday.llm import line_dedup as ld
from areaday.llm import linking


def distance(a, b):
    @cache
    def d(i, j):
        if not i or not j:
            return i + j
        return min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))

    return d(len(a), len(b))


def brute(pairs, edits, least):
    """Per row: the removed lines."""
    lines = {}
    for doc_id, text in dict.fromkeys(pairs):
        for number, line in enumerate((text or "").split("\n")):
            if len(line.strip()) >= least:
                lines.setdefault(line.strip(), []).append(((doc_id is not None, doc_id or 0, number), (doc_id, text), number))
    different = sorted(lines)
    parent = {x: x for x in different}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(different):
        for b in different[:i]:
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                parent[root(a)] = root(b)
    classes, gone = {}, {}
    for x in different:
        classes.setdefault(root(x), []).extend(lines[x])
    for places in classes.values():
        for _, row, number in sorted(places, key=lambda p: p[0])[1:]:
            gone.setdefault(row, []).append(number)
    return sorted(((d, sorted(gone.get((d, t), []))) for d, t in pairs), key=repr)


def run(documents, pairs, edits=2, least=8):
    found = ld.line_dedup(documents(pairs), edits=edits, least=least).select("row.doc_id", "n_lines", "removed", "text").collect()
    texts = {}
    for doc_id, text in pairs:
        texts.setdefault(doc_id, []).append(text or "")
    for r in found:
        left = [["".join(x) for x in [t.split("\n")]] for t in texts[r.doc_id]]
        assert r.text in ["\n".join(l for i, l in enumerate(t.split("\n")) if i not in set(r.removed)) for t in texts[r.doc_id]], left
    return sorted(((r.doc_id, r.removed) for r in found), key=repr)


def random_pairs(seed, alphabet="ab"):
    rng = random.Random(seed)
    pool = ["".join(rng.choice(alphabet) for _ in range(rng.randint(6, 14))) for _ in range(25)]

    def line():
        text = list(rng.choice(pool))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            text[rng.randrange(len(text))] = rng.choice([*alphabet, "", "c", "é"])
        return "".join(text) + rng.choice(["", " "])

    return [(i, "\n".join(line() for _ in range(rng.randint(0, 5)))) for i in range(40)]


@pytest.mark.parametrize("seed, edits", [(1, 2), (2, 1), (3, 0)])
def test_equals_brute_force(documents, seed, edits):
    pairs = random_pairs(seed, "abcdefgh" if seed > 1 else "abcdefghijklmnopqrstuvwxyz")
    assert run(documents, pairs, edits) == brute(pairs, edits, 8)


def test_frequent_segments_take_the_other_way(documents, monkeypatch):
    monkeypatch.setattr("areaday.llm.linking.HOT", 3)
    pairs = [(i, f"the same start of a line {i % 37:04d} the same end of it") for i in range(120)]
    assert run(documents, pairs) == brute(pairs, 2, 8)


def test_odd_texts(documents):
    long = "\n".join(f"line number {i} of a long text" for i in range(3000))
    pairs = [
        (1, None), (2, ""), (3, "\n\n"), (4, "same line here\nsame line here"), (4, "same line here\nsame line here"),
        (None, "same line here "), (5, "short\nshort"), (6, "ünïcödé line 🙂 x"), (7, "ünïcödé line 🙂 y"), (8, long),
    ]
    assert run(documents, pairs[:-1]) == brute(pairs[:-1], 2, 8)
    assert len(run(documents, pairs)) == len(pairs)


def test_empty_table_and_kept_columns(documents):
    assert run(documents, []) == []
    docs = documents(["a line that is long\nb", "a line that is long"]).withColumn("removed", F.lit(1)).withColumn("hash", F.lit(2))
    rows = ld.line_dedup(docs, tuple(docs.columns), least=8).collect()
    assert sorted((r.row.doc_id, r.row.removed, r.row.hash, r.text) for r in rows) == [(0, 1, 2, "a line that is long\nb"), (1, 1, 2, "")]


@settings(max_examples=400, deadline=None)
@given(st.text("abc", max_size=14), st.text("abc", max_size=14), st.integers(0, 3))
def test_edit_distance_within(a, b, edits):
    assert ld.within(a, b, edits) == (distance(a, b) <= edits)


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=4, max_size=12), st.data(), st.integers(1, 3))
def test_close_lines_share_a_key(a, data, edits):
    b = list(a)
    for _ in range(edits):
        place = data.draw(st.integers(0, len(b)))
        what = data.draw(st.sampled_from(["put", "drop", "change"]))
        if what == "put":
            b.insert(place, data.draw(st.sampled_from("abc")))
        elif place < len(b):
            b[place : place + 1] = [] if what == "drop" else [data.draw(st.sampled_from("abc"))]
    b = "".join(b)
    shorter, longer = sorted((a, b), key=len)
    if len(shorter) <= edits or a == b:
        return
    own = {(len(shorter), i, shorter[s : s + n]) for i, (s, n) in enumerate(ld.segments(len(shorter), edits))}
    asked = {(n, i, longer[at : at + size]) for n, i, at, size in ld.probes(len(longer), edits)}
    asked |= {(len(longer), i, longer[s : s + n]) for i, (s, n) in enumerate(ld.segments(len(longer), edits))}
    assert own & asked


def test_equal_lines_below_the_floor_of_the_edit_join(documents):
    """Equal lines of 20 to 39 characters go; lines of that size that differ by an edit and shorter ones stay."""
    licence = "Released under the MIT License."
    docs = documents([f"{licence}\nOf.\n{'a' * 19}", f" {licence}\nOf.\n{'a' * 19}", licence.replace("MIT", "BIT")])
    found = {r.doc_id: r.removed for r in ld.line_dedup(docs).select("row.doc_id", "removed").collect()}
    assert found == {0: [], 1: [0], 2: []}


@pytest.mark.parametrize("few, jobs", [(100_000, 8), (60, None)])
def test_few_links_need_no_rounds(spark, monkeypatch, few, jobs):
    """Chains, a hub, repeats and links to oneself; up to the bound a fixed number of jobs, beyond it the same components."""
    monkeypatch.setattr(linking, "FEW_LINKS", few)
    links = [(i, i + 1) for i in range(-30, 0)] + [(500, i) for i in range(100, 130)] * 2 + [(7, 7), (2**62, -(2**62)), (9, 8)]
    context = spark.sparkContext
    context.setJobGroup(group := f"few-links-{few}", "components")
    try:
        found = linking.components(spark.createDataFrame(links, "one long, other long"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    expected = {i: -30 for i in range(-30, 1)} | {i: 100 for i in [*range(100, 130), 500]} | {2**62: -(2**62), -(2**62): -(2**62), 9: 8, 8: 8}
    assert sorted(found.collect()) == sorted(expected.items())
    ran = len(context.statusTracker().getJobIdsForGroup(group))
    assert ran and (jobs is None or ran <= jobs), ran


def test_no_links(spark):
    assert linking.components(spark.createDataFrame([(1, 1)], "one long, other long")).collect() == []
