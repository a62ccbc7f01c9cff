"""One query per operator: the operator over its whole table, and the digest columns of the result."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaday.llm.common import fold, table, whole_text
from areaday.llm.decontamination import contaminated, contamination, hit_words
from areaday.llm.exact_dedup import exact_dedup
from areaday.llm.jaccard_join import jaccard_join
from areaday.llm.line_dedup import line_dedup
from areaday.llm.lm_scoring import score
from areaday.llm.packing import pack_documents
from areaday.llm.periodic_runs import longest, periodic_runs
from areaday.llm.pii import PATTERNS, all_spans, find, joined
from areaday.llm.quality import good, quality
from areaday.llm.quality import train as train_quality
from areaday.llm.quality_rules import MEASURES, SPACES, STOP_WORDS, bound, quality_rules
from areaday.llm.ranked_search import ranked_search
from areaday.llm.toxicity import rejected, toxicity
from areaday.llm.toxicity import train as train_toxicity
from areaday.llm.url_filters import host_of, judge, parents

_LOWERED = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP7_SQL = f"""
    WITH t AS (SELECT doc_id, {_LOWERED} AS norm FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY norm)
"""


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("n_hit", hit_words()).select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


OP5_SQL = rf"""
    WITH texts AS (
        SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    items AS (
        SELECT item_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, w[i:i + 12] AS phrase FROM items, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i)
        WHERE len(w) > 0),
    places AS (
        SELECT doc_id, i, n, w[i:i + n - 1] AS phrase
        FROM texts, (SELECT DISTINCT len(phrase) AS n FROM windows) AS sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
    found AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (phrase)),
    hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
    FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _predictions(scored: DataFrame, positive) -> DataFrame:
    doc_id = F.col("row.doc_id")
    return scored.select(
        doc_id, (fold(doc_id, 4) == 2).alias("held_out"), "score", positive(F.col("score")).cast("int").alias("predicted")
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _predictions(toxicity(docs, train_toxicity(docs, table(spark, sf_dir, "labels"))), rejected)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _predictions(quality(docs, train_quality(docs, table(spark, sf_dir, "labels"))), good)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


OP6_SQL = rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(string_split_regex({_LOWERED}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, w[i:i + 4] AS s FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i)
        WHERE len(w) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    links AS (
        SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
        JOIN sizes n ON n.doc_id = a.doc_id JOIN sizes m ON m.doc_id = b.doc_id
        GROUP BY a.doc_id, b.doc_id, n.n, m.n HAVING 100 * count(*) >= 80 * (n.n + m.n - count(*))),
    reached(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other)
    SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(other) AS component_id
    FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its lines, how many go and which, and a digest of the text that is left."""
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"),
        F.sha2("text", 256).alias("text_sha256"),
    )


_ACTIONS = ("block", "allow", "clear")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as captures, judged by dated entries for each of their hosts and domains.

    The tables have neither times of fetches nor lists, so both are derived: a page is fetched on the day that its id
    falls on in a year, and each host and domain has three entries with a day and an action by its md5.
    """
    day = lambda number: F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(number, F.lit(365)).cast("int"))
    pages = table(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", day(F.col("page_id")).alias("fetched"))
    keys = captures.select(F.explode(parents(host_of(F.col("url")))).alias("p")).filter("p.labels > 1").select("p.key").distinct()
    numbered = keys.select("key", F.explode(F.array(*map(F.lit, range(3)))).alias("n"))
    digest = F.md5(F.concat(F.col("key"), F.lit("#"), F.col("n").cast("string")))
    code = F.conv(F.substring(digest, 1, 6), 16, 10).cast("long")
    action = F.element_at(F.array(*map(F.lit, _ACTIONS)), (code % 7 % 3 + 1).cast("int"))
    return judge(captures, numbered.select("key", action.alias("action"), day(code).alias("day")))


OP9_SQL = r"""
    WITH captures AS (
        SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS fetched,
               nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '\.+$', ''), '') AS host
        FROM pages),
    split AS (SELECT host, string_split(host, '.') AS labels FROM (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL)),
    parents AS (
        SELECT host, array_to_string(labels[i:], '.') AS key, len(labels) - i + 1 AS n
        FROM split, unnest(range(1, len(labels) + 1)) AS t(i)),
    coded AS (
        SELECT key, CAST('0x' || substr(md5(key || '#' || m), 1, 6) AS INTEGER) AS code
        FROM (SELECT DISTINCT key FROM parents WHERE n > 1), unnest(range(3)) AS t(m)),
    daily AS (
        SELECT key, DATE '2024-01-01' + code % 365 AS since, max([3, 2, 1][code % 7 % 3 + 1]) AS strict FROM coded GROUP BY ALL),
    spans AS (SELECT *, lead(since) OVER (PARTITION BY key ORDER BY since) AS until FROM daily),
    active AS (
        SELECT c.host, c.fetched, max({'n': p.n, 'key': s.key, 'strict': s.strict, 'since': s.since}) AS best
        FROM (SELECT DISTINCT host, fetched FROM captures) c JOIN parents p USING (host) JOIN spans s USING (key)
        WHERE s.strict > 1 AND s.since <= c.fetched AND (s.until IS NULL OR c.fetched < s.until) GROUP BY ALL)
    SELECT page_id, url, fetched, host, coalesce(['', 'allow', 'block'][best.strict], 'pass') AS verdict,
           best.key AS matched, best.since AS since
    FROM captures LEFT JOIN active USING (host, fetched)
"""


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))

    def number(kind: str):
        return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(number, PATTERNS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(all_spans()).alias("spans")
    )


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = rf"""
    WITH docs AS (
        SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
    items AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark),
    sizes AS (SELECT doc_id, count(*) AS n FROM docs GROUP BY doc_id),
    totals AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM sizes),
    tfs AS (SELECT doc_id, term, count(*) AS tf FROM docs GROUP BY doc_id, term),
    weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM tfs, totals WHERE term IN (SELECT term FROM items) GROUP BY term),
    scored AS (
        SELECT item_id, doc_id,
               CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll)))) AS BIGINT) AS score
        FROM items JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (doc_id), totals
        GROUP BY item_id, doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 50
"""


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select("row.doc_id", *MEASURES, "base_failed", "kept")


OP12_SQL = rf"""
    WITH texts AS (
        SELECT doc_id, coalesce(text, '') AS text,
               list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS x
        FROM documents),
    windows AS (SELECT doc_id, i, w[i:i + 2] AS s FROM texts, unnest(range(1, len(w) - 1)) AS t(i)),
    twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM twice, unnest(range(i, i + 3)) AS t(p) GROUP BY doc_id),
    measured AS (
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
               CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(x) - len(list_distinct(x)) AS BIGINT) AS n_dup_lines,
               coalesce(c.n, 0) AS n_repeat_words, CAST(len(x) AS BIGINT) AS n_lines,
               CAST(len(list_filter(w, lambda one: trim(translate(one, '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                   '.,;:!?()"''') IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}))) AS BIGINT) AS n_stop_words,
               CAST(len(list_filter(w, lambda one: regexp_matches(one, '[A-Za-z]|[^\x00-\x7F]'))) AS BIGINT) AS n_letter_words,
               CAST(len(list_filter(x, lambda one: regexp_matches(one, '^[\x20\x09-\x0D]*[-*•]'))) AS BIGINT) AS n_bullet_lines,
               CAST(len(list_filter(x, lambda one: regexp_matches(one, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS BIGINT) AS n_cut_lines
        FROM texts LEFT JOIN covered c USING (doc_id)),
    judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
    SELECT *, NOT base_failed AND n_words <= 100000 AND 1000 * word_chars BETWEEN 2500 * n_words AND 12000 * n_words
           AND 1000 * n_symbols <= 100 * n_words AND n_stop_words >= 2 AND 1000 * n_stop_words >= 20 * n_words
           AND 1000 * n_letter_words >= 800 * n_words AND 1000 * n_dup_lines <= 300 * n_lines
           AND 1000 * n_bullet_lines <= 900 * n_lines AND 1000 * n_cut_lines <= 300 * n_lines AS kept
    FROM judged
"""


def planted(doc_id, text):
    """The text, which for one id in ten repeats some of its words from a place on, as the id's crc32 says."""
    number = F.crc32(doc_id.cast("string").cast("binary"))
    part = F.floor(number / 10).cast("long")

    def repeated(words):
        n = F.size(words).cast("long")
        first = F.pmod(part, n)
        period = 1 + F.floor((n - first) / (3 + F.pmod(part, F.lit(8)))).cast("long")
        places = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < first, i).otherwise(first + F.pmod(i - first, period)))
        chosen = bound(places, lambda at: F.transform(at, lambda i: F.get(words, i.cast("int"))))
        return F.when(n > 0, F.array_join(chosen, " ")).otherwise("")

    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    return F.when(F.pmod(number, F.lit(10)) == 0, bound(words, repeated)).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its runs, the longest of them, and digests of all runs and of the words without repetitions."""
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(docs.withColumn("text", planted(docs["doc_id"], whole_text(docs))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    top = found.withColumn("top", longest(F.col("runs")))
    return top.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
