"""Personal data: patterns for what is surely personal, and terms that reveal it by information theory.

Patterns find e-mail addresses, IP addresses, payment cards and phone numbers. Each value found is a protected entity.
The words of a document with an entity are terms that may reveal it. Over all documents it is counted how many hold the
entity, the term, and the term with the entity, and in how many of these the term stands within ``NEAR`` signs of a
mention, which counts as seen once more. How much a term discloses of an entity is the chance that the entity is there
where the term is, from the mutual information ``log(P(entity | term) / P(entity))`` without the entity's own rarity; it
is estimated from below, as if one more document had the term without the entity. So neither a larger corpus nor a rarer
entity raises it, only more evidence does: a word seen once with an entity, away from it, discloses a half and is no
more than a chance; one that stands beside it, or comes with it again, discloses more. Terms that disclose more than
``GENERALISE`` are generalised to a placeholder, and those above ``REMOVE`` are removed, wherever they stand in documents
with the entity.

Documents are told apart by their texts here: copies of a text are no further evidence, and count as one document. Entities
that occur in the same documents are counted as one, so a document with many entities does not have each of them beside
each of its words. All steps on a text take time in proportion to its length.

Only DataFrame functions run here. Patterns are written so that they neither recurse nor go back over long runs. Null
texts count as empty and hold nothing. Repeated rows each get their own result row. A null ``doc_id`` is kept. Other
columns are not read, except that ``sanitise`` hands them on. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaday.llm.common import carried, whole_text
from areaday.llm.quality_rules import bound
from areaday.session import materialise

#: Signs to either side of a mention within which a word is near it.
NEAR = 40
GENERALISE = 0.5
REMOVE = 0.9

#: The kinds in their order. ``\G`` is where the last match ended: a match starts there or where a run of its first
#: characters starts, as one from within a run would fail like the one from its start.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[ -]?+[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for its pattern to be tried at all.
_HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
KINDS = [*PATTERNS, "term"]
_TERM = r"\p{L}{3,}"
#: Stands for the signs of base spans; a noncharacter, which no text holds. Words that touch it hold it too.
_MASK = "\uffff"
_WORD = r"[\p{L}\x{FFFF}]{3,}+"
#: Every text consists of blocks, and every block of pieces that end with a word, or with its end.
_BLOCK = r"(?s).{1,400}+[\p{L}\x{FFFF}]*+"
_PIECE = r"[^\p{L}\x{FFFF}]*+[\p{L}\x{FFFF}]++|[^\p{L}\x{FFFF}]++"
SPAN = "struct<start: bigint, rank: int, end: bigint, kind: string, entity: string, near: array<string>, byte: bigint>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass the Luhn check: from the right, every second one is doubled."""
    size = F.length(number)

    def weighed(i: Column) -> Column:
        digit = F.substring(number, size - i, F.lit(1)).cast("int")
        double = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when(i % 2 == 1, double).otherwise(digit)

    total = F.aggregate(F.transform(F.sequence(F.lit(0), size - 1), weighed), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def holds(kind: str, value: Column) -> Column:
    """Whether a match of the pattern is one of the kind."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: F.coalesce(part.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        size = F.length(digits(value))
        return F.when(size.between(12, 19), luhn(digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def entity(kind: str, value: Column) -> Column:
    """What two mentions of one entity have in common."""
    plain = digits(value) if kind in ("card", "phone") else F.lower(value)
    return F.concat(F.lit(f"{kind}:"), plain)


_CHUNK = 64


def running(values: Column, join: Callable[[Column, Column], Column], none: Column) -> Column:
    """For each value all those before it joined, ``none`` for the first; by chunks, as lists cannot be added to in place.

    ``values`` is bound by the caller, not computed here.
    """
    fold = lambda part: F.aggregate(part, none, join)
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _CHUNK).cast("int")), lambda k: F.slice(values, k * _CHUNK + 1, F.lit(_CHUNK)))
    state = F.struct(none.alias("so_far"), F.slice(F.array(none), 1, 0).alias("before"))
    before = lambda parts: F.aggregate(
        parts, state,
        lambda s, part: F.struct(join(s["so_far"], fold(part)).alias("so_far"), F.array_append(s["before"], s["so_far"]).alias("before")),
        lambda s: s["before"],
    )

    def of_chunks(parts: Column) -> Column:
        return bound(before(parts), lambda b: F.flatten(F.transform(
            parts, lambda part, k: F.transform(part, lambda _, i: F.aggregate(F.slice(part, F.lit(1), i), F.get(b, k), join)))))

    return F.when(F.size(values) > 0, bound(chunks, of_chunks)).otherwise(F.slice(F.array(none), 1, 0))


def sums(values: Column) -> Column:
    return running(values, lambda a, x: a + x, F.lit(0).cast("long"))


def matches(text: Column, pattern: str) -> Column:
    """Every match as ``(start, byte, value, before, after)``: its place in signs and bytes, and what lies to its sides.

    The places are sums of the lengths of what lies between.
    """

    def of(between: Column, values: Column) -> Column:
        lengths = lambda size: F.transform(values, lambda v, i: (size(F.get(between, i)) + size(v)).cast("long"))
        make = lambda at, byte: F.transform(
            values,
            lambda v, i: F.struct(
                (F.get(at, i) + F.char_length(F.get(between, i))).alias("start"), (F.get(byte, i) + F.octet_length(F.get(between, i))).alias("byte"),
                v.alias("value"), F.right(F.get(between, i), F.lit(NEAR + 1)).alias("before"), F.left(F.get(between, i + 1), F.lit(NEAR + 1)).alias("after"),
            ),
        )
        return bound(lengths(F.char_length), lambda c: bound(lengths(F.octet_length), lambda b: bound(sums(c), lambda at: bound(sums(b), lambda byte: make(at, byte)))))

    values = F.regexp_extract_all(text, F.lit(pattern), 0)
    return bound(values, lambda v: bound(F.split(text, pattern, -1), lambda between: of(between, v)))


def near_words(before: Column, after: Column) -> Column:
    """The different words that lie wholly within ``NEAR`` signs before or after a mention, lowered."""
    cut = lambda side, edge: F.when(F.char_length(side) > NEAR, F.regexp_replace(side, edge, "")).otherwise(side)
    sides = F.concat_ws(" ", cut(before, r"^\p{L}++"), cut(after, r"(?<!\p{L})\p{L}++$"))
    return F.array_distinct(F.transform(F.regexp_extract_all(sides, F.lit(_TERM), 0), F.lower))


def base_spans(text: Column) -> Column:
    """All spans of the patterns, as an array of ``SPAN`` in order of start, then kind."""
    nothing = F.expr(f"cast(array() as array<{SPAN}>)")

    def spans(rank: int, kind: str) -> Column:
        found = F.filter(matches(text, PATTERNS[kind]), lambda m: holds(kind, m["value"]))
        made = F.transform(
            found,
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(rank).alias("rank"),
                (m["start"] + F.char_length(m["value"])).alias("end"), F.lit(kind).alias("kind"),
                entity(kind, m["value"]).alias("entity"), near_words(m["before"], m["after"]).alias("near"), m["byte"].alias("byte"),
            ),
        )
        hint = F.contains(text, F.lit(_HINTS[kind])) if _HINTS[kind] else F.lit(True)
        return F.when(hint & F.regexp_like(text, F.lit(PATTERNS[kind])), made).otherwise(nothing)

    return F.sort_array(F.concat(*[spans(rank, kind) for rank, kind in enumerate(PATTERNS)]))


def rebuilt(text: Column, spans: Column, put: Callable[[Column, Column], Column]) -> Column:
    """``text`` with ``put(span, reach)`` in place of what each span covers beyond ``reach``, up to where others came.

    ``spans`` are ``start, end, byte, byte_end`` in order of start, and whatever ``put`` needs. What lies between them is
    cut out by bytes, since places in signs have to be counted from the start of a text.
    """
    ends = F.transform(spans, lambda s: F.struct(s["end"].alias("end"), s["byte_end"].alias("byte")))
    reach_of = running(ends, lambda a, x: F.greatest(a, x), F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("byte")))

    def between(data: Column, first: Column, last: Column) -> Column:
        return F.substring(data, (first + 1).cast("int"), F.greatest(last - first, F.lit(0)).cast("int")).cast("string")

    def pieces(data: Column, reach: Column) -> Column:
        made = F.transform(spans, lambda s, i: F.concat(between(data, F.get(reach, i)["byte"], s["byte"]), put(s, F.get(reach, i)["end"])))
        last = F.array_max(F.transform(spans, lambda s: s["byte_end"]))
        return F.concat(F.array_join(made, ""), between(data, last, F.octet_length(data).cast("long")))

    whole = bound(text.cast("binary"), lambda data: bound(reach_of, lambda reach: pieces(data, reach)))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def masked(text: Column) -> Column:
    """``text`` with the mask in place of every sign of a base span, so that places stay; those signs are ASCII."""
    spans = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["byte"].alias("byte"), (s["byte"] + s["end"] - s["start"]).alias("byte_end")))
    hide = lambda s, reach: F.repeat(F.lit(_MASK), F.greatest(s["end"] - F.greatest(s["start"], reach), F.lit(0)).cast("int"))
    return bound(spans, lambda x: rebuilt(text, x, hide))


def words_of(documents: DataFrame) -> DataFrame:
    """``hash, term``: the different words of the whole text that neither lie in a base span nor touch one."""
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(_WORD), 0))
    words = F.array_distinct(F.transform(F.filter(words, lambda w: ~F.contains(w, F.lit(_MASK))), F.lower))
    return documents.select("hash", F.explode(words).alias("term"))


def cut(text: Column, pattern: str) -> Column:
    """The matches of a pattern, which cover the text, as ``(start, byte, text)``; the mask counts as one byte."""

    def of(values: Column) -> Column:
        size = lambda v: F.octet_length(F.replace(v, F.lit(_MASK), F.lit("."))).cast("long")
        lengths = lambda measure: sums_of(F.transform(values, measure))
        return bound(lengths(lambda v: F.char_length(v).cast("long")), lambda at: bound(lengths(size), lambda byte: F.transform(
            values, lambda v, i: F.struct(F.get(at, i).alias("start"), F.get(byte, i).alias("byte"), v.alias("text")))))

    return bound(F.regexp_extract_all(text, F.lit(pattern), 0), of)


def sums_of(values: Column) -> Column:
    """``sums`` of values that are computed once."""
    return bound(values, sums)


def occurrences(documents: DataFrame, revealing: DataFrame) -> DataFrame:
    """``hash, start, end, byte, byte_end, share`` of every occurrence of a document's ``term, share``.

    Texts are cut at ends of words into blocks, and places are found only in blocks that hold such a term.
    """
    terms = materialise(revealing.groupBy("hash").agg(F.collect_set("term").alias("terms")))
    block = documents.select("hash", "text").join(terms, "hash").select("hash", "terms", F.explode(cut(F.col("text"), _BLOCK)).alias("b"))
    words = F.transform(F.regexp_extract_all("b.text", F.lit(_WORD), 0), F.lower)
    block = block.filter(F.arrays_overlap(words, "terms")).select("hash", "b.*")
    piece = block.select("hash", F.col("start").alias("at"), F.col("byte").alias("byte_at"), F.explode(cut(F.col("text"), _PIECE)).alias("p"))
    piece = piece.withColumn("word", F.regexp_extract("p.text", _WORD, 0)).filter((F.col("word") != "") & ~F.contains("word", F.lit(_MASK)))
    end = F.col("at") + F.col("p.start") + F.char_length("p.text")
    byte_end = F.col("byte_at") + F.col("p.byte") + F.octet_length(F.replace("p.text", F.lit(_MASK), F.lit(".")))
    found = piece.select(
        "hash", F.lower("word").alias("term"), (end - F.char_length("word")).alias("start"), end.alias("end"),
        (byte_end - F.octet_length("word")).alias("byte"), byte_end.alias("byte_end"),
    )
    return found.join(revealing, ["hash", "term"]).select("hash", "start", "end", "byte", "byte_end", "share")


def each_once(texts: DataFrame) -> DataFrame:
    """``texts`` without repeated ones; copies go within the tasks that read them, before anything is sent."""
    return texts.dropDuplicates(["hash"])


def disclosures(documents: DataFrame, words: DataFrame, texts: DataFrame) -> DataFrame:
    """``hash, term, share`` of the terms that disclose more than ``GENERALISE`` of an entity of the document.

    A share is ``(joint + near) / (of_term + near + 1)``. It is above the half only if ``of_term`` is below twice
    ``joint + near``, so frequent words drop out before pairs are made.
    """
    mentions = documents.select("hash", F.explode("base").alias("m")).select("hash", "m.entity", "m.near")
    held = materialise(mentions.select("hash", "entity").distinct())
    # Entities of the same documents have the same sums of the documents' hashes, and one of them stands for all.
    code = F.xxhash64("hash").cast("decimal(38,0)")
    profiles = held.groupBy("entity").agg(F.count("*").alias("of_entity"), F.sum(code).alias("in_documents"))
    first = profiles.groupBy("of_entity", "in_documents").agg(F.min("entity").alias("group"))
    profiles = materialise(profiles.join(first, ["of_entity", "in_documents"]).select("entity", "group", "of_entity"))

    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_TERM), 0))
    of_term = texts.select(F.explode(found).alias("term")).groupBy("term").agg(F.count("*").alias("of_term"))
    of_term = materialise(of_term.join(words.select("term").distinct(), "term", "left_semi"))

    groups = held.join(profiles.filter("of_entity > 1"), "entity").select("hash", "group", "of_entity").distinct()
    rare = words.join(of_term, "term")
    joint = groups.join(rare, "hash").filter(F.col("of_term") < 4 * F.col("of_entity"))
    joint = materialise(joint.groupBy("group", "term").agg(F.count("*").alias("joint"), F.first("of_term").alias("of_term")))
    share = lambda near: (F.col("joint") + near) / (F.col("of_term") + near + 1)
    far = joint.withColumn("share", share(F.lit(0))).filter(F.col("share") > GENERALISE).select("group", "term", "share")
    far = groups.select("hash", "group").join(far, "group").join(words, ["hash", "term"], "left_semi")

    beside = mentions.select("hash", "entity", F.explode("near").alias("term")).distinct().join(words, ["hash", "term"], "left_semi")
    beside = beside.groupBy("entity", "term").agg(F.count("*").alias("near")).join(profiles, "entity").join(of_term, "term")
    once = beside.filter("of_entity = 1").withColumn("joint", F.lit(1).cast("long"))
    more = beside.filter("of_entity > 1").join(joint.select("group", "term", "joint"), ["group", "term"])
    close = once.unionByName(more.select(once.columns)).withColumn("share", share(F.col("near"))).filter(F.col("share") > GENERALISE)
    close = held.join(close.select("entity", "term", "share"), "entity").join(words, ["hash", "term"], "left_semi")
    both = far.select("hash", "term", "share").unionByName(close.select("hash", "term", "share"))
    return both.groupBy("hash", "term").agg(F.max("share").alias("share"))


TERMS = "array<struct<start: bigint, end: bigint, byte: bigint, byte_end: bigint, share: double>>"


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, hash, base, terms`` of every row: spans of the patterns, and places and shares of revealing terms.

    Places of terms are ``start, end`` in signs and ``byte, byte_end``; ``hash`` is the digest of the text.
    """
    text = whole_text(docs)
    texts = docs.select(docs["doc_id"].alias("doc_id"), F.md5(text.cast("binary")).alias("hash"), text.alias("text"))
    held = texts.select("doc_id", "hash", base_spans(F.col("text")).alias("base"), "text")
    held = materialise(held.withColumn("text", F.when(F.size("base") > 0, masked(F.col("text")))))
    documents = materialise(each_once(held.filter(F.size("base") > 0).select("hash", "base", "text")))
    words = materialise(words_of(documents))
    revealing = materialise(disclosures(documents, words, each_once(texts.select("hash", "text"))))
    spans = occurrences(documents, revealing)
    terms = materialise(spans.groupBy("hash").agg(F.sort_array(F.collect_list(F.struct("start", "end", "byte", "byte_end", "share"))).alias("terms")))
    return held.drop("text").join(terms, "hash", "left").select("doc_id", "hash", "base", F.coalesce("terms", F.expr(f"cast(array() as {TERMS})")).alias("terms"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def all_spans() -> Column:
    """The spans of ``base`` and ``terms`` in order of start, then kind."""
    short = lambda s, rank, kind: F.struct(s["start"].alias("start"), rank.alias("rank"), s["end"].alias("end"), kind.alias("kind"))
    base = F.transform("base", lambda s: short(s, s["rank"], s["kind"]))
    terms = F.transform("terms", lambda s: short(s, F.lit(len(PATTERNS)), F.lit("term")))
    return F.sort_array(F.concat(base, terms))


def sanitised(text: Column) -> Column:
    """``text`` without its personal data: base spans and generalised terms as placeholders, the rest of terms removed.

    What overlaps a span before it is covered by that span's placeholder as far as that reaches.
    """
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["byte"].alias("byte"), (s["byte"] + s["end"] - s["start"]).alias("byte_end"), F.concat(F.lit("["), s["kind"], F.lit("]")).alias("put")))
    terms = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["byte"].alias("byte"), s["byte_end"].alias("byte_end"), F.when(s["share"] > REMOVE, "").otherwise("[term]").alias("put")))
    put = lambda s, reach: F.when(s["start"] >= reach, s["put"]).otherwise("")
    return bound(F.sort_array(F.concat(base, terms)), lambda x: rebuilt(text, x, put))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` sanitised."""
    found = find(docs).drop("doc_id").dropDuplicates(["hash"]).select(F.col("hash").alias("of"), "base", "terms")
    rows = carried(docs, tuple(docs.columns), hash=F.md5(whole_text(docs).cast("binary")))
    both = rows.join(found, F.col("hash") == F.col("of"))
    clean = sanitised(F.col("text"))
    return both.select(*[(clean if name == "text" else F.col(f"row.`{name}`")).alias(name) for name in docs.columns])
