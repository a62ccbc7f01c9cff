import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from areaday.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", None, " ", "Hello  World", "it's we'll I'VE 1234 a.b!!", "H̱ é x   y", "<|endoftext|> a<|endoftext|>b",
    "ΑΣ ΣΑΣ", "日本語 テキスト", "x" * 5000, "word " * 3000, "same", "same", "\x1c\x1d a\x0bb\x0cc", "🙂🙃 ok", "'sun ''s \"'s 'll've l'été", "Ünïcödé×÷ ²³ STRASSE straße ÿŸ", "a–b … “q” don’t",
]


def whole_ids(text):
    ids = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 0], "<u4")


def test_pieces_hold_the_ids_of_the_whole_texts(documents):
    found = {}
    for r in packing.pieces(documents(TEXTS), PATH).collect():
        found.setdefault(r.doc_id, []).append(r)
    for doc_id, text in enumerate(TEXTS):
        parts = sorted(found[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert b"".join(bytes(r.ids) for r in parts) == whole_ids(text).tobytes(), text
        assert all(r.length * 4 == len(r.ids) for r in parts) and all(r.length == 2048 for r in parts[:-1])
        assert [r.start for r in parts] == [2048 * i for i in range(len(parts))]


def test_given_documents_tokenise_as_whole_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in packing.pack_documents(docs, PATH).collect():
        ids = whole_ids(texts[r.doc_id])[r.start : r.start + r.length]
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32


def check(lengths, sequence, offset, capacity):
    for number in range(int(sequence.max(initial=-1)) + 1):
        inside = np.flatnonzero(sequence == number)
        order = inside[np.argsort(offset[inside])]
        assert len(order) and offset[order[0]] == 0
        assert (offset[order[1:]] == np.cumsum(lengths[order])[:-1]).all() and lengths[order].sum() <= capacity


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_sequences_are_gapless_and_close_to_the_bound(lengths):
    lengths = np.array(lengths, np.int64)
    sequence, offset = packing.best_two_fit(lengths, 20)
    check(lengths, sequence, offset, 20)
    assert sequence.max(initial=-1) + 1 <= 11 / 9 * max(1, -(-int(lengths.sum()) // 20)) + 2


def test_two_pieces_replace_the_smallest():
    # Greedy gives 6+3 and leaves a gap of 1; 3 makes way for 2+2.
    sequence, _ = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert sequence[0] == sequence[2] == sequence[3] != sequence[1]


@pytest.mark.parametrize("group", [7, 50_000])
def test_packing_a_table(spark, documents, group):
    docs = documents([f"{'w ' * (37 * i % 900)}" for i in range(60)] + [None, ""])
    cut = packing.pieces(docs, PATH, 256)
    rows = packing.pack(cut.select("doc_id", "piece", "length"), 256, group).collect()
    assert len(rows) == cut.count()
    numbers = {s: i for i, s in enumerate(sorted({r.sequence_id for r in rows}))}
    arrays = (np.array(x) for x in ([r.length for r in rows], [numbers[r.sequence_id] for r in rows], [r.offset for r in rows]))
    check(*arrays, 256)
    whole = packing.sequences(spark.createDataFrame(rows), cut)
    assert sum(len(r.ids) for r in whole.collect()) == 4 * sum(r.length for r in rows)


def test_empty_table(documents):
    assert packing.pack_documents(documents([]), PATH).collect() == []
