import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import made
from tokenizers import Tokenizer

from farelake.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, rows, tokenizer, length=2048):
    """Every id lies in one piece; sequences have no gaps and are full, or as long as a power of two."""
    by_sequence = {}
    by_doc = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
        by_doc.setdefault(p.doc_id, []).append(p)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == length or at & (at - 1) == 0
        assert at <= length
    want = {}
    for i, text in rows:
        want.setdefault(i, []).append(ids_of(tokenizer, text))
    assert set(want) == set(by_doc)
    for i, documents in want.items():
        assert sum(p.length for p in by_doc[i]) == sum(len(d) for d in documents)
        for p in by_doc[i]:
            ids = np.frombuffer(p.ids, "<u4").tolist()
            assert len(ids) == p.length
            assert any(d[p.start : p.start + p.length] == ids and p.doc_tokens == len(d) for d in documents)


def test_edge(edge, edge_rows, tokenizer):
    check(packing.pack_documents(edge, PATH).collect(), edge_rows, tokenizer)


def test_words_are_independent(tokenizer):
    texts = [
        "It's we'll 'tis rock'n'roll, don't!! (a).b, c;d 1.2,3 x%%% y### |z| a.b.c. end.",
        "É é é ÀÉ. ß, ñandú; «oui», naïve… 中文字 жизнь Σίσυφος ΟΔΟΣ.",
        "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>, \x1c\x85   x ﻿ \x00 .",
        "!!! ,,, . ,. a, A, a. A. aa!! AA!! 7, 7. x7, 7x.",
        "\x85 a\x85. \u2003 b\u2003 Straße, STRASSE. İstanbul ŉ, ǆ. ΣΑΣ. e\u0301t\u00e9, É! (é). »é«, 12. ½, ª.",
    ]
    encoder = packing.WordIds(PATH)
    for _ in range(2):  # new, then known
        got = encoder.encode([t.encode() for t in texts] + [None, b""])
        assert [g.tolist() for g in got] == [ids_of(tokenizer, t) for t in [*texts, None, ""]]


def test_more_words_than_remembered(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encoder = packing.WordIds(PATH)
    for text in ("one two three four five", "six seven, eight one. six", "nine! ten one"):
        assert encoder.encode([text.encode()])[0].tolist() == ids_of(tokenizer, text)


def test_curve_visits_every_cell_by_single_steps():
    points = np.array([[x, y, z] for x in range(8) for y in range(8) for z in range(8)])
    key = packing.hilbert(points, 3)
    assert sorted(key) == list(range(512))
    assert set(np.abs(np.diff(points[np.argsort(key)], axis=0)).sum(axis=1)) == {1}


def test_last_tokens_are_cut_at_powers_of_two():
    pieces = list(packing.pack(iter([("a", np.arange(10)), ("b", np.arange(11))]), 8))
    lengths = {}
    for _, _, ids, _, sequence, _ in pieces:
        lengths[sequence] = lengths.get(sequence, 0) + len(ids)
    assert list(lengths.values()) == [8, 8, 4, 1]


def test_copies_share_a_place(spark):
    rows = [(i, f"text number {i % 2} " * 30) for i in range(40)]
    pieces = packing.pack_documents(made(spark, rows), PATH).collect()
    order = [p.doc_id % 2 for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)) if p.start == 0]
    assert sum(a != b for a, b in zip(order, order[1:], strict=False)) == 1


def test_empty(empty):
    assert packing.pack_documents(empty, PATH).count() == 0


def test_query(spark, small, tokenizer):
    docs = {r.doc_id: ids_of(tokenizer, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for p in queries.packing_query(spark, small).collect():
        ids = docs[p.doc_id][p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


ODD = [
    *"HTJWhtjwAaEeIiSsKk",
    *"̸̱̣̈̌̊́̇ͅ",
    *"İıſẞßŉǅKÅΣςª½中ﬁ",
    *"%#$&*!.,|<>='-",
    *" \t\n\x0b\u0085  ​",
    *"0179",
]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_marks_cases_and_signs_in_any_order(tokenizer, seed):
    r = random.Random(seed)
    texts = ["".join(r.choice(ODD) for _ in range(r.randrange(1, 9))) for _ in range(30_000)]
    texts += ["H̱c", "İ#", "İ", "İ#", "T̈.", "Å!", "'S 'll", "a<|endoftext|>B", "<|endofTEXT|>"]
    want = {t: ids_of(tokenizer, t) for t in set(texts)}
    for _ in range(3):
        r.shuffle(texts)
        encoder = packing.WordIds(PATH)
        assert encoder.by_word
        for start in range(0, len(texts), 5000):
            part = texts[start : start + 5000]
            for text, ids in zip(part, encoder.encode([t.encode() for t in part]), strict=True):
                assert ids.tolist() == want[text], (text, [hex(ord(c)) for c in text])


def test_what_is_not_split_at_words_is_encoded_whole(edge, edge_rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not packing.WordIds(path).by_word
    check(packing.pack_documents(edge, path).collect(), edge_rows, Tokenizer.from_file(path))


def test_equal_rows_go_to_several_tasks(spark, tokenizer):
    rows = [(7, "one text " * 40)] * 3000 + [(k, f"text {k} " * 30) for k in range(10, 1500)]
    before = packing.FEW_TOKENS
    packing.FEW_TOKENS = 20_000
    try:
        pieces = packing.pack_documents(made(spark, rows).repartition(8), PATH).collect()
    finally:
        packing.FEW_TOKENS = before
    check(pieces, rows, tokenizer)
    assert len({p.sequence_id >> 40 for p in pieces if p.doc_id == 7}) > 1
