import hashlib
import re
from collections import Counter

import pytest
import xxhash
from cases import made, prose
from pyspark.sql import functions as F

from farelake.llm import imatch, queries

TERM = re.compile(r"[^\W_]+")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def distinct(text):
    return set(TERM.findall((text or "").lower()))


def order(rows):
    return sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))


def edited(rows):
    """(id, text) -> edited text, of rows whose ids don't tie."""
    found = order(rows)
    out = {}
    for k, (i, text) in enumerate(found):
        text, after = text or "", found[(k + 1) % len(found)][1] or ""
        n = len(text) // 4
        out[(i, found[k][1])] = text[: len(text) - n] + after[:n]
    return out


def test_edited_texts(edge, edge_rows):
    rows = [r for r in edge_rows if r[0] not in (None, 10)]
    got = imatch.edited_texts(edge.where("doc_id is not null and doc_id <> 10")).collect()
    want = edited(rows)
    assert {(r.doc_id, r.text): r.edited for r in got} == {(i, t or ""): e for (i, t), e in want.items()}
    assert len(got) == len(set(rows))


def test_lexicon_is_the_band(spark):
    rows = [(i, prose(i, words=60, vocabulary=300)) for i in range(50)]
    counts = Counter(t for _, text in rows for t in distinct(text))
    want = {signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t, n in counts.items() if 0.1 * 50 <= n <= 0.3 * 50}
    assert {r.h for r in imatch.lexicon(made(spark, rows), 0.1, 0.3).collect()} == want


def test_parts_are_hashes_of_subsets(spark):
    """Brute force of a fingerprint from its definition."""
    text = prose(4, words=100)
    words = {t: signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in distinct(text)}
    known = dict(list(words.items())[::2])
    lexicon = spark.createDataFrame([(h,) for h in known.values()], "h long")
    rows = spark.createDataFrame([(1, text), (2, None), (3, "none-of these")], "id long, body string")
    got = {r.id: r for r in imatch.fingerprints(rows, ["id"], lexicon).collect()}
    assert got[2].parts == [] and len(got[3].parts) == 1 and got[3].parts[0].startswith("w:")

    hashes = spark.createDataFrame([(h,) for h in known.values()], "h long").select(
        F.xxhash64("h", F.lit(1)).alias("b0"), F.xxhash64("h", F.lit(2)).alias("b1"), F.xxhash64("h", F.lit(3)).alias("m")
    )
    level = got[1].level
    assert level == min(len(known).bit_length() - 1, imatch.LEVELS - imatch.USED)
    want = set()
    for up in range(level, level + imatch.USED):
        for subset in range(imatch.SUBSETS):
            total, n = 0, 0
            for b0, b1, m in hashes.collect():
                bits = ((b0 if subset < 4 else b1) % 2**64) >> (16 * (subset % 4))
                if bits % (1 << up) == 0:
                    total, n = total ^ m, n + 1
            if n:
                want.add(f"{up:02d}.{subset}:{total % 2**32:08x}")
    assert set(got[1].parts) == want


def test_edge(edge, edge_rows):
    rows = imatch.compare_edited(edge).collect()
    assert len(rows) == len(set(edge_rows))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert all(r.n_chars >= 0 and re.fullmatch("[0-9a-f]{64}", r.edited_sha256) for r in rows)


def test_equal_and_unlike_texts(spark):
    rows = [(i, prose(i // 2, words=300, vocabulary=5000)) for i in range(40)]
    got = sorted(imatch.compare_edited(made(spark, rows)).collect(), key=lambda r: r.doc_id)
    for r in got:
        if r.doc_id % 2 == 0:
            assert r.near_next == 1.0 and r.fingerprint == got[r.doc_id + 1].fingerprint
        else:
            assert r.near_next < 0.3
    assert len({r.fingerprint for r in got}) == 20


def test_one_document_and_none(spark, empty):
    (row,) = imatch.compare_edited(made(spark, [(1, "alone in the table")])).collect()
    assert row.near_next == 1.0
    assert imatch.compare_edited(empty).count() == 0


@pytest.fixture(scope="module")
def whole(spark, small):
    return queries.document_fingerprints(spark, small).collect()


def test_query(spark, small, whole):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = edited(rows)
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in whole} == {
        i: (len(t), hashlib.sha256(want[(i, t)].encode()).hexdigest()) for i, t in rows
    }
    prints = {}
    texts = dict(rows)
    for r in whole:
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert sum(r.near_edited > r.near_next for r in whole) > 0.9 * len(whole)


@pytest.mark.parametrize("n", [3000, 70_000])
def test_levels_follow_long_texts(spark, n):
    """Beyond 2^10 terms, and beyond the 16 bits that one hash has for a subset, a subset still keeps few terms."""
    text = " ".join(f"t{i}" for i in range(n))
    lexicon = spark.createDataFrame([(text,)], "body string").select(F.explode(F.split("body", " ")).alias("t"))
    lexicon = lexicon.select(F.xxhash64("t").alias("h"))
    rows = spark.createDataFrame([(1, text), (2, text + " more"), (None, "t1 t2 t3 t4 of")], "id long, body string")
    got = {r.id: r for r in imatch.fingerprints(rows, ["id"], lexicon).collect()}
    level = n.bit_length() - 1
    assert got[1].level == got[2].level == level and got[1].parts == got[2].parts and got[None].level == 2

    hashes = [F.xxhash64("h", F.lit(seed)) for seed in (1, 2, 4, 5, 3)]
    bits = [[x % 2**64 for x in r] for r in lexicon.select(*hashes).collect()]
    want = []
    for up in range(level, level + imatch.USED):
        for subset in range(imatch.SUBSETS):
            low, high = ([r[i + subset // 4] >> (16 * (subset % 4)) & 0xFFFF for r in bits] for i in (0, 2))
            inside = [r[4] for r, a, b in zip(bits, low, high, strict=True) if (a | b << 16) % (1 << up) == 0]
            total = 0
            for m in inside:
                total ^= m
            if inside:
                assert len(inside) < 20
                want.append(f"{up:02d}.{subset}:{total % 2**32:08x}")
    assert got[1].parts == want
