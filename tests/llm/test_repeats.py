import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import made
from pyspark.sql import functions as F

from farelake.llm import queries, recompress
from farelake.llm.wordhash import word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, window):
    """Brute force over distinct (id, text) in the order of ids, nulls first."""
    seen, out = set(), {}
    for row in sorted(dict.fromkeys(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        w = WORD.findall(row[1] or "")
        gone = set()
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if key in seen:
                gone |= set(range(k, k + window))
            seen.add(key)
        out[row] = (len(w), len(gone), " ".join(w[k] for k in range(len(w)) if k not in gone))
    return out


def compare(docs, rows, window=20):
    want = expected(rows, window)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in recompress.drop_repeats(docs, window).collect())
    assert got == Counter((row[0], *want[row]) for row in rows)


def test_edge(edge, edge_rows):
    # Null ids tie: their copies are compared apart from the others.
    rows = [r for r in edge_rows if r[0] is not None]
    compare(edge.where("doc_id is not null"), rows)
    nulls = [r for r in edge_rows if r[0] is None]
    compare(edge.where("doc_id is null"), nulls)


@pytest.mark.parametrize("seed", range(3))
def test_few_words_many_repeats(spark, seed):
    """Small alphabets, periods and long runs, where windows overlap themselves."""
    r = random.Random(seed)
    rows = []
    for i in range(30):
        parts = []
        while len(parts) < 150:
            kind = r.randrange(4)
            if kind == 0:
                parts += ["a"] * r.randrange(1, 40)
            elif kind == 1:
                parts += ["a", "b", "c"][: r.randrange(1, 4)] * r.randrange(1, 15)
            else:
                parts += [r.choice("abcd") for _ in range(r.randrange(1, 40))]
        rows.append((i, " ".join(parts)))
    compare(made(spark, rows), rows)


def test_equal_windows_have_equal_symbols():
    r = random.Random(5)
    window = 20
    words = [f"v{r.randrange(6)}" for _ in range(4000)]
    words += words[500:900] + [f"v{r.randrange(3)}" for _ in range(500)] + words[500:700]
    hashed = word_hashes(" ".join(words).encode())
    doc = np.repeat([0, 1], [3000, len(words) - 3000])
    key, _, first, count = recompress.anchors(hashed, doc, window)
    of = {}
    for k, f, c in zip(key, first, count, strict=True):
        for at in range(f, f + c):
            assert at not in of
            of[at] = k
    by_window = {}
    for at in of:
        assert by_window.setdefault(tuple(words[at : at + window]), of[at]) == of[at]
    assert len(of) == len(words) - 2 * (window - 1)


def test_empty(empty):
    assert recompress.drop_repeats(empty).count() == 0


def test_query(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = expected(rows, 20)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.substring_dedup(spark, small).collect()}
    assert got == {i: (n, m, hashlib.sha256(t.encode()).hexdigest()) for (i, _), (n, m, t) in want.items()}


def test_texts_of_one_id_with_equal_short_hashes(spark):
    """Two texts of one id that 32 bits of hash don't tell apart: each loses its own words only."""
    texts = [" ".join(f"{c}{i}" for i in range(n)) + f" x{k}" for c, n, k in (("a", 60, 1965), ("b", 30, 175605))]
    rows = [(1, " ".join(f"a{i}" for i in range(25, 60))), (2, texts[0]), (2, texts[1])]
    docs = made(spark, rows)
    assert len({r.h for r in docs.where("doc_id = 2").select(F.hash("text").alias("h")).collect()}) == 1
    compare(docs, rows)
