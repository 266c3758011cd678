import importlib
from collections import Counter

import pytest
from test_decontam import terms
from test_lines import expected as repeated_lines
from test_neardup import roots

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        if name != "packing":
            assert out.columns == corpus_pipeline.COLUMNS
            assert out.count() <= before
            docs, before = out, out.count()
        else:
            assert out.select("doc_id").distinct().count() == before


def test_run_equals_its_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
    left = sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, small).select("doc_id").distinct().collect()) == left


def test_registered():
    registry = importlib.import_module("__spark_entry__")
    assert registry.queries()["pipeline"] is corpus_pipeline.run
    names = [n for n in registry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def read_rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def holds_item(text, items, least=0.8, stretch=20):
    """Whether any stretch of an item lies in the text with four fifths of its words, over every alignment."""
    w = terms(text)
    places = {}
    for k, word in enumerate(w):
        places.setdefault(word, []).append(k)
    for iw in items:
        n = min(len(iw), stretch)
        shifts = Counter(k - q for q, word in enumerate(iw) for k in places.get(word, ()))
        for shift, count in shifts.items():
            if len(iw) >= 5 and count >= least * n:
                eq = [0 <= shift + q < len(w) and w[shift + q] == iw[q] for q in range(len(iw))]
                if max(sum(eq[s : s + n]) for s in range(len(iw) - n + 1)) >= least * n:
                    return True
    return False


def test_each_stage_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [terms(r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = read_rows(docs)
        docs = stage(spark, docs, small)
        after = sorted(read_rows(docs))
        if name == "quality":
            assert set(after) <= set(before)
            clean, junk = ([i for i, _ in before if labels.get(i) == q] for q in (1, 0))
            kept = {i for i, _ in after}
            assert sum(i in kept for i in clean) >= 0.95 * len(clean) > 0
            assert sum(i in kept for i in junk) <= 0.2 * len(junk)
        elif name == "line_dedup":
            cut = repeated_lines(before)
            want = []
            for row in before:
                lines = (row[1] or "").split("\n")
                want.append((row[0], "\n".join(x for n, x in enumerate(lines) if n not in cut[row])))
            assert after == sorted(want)
        elif name == "near_duplicates":
            found = roots(before, 5, 80)
            assert after == sorted(row for row, (n, root) in zip(before, found, strict=True) if not n or row[0] == root)
        elif name == "decontamination":
            assert after == sorted(row for row in before if not holds_item(row[1], items))
