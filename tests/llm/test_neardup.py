import random
import re

import numpy as np
import pytest
from cases import made

from farelake.llm import neardup, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def roots(rows, k, percent):
    """Brute force: smallest reachable id of each row."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    groups = {}
    for x in range(len(rows)):
        groups.setdefault(find(x), []).append(x)
    out = []
    for x, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in groups[find(x)] if rows[m][0] is not None]
        out.append((len(sets[x]), (min(ids, default=None) if sets[x] else i)))
    return out


def compare(docs, rows, k, percent=80):
    got = sorted(
        ((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs, k, percent).collect()),
        key=str,
    )
    want = [
        (i, n, root, i == root if i is not None and root is not None else root is None)
        for (i, _), (n, root) in zip(rows, roots(rows, k, percent), strict=True)
    ]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("k", [2, 5])
def test_edge(edge, edge_rows, k):
    compare(edge, edge_rows, k)


def variants(n, seed):
    """A large group of near copies whose links form chains, and others that only share a passage."""
    r = random.Random(seed)
    base = [f"b{r.randrange(300)}" for _ in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(r.randrange(0, 14)):
            words[r.randrange(len(words))] = f"n{r.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    for i in range(n, n + 40):
        own = [f"o{r.randrange(10**6)}" for _ in range(60)]
        rows.append((i, " ".join([*base[:60], *own])))
    return rows


def test_large_group(spark):
    rows = variants(150, 3)
    compare(made(spark, rows), rows, 2)


def test_exactly_at_the_bound(spark):
    # 8 of 10 shingles in common: 80 percent; 7 of 9 is less.
    a = "a b c d e f g h i j"
    rows = [(1, a), (2, "a b c d e f g h i x"), (3, " ".join(["p q r s t u v w x y", "z"])), (4, "p q r s t u v w x y")]
    compare(made(spark, rows), rows, 2)
    compare(made(spark, rows), rows, 2, 90)


def test_copies_only_and_empty(spark, empty):
    rows = [(i, "the same text of some words") for i in range(20)]
    compare(made(spark, rows), rows, 2)
    assert neardup.near_duplicates(empty).count() == 0


def test_dropping_keeps_one_of_each(spark, edge, edge_rows):
    kept = neardup.drop_near_duplicates(edge, 5)
    assert set(kept.columns) == set(edge.columns)
    want = [
        i
        for (i, _), (_, root) in zip(edge_rows, roots(edge_rows, 5, 80), strict=True)
        if (i == root if i is not None and root is not None else root is None)
    ]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)


def test_min_max_agreement_is_unbiased():
    r = random.Random(1)
    common = [f"c{r.randrange(10**9)}" for _ in range(800)]
    texts = [" ".join(common + [f"{s}{k}" for k in range(100)]).encode() for s in "xy"]
    a, b = (neardup.shingle_set(t, 1) for t in texts)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    times, plus = neardup.constants(400, 1), neardup.constants(400, 2)
    same = 0
    for m, p in zip(times, plus, strict=True):
        x, y = a * m + p, b * m + p
        same += int(x.min() == y.min()) + int(x.max() == y.max())
    assert abs(same / 800 - true) < 0.06


def test_query(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.near_duplicates(spark, small).collect()}
    assert got == {i: (n, root, root == i) for (i, _), (n, root) in zip(rows, roots(rows, 2, 80), strict=True)}


def families(seed, members=45, groups=6):
    """Copies of one text that were edited together in groups, then apart: links within a group, few or none with the
    text itself; some grow or shrink, and a few stand between groups."""
    r = random.Random(seed)
    base = [f"b{r.randrange(10**6)}" for _ in range(150)]
    rows = []

    def edited(words, times, tag):
        words = list(words)
        for _ in range(times):
            words[r.randrange(len(words))] = f"{tag}{r.randrange(10**6)}"
        return words

    kinds = [edited(base, r.randrange(0, 16), "g") for _ in range(groups)]
    for _ in range(members * groups):
        words = edited(r.choice(kinds), r.randrange(0, 8), "e")
        if r.random() < 0.3:
            words = words[: r.randrange(100, len(words))]
        if r.random() < 0.3:
            words += [f"t{r.randrange(40)}" for _ in range(r.randrange(30))]
        rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("seed, percent", [(1, 80), (2, 80), (3, 70), (4, 90)])
def test_groups_that_were_edited_together(spark, seed, percent):
    rows = families(seed)
    compare(made(spark, rows), rows, 2, percent)


def test_pairs_of_a_large_group_of_unlinked_copies_are_few(spark, monkeypatch):
    r = random.Random(7)
    base = [f"b{k}" for k in range(150)]
    rows = []
    for i in range(900):
        words = list(base)
        for _ in range(r.randrange(2, 18)):
            words[r.randrange(len(words))] = f"n{r.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    counts = {}
    stored = neardup.stored

    def counted(df, name):
        counts[name] = counts.get(name, 0) + (table := stored(df, name)).count()
        return table

    monkeypatch.setattr(neardup, "stored", counted)
    compare(made(spark, rows), rows, 2)
    # All of a bucket would be some hundred thousand pairs.
    assert counts["left"] > 500 and counts["rest"] <= 5 * len(rows)


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"w{k}" for k in range(60))
    near = text.replace("w30 ", "x ")
    rows = [(1, text)] * 3 + [(None, near)] * 2 + [(2, near)] + [(None, "other " * 30)] * 2
    rows += [(5, text + " a"), (5, text + " b"), (6, None), (6, None)]
    kept = sorted(((r.doc_id, r.text) for r in neardup.drop_near_duplicates(made(spark, rows), 5).collect()), key=str)
    assert kept == sorted([(1, text), (None, "other " * 30), (6, None), (6, None)], key=str)
