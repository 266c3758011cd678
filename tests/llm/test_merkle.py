import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from farelake.llm import merkle, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(hashes):
    """Root of ``hashes``, and for each of them the siblings by level."""
    paths = [[] for _ in hashes]
    at = list(range(len(hashes)))
    while len(hashes) > 1:
        for leaf, place in enumerate(at):
            run = hashes[place // 8 * 8 :][:8]
            paths[leaf].append(("".join(run[: place % 8]), "".join(run[place % 8 + 1 :])))
            at[leaf] = place // 8
        hashes = [sha("".join(hashes[k : k + 8])) for k in range(0, len(hashes), 8)]
    return hashes[0], paths


def by_hand(rows):
    """(group, order, leaf) to (order, leaf, subroot, root, path)."""
    groups = defaultdict(list)
    for group, order, leaf in rows:
        groups[group].append((order is not None, order, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in names}
    root, above = tree([trees[g][0] for g in names])
    return [
        (order, leaf, trees[g][0], root, path + above[k])
        for k, g in enumerate(names)
        for (_, order, leaf), path in zip(sorted(groups[g]), trees[g][1], strict=True)
    ]


def found(spark, rows):
    df = spark.createDataFrame(rows, "g string, o long, leaf string").repartition(3)
    out = merkle.merkle_manifest(df, "g", "o").select("o", "leaf", "subroot", "root", "path")
    return [(*r[:4], [tuple(x) for x in r[4]]) for r in out.collect()]


@pytest.mark.parametrize("sizes", [[1], [2], [8], [9], [64], [65], [520, 1, 7], [3] * 70, [1] * 9])
def test_sizes(spark, sizes):
    names = [None, *[f"g{k}" for k in range(len(sizes) - 1)]]
    rows = [(names[k], i, sha(f"{k} {i}")) for k, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    assert sorted(found(spark, rows), key=repr) == sorted(by_hand(rows), key=repr)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [("ü", None, sha("a")), ("ü", None, sha("b")), ("z", 1, sha("c")), ("z", 1, sha("c")), ("z", 1, sha("d"))]
    rows += [(None, 5, sha("e")), ("", 5, sha("f")), ("\U0001f600", 1, sha("g")), ("￮", 1, sha("h"))]
    assert sorted(found(spark, rows), key=repr) == sorted(by_hand(rows), key=repr)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_path_leads_to_the_root_and_a_changed_leaf_does_not(spark, small):
    rows = queries.merkle_proofs(spark, small)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    assert rows.where(~tampered & ~F.col("verified")).isEmpty()
    texts = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    upper = F.col("text").rlike("[A-Z]")
    wrong = rows.join(texts, "doc_id").where(tampered & (upper == F.col("verified")))
    assert wrong.isEmpty()


def test_edge_rows(spark, edge, edge_rows):
    leaves = edge.select("lang", "doc_id", merkle.leaf(F.col("doc_id"), F.col("text")).alias("leaf"))
    have = merkle.merkle_manifest(leaves, "lang", "doc_id")

    def part(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    want = by_hand([("en", i, sha(part(i) + part(t))) for i, t in edge_rows])
    got = [(*r[:4], [tuple(x) for x in r[4]]) for r in have.select("doc_id", "leaf", "subroot", "root", "path").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_digest_of_a_proof(spark):
    path = [("a", "b"), ("", ""), ("c", "")]
    df = spark.createDataFrame([(path,)], f"p {merkle._PATH}")
    row = df.select(merkle.proof(df["p"]), merkle.fold(F.lit("x"), df["p"])).first()
    assert tuple(row) == (sha("abc"), sha("c" + sha(sha("axb"))))


def test_a_level_takes_one_join(spark):
    nodes = [(t, i, n, f"{t} {i}", {"k": i} if i % 2 else None) for t, n in ((0, 20), (20, 8), (28, 9)) for i in range(n)]
    df = spark.createDataFrame(nodes, "tree long, idx long, n long, h string, o map<string, int>").repartition(3)
    runs = merkle._runs(df, ["o"])
    assert runs._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    want = []
    for t, n in ((0, 20), (20, 8), (28, 9)):
        own = [(h, o) for tree, _, _, h, o in nodes if tree == t]
        want += [(t, i, n, *own[i : i + 8], *[None] * (i + 8 - n)) for i in range(0, n, 8)]
    rows = runs.select("tree", "idx", "n", *[f"s{d}" for d in range(8)]).collect()
    got = [(*r[:3], *[s and tuple(s) for s in r[3:]]) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
