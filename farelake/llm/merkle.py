"""Manifest of a dataset as a Merkle tree, built and read by joins of siblings.

A node is keyed by its tree and its number there. On every level the first node of each run of ``FAN`` joins those at
the computed places behind it and emits their parent; proofs come back down the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ranked, same, shuffled, steps, stored

FAN = 8
#: Trees up to which their table is broadcast: a few numbers and a path each.
TREES_BROADCAST = 20_000

_PATH = "array<struct<before:string,after:string>>"


def encoded(value: Column) -> Column:
    """A value as it is hashed: ``-`` for null, else its bytes in UTF-8, counted, a colon, and the value."""
    text = value.cast("string")
    counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(value.isNull(), F.lit("-")).otherwise(counted)


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, values)), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf leads to over the siblings of its path."""
    return F.aggregate(path, start, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def proof(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def _runs(nodes: DataFrame, carry: Sequence[str]) -> DataFrame:
    """(``tree``, ``idx`` of the first, ``n``, ``s0`` ...): each run of ``FAN`` nodes as one row. A node at slot d of its
    run finds the place of the run's first node, which lies d before it. Those behind a first node join it as one row: a
    join for each slot would take the driver eight shuffles a level to plan and follow."""
    slot = F.pmod("idx", F.lit(FAN))
    node = F.struct("h", *carry)
    first = nodes.where(slot == 0).select("tree", "idx", "n", node.alias("s0"))
    behind = nodes.where(slot > 0).select(
        "tree", (F.col("idx") - slot).alias("idx"), slot.alias("slot"), node.alias("node")
    )
    at = [F.first(F.when(F.col("slot") == d, F.col("node")), ignorenulls=True).alias(f"s{d}") for d in range(1, FAN)]
    return first.join(shuffled(behind.groupBy("tree", "idx").agg(*at)), ["tree", "idx"], "left")


def _all_of(slots: Sequence[int]) -> Column:
    if not slots:
        return F.lit("")
    return F.concat(*[F.coalesce(F.col(f"s{d}")["h"], F.lit("")) for d in slots])


def grow(nodes: DataFrame, carry: Sequence[str], largest: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Runs of each level from the leaves up, and the single nodes (``tree``, ``h``) that trees of each height end in.

    ``nodes``: ``tree``, ``idx`` (from 0), ``n`` (nodes of the tree), ``h``; ``largest``: the largest ``n``."""
    levels, ends = [], []
    while True:
        ends.append(nodes.where("n = 1"))
        if largest <= 1:
            return levels, ends
        runs = stored(_runs(nodes.where("n > 1"), carry), "runs")
        levels.append(runs)
        above = (F.col("n") + (FAN - 1)) / FAN
        nodes = runs.select(
            "tree",
            (F.col("idx") / FAN).cast("long").alias("idx"),
            above.cast("long").alias("n"),
            F.sha2(_all_of(range(FAN)), 256).alias("h"),
        )
        carry, largest = [], -(-largest // FAN)


def descend(levels: list[DataFrame], ends: list[DataFrame], tops: DataFrame, carry: Sequence[str], few: bool) -> DataFrame:
    """(``tree``, ``idx``, ``h``, ``carry``, ``root``, ``path``) of each leaf. ``tops``: ``tree``, ``root`` and the
    ``path`` above the tree. Eight leaves share a row until the last step, which needs no shuffle."""

    def at_end(single: DataFrame, carried: Sequence[str]) -> DataFrame:
        top = F.broadcast(tops) if few else shuffled(tops)
        return single.select("tree", "idx", "h", *carried).join(top, "tree")

    found = at_end(ends[-1], carry if len(ends) == 1 else [])
    for k in range(len(levels) - 1, -1, -1):
        carried = carry if k == 0 else []
        above = found.select("tree", (F.col("idx") * FAN).alias("idx"), "root", "path")
        children = F.array(
            *[
                F.struct(
                    F.lit(d).alias("slot"),
                    F.col(f"s{d}").alias("node"),
                    F.struct(
                        _all_of(range(d)).alias("before"),
                        _all_of(range(d + 1, FAN)).alias("after"),
                    ).alias("siblings"),
                )
                for d in range(FAN)
            ]
        )
        below = levels[k].join(shuffled(above), ["tree", "idx"]).select("tree", "idx", "root", "path", F.inline(children))
        below = below.where("node is not null").select(
            "tree",
            (F.col("idx") + F.col("slot")).alias("idx"),
            F.col("node.h").alias("h"),
            *[F.col("node")[c].alias(c) for c in carried],
            "root",
            F.concat(F.array("siblings"), F.col("path")).alias("path"),
        )
        found = below.unionByName(at_end(ends[k], carried))
        if k:
            found = stored(found, "paths")
    return found


def merkle_manifest(leaves: DataFrame, group: str, order: str, carry: Sequence[str] = ()) -> DataFrame:
    """A row for each row of ``leaves``: ``order``, ``leaf``, the columns of ``carry``, ``subroot`` of its group,
    ``root``, and ``path``: for each level up to the root its siblings' digests, those before it and those after it.

    ``leaves`` has ``group``, ``order``, ``leaf`` (hex digest) and ``carry``, none of them named like this function's
    own ``tree``, ``idx``, ``n``, ``h``. In each group the leaves ascend by ``order``, nulls first, and equal ones by
    ``leaf``, so rows that repeat are leaves of their own and the root doesn't depend on the partitioning. Every ``FAN``
    consecutive nodes become the digest of their digests, the last run with fewer, until one is left; a lone leaf is its
    group's subroot. Subroots, null group first, then by bytes of UTF-8, likewise become the root. An empty table gives
    no rows.

    Groups may be of any sizes: nodes are spread by their place and not by their group.
    """
    spark = leaves.sparkSession
    carry = list(carry)
    with steps(spark) as kept:
        rows = leaves.select(group, order, F.col("leaf").alias("h"), *carry)
        rows = stored(ranked(rows, [group, order, "h"]), "ranked")
        trees = rows.groupBy(F.col(group).alias("_group")).agg(F.min("rank").alias("tree"), F.count("*").alias("n"))
        trees = stored(trees, "trees")
        count, largest = trees.agg(F.count("*"), F.max("n")).first()
        few = count <= TREES_BROADCAST
        of = F.broadcast(trees) if few else shuffled(trees)
        nodes = rows.join(of, same(F.col(group), F.col("_group")))
        nodes = nodes.select("tree", (F.col("rank") - F.col("tree")).alias("idx"), "n", "h", order, *carry)
        nodes = stored(nodes, "leaves")
        levels, ends = grow(nodes, [order, *carry], largest or 0)

        none = F.array().cast(_PATH)
        subroots = stored(reduce(DataFrame.unionByName, [e.select("tree", "h") for e in ends]), "subroots")
        top = ranked(subroots.withColumnRenamed("tree", "of"), ["of"])
        top = top.select(F.lit(0).cast("long").alias("tree"), F.col("rank").alias("idx"), "h", "of")
        top = stored(top.withColumn("n", F.lit(count).cast("long")), "top")
        top_levels, top_ends = grow(top, ["of"], count)
        root = top_ends[-1].select("tree", F.col("h").alias("root"), none.alias("path"))
        up = descend(top_levels, top_ends, root, ["of"], True)
        up = stored(up.select(F.col("of").alias("tree"), F.col("h").alias("root"), "path"), "subroot_paths")
        found = descend(levels, ends, up, [order, *carry], few)
        whole = root.first()
        out = found.select(
            order,
            F.col("h").alias("leaf"),
            *carry,
            F.col("root").alias("subroot"),
            F.lit(whole["root"] if whole else None).cast("string").alias("root"),
            "path",
        )
        out = stored(out, "manifest")
        kept.append(out)
    return out


def manifest_sql(depth: int = 8) -> str:
    """The query over ``documents`` in SQL: trees of up to ``FAN`` ** ``depth`` leaves, unrolled level by level."""

    def tree(name: str, leaves: str) -> list[str]:
        steps = [f"{name}0 AS ({leaves})"]
        for k in range(depth):
            steps += [
                f"""{name}s{k} AS (SELECT *,
  CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(h, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')
  END AS before,
  CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(h, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')
  END AS after FROM {name}{k} WINDOW r AS (PARTITION BY tree, idx // {FAN} ORDER BY idx))""",
                f"""{name}{k + 1} AS (SELECT tree, idx // {FAN} AS idx, (max(n) + {FAN - 1}) // {FAN} AS n,
  CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h
  FROM {name}{k} GROUP BY tree, idx // {FAN})""",
            ]
        return steps

    def way(name: str, tree: str, place: str) -> str:
        joins = ""
        for k in range(depth):
            joins += f" JOIN {name}s{k} {name}_{k} ON {name}_{k}.tree = {tree} AND {name}_{k}.idx = {place} // {FAN**k}"
        return joins

    def fields(text: str) -> str:
        parts = [
            f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
            for c in ("doc_id", "source", "lang", "n_chars", text)
        ]
        return "sha256(" + " || ".join(parts) + ")"

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    step = "(CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    before = ["(SELECT i, i AS c FROM range(256) r(i))", *[f"t{k}" for k in range(7)]]
    table = ", ".join(f"t{k} AS (SELECT i, {step} AS c FROM {before[k]})" for k in range(8))
    crc = (
        "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
        "lambda x: CAST(ascii(x) AS BIGINT))), "
        "lambda a, b: xor(crc_of[CAST(xor(a, b) & 255 AS INTEGER) + 1], a >> 8)), 4294967295)"
    )
    doc_joins, top_joins = way("doc", "doc.tree", "doc.idx"), way("top", "0", "top.idx")
    places = [f"{name}_{k}" for name in ("doc", "top") for k in range(depth)]
    folding = []
    for k, p in enumerate(places):
        name, level = p.split("_")
        single = f"{name}{level}_n = 1"
        folding.append(
            f"f{k + 1} AS (SELECT * REPLACE (CASE WHEN {single} THEN folded ELSE sha256({name}{level}_b || folded || "
            f"{name}{level}_a) END AS folded) FROM f{k})"
        )
    columns = ", ".join(
        f"{p}.n AS {p.replace('_', '')}_n, {p}.before AS {p.replace('_', '')}_b, {p}.after AS {p.replace('_', '')}_a"
        for p in places
    )
    siblings = " || ".join(f"{p.replace('_', '')}_b || {p.replace('_', '')}_a" for p in places)
    return f"""
WITH {table}, crcs AS (SELECT list(c ORDER BY i) AS crc_of FROM t7),
given AS (SELECT *, {crc} AS crc FROM documents, crcs),
hashed AS (SELECT doc_id, lang, {fields("text")} AS h,
  CASE WHEN crc % 3 = 0 THEN {fields(f"translate(text, '{upper}', '{lower}')")} ELSE {fields("text")} END AS folded
  FROM given),
doc AS (SELECT doc_id, h, folded, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS idx,
  count(*) OVER (PARTITION BY lang) AS n FROM hashed),
{", ".join(tree("doc", "SELECT tree, idx, n, h FROM doc"))},
{", ".join(tree("top", f"SELECT 0 AS tree, tree AS idx, (SELECT count(*) FROM doc{depth}) AS n, h FROM doc{depth}"))},
f0 AS (SELECT doc.doc_id, doc.h AS leaf, doc.folded, top.h AS subroot, {columns}
  FROM doc {doc_joins} JOIN top0 top ON top.idx = doc.tree {top_joins}),
{", ".join(folding)}
SELECT doc_id, leaf, subroot, top{depth}.h AS root, sha256({siblings}) AS proof_sha256, folded AS folded_root,
  folded = top{depth}.h AS verified
FROM f{len(places)}, top{depth}
"""
