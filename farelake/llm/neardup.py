"""Near-duplicate documents by min-max hashing: both ends of every permutation make the signature."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import same, shuffled, steps, stored, without
from .wordhash import constants, mix, slices, texts, word_hashes

#: 30 bands of 5 values from 75 permutations: a pair of similarity 0.8 shares no band once in 150,000 times.
BANDS, ROWS = 30, 5
SEED = 5
_SIGNED = "n_shingles int, cls binary, bands array<bigint>"


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Hashes of the distinct runs of ``k`` words after lower-casing A-Z, ascending; with fewer words the whole
    sequence is one, and without words there are none."""
    w = word_hashes(text.lower() if text else None)
    if not len(w):
        return w
    n = min(k, len(w))
    factors = constants(n + 1, SEED)
    out = np.full(len(w) - n + 1, factors[n])  # short sequences differ from shingles by this term
    out += np.uint64(n)
    for i in range(n):
        out += w[i : len(w) - n + 1 + i] * factors[i]
    return np.unique(mix(out))


def _signatures(k: int):
    half = -(-BANDS * ROWS // 2)
    times, plus = constants(half, SEED + 1), constants(half, SEED + 2)
    weights = constants(BANDS * ROWS, SEED + 3).reshape(BANDS, ROWS)
    salt = constants(BANDS, SEED + 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            sets = [shingle_set(t, k) for t in texts(batch.column("text"))]
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            cls: list[bytes | None] = [None] * len(sets)
            bands: list[np.ndarray | None] = [None] * len(sets)
            if len(full):
                x = np.concatenate([sets[i] for i in full])
                starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                values = np.empty((len(full), 2 * half), np.uint64)
                for p in range(half):
                    v = x * times[p] + plus[p]
                    values[:, 2 * p] = np.minimum.reduceat(v, starts)
                    values[:, 2 * p + 1] = np.maximum.reduceat(v, starts)
                grid = values[:, : BANDS * ROWS].reshape(len(full), BANDS, ROWS)
                keys = mix((grid * weights).sum(axis=2, dtype=np.uint64) + salt).view(np.int64)
                low = np.add.reduceat(x, starts)
                high = np.add.reduceat(mix(x ^ salt[0]), starts)
                for row, i in enumerate(full):
                    cls[i] = low[row].tobytes() + high[row].tobytes()
                    bands[i] = keys[row]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("_th"),
                    pa.array(sizes.astype(np.int32)),
                    pa.array(cls, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "_th", "n_shingles", "cls", "bands"],
            )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            sets = [shingle_set(t, k).view(np.int64) for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("cls"), pa.array(sets, pa.list_(pa.int64()))], ["cls", "shingles"]
            )

    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose sets are similar enough, confirmed on the whole sets."""
    a = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    either = F.size("sa") + F.size("sb") - both
    return pairs.join(shuffled(a), "a").join(shuffled(b), "b").where(100 * both >= percent * either).select("a", "b")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(``cls``, ``comp``): the smallest node that each node reaches over undirected ``edges`` (a, b). In each round a
    node takes the smallest label of its neighbours, and then the label of that one."""
    ways = stored(edges.select("a", "b").unionAll(edges.select("b", "a")).distinct(), "ways")
    labels = nodes.select("cls", F.col("cls").alias("comp"))
    while True:
        seen = labels.select(F.col("cls").alias("b"), F.col("comp").alias("there"))
        lowest = ways.join(seen, "b").groupBy(F.col("a").alias("cls")).agg(F.min("there").alias("low"))
        # Stored, so that a label which most nodes have is split in the next join.
        stepped = labels.join(lowest, "cls", "left").select("cls", "comp", F.least("comp", "low").alias("next"))
        stepped = stored(stepped, "stepped")
        jump = stepped.select(F.col("cls").alias("next"), F.col("next").alias("then"))
        moved = (F.col("then") != F.col("comp")).alias("moved")
        labels = stored(stepped.join(jump, "next").select("cls", F.col("then").alias("comp"), moved), "labels")
        if labels.where("moved").isEmpty():
            return labels.select("cls", "comp")


def _possible(n: Column, free: Column, other_n: Column, other_free: Column, percent: int) -> Column:
    """Whether two sets of given sizes can be similar enough, each with so many shingles that another set has too."""
    both = F.least(free, other_free)
    return 100 * both >= percent * (n + other_n - both)


def _live(sets: DataFrame, percent: int) -> DataFrame:
    """(``cls``, ``n``, ``free``): size of each set and how many of its shingles occur in another set. Sets with too
    many shingles of their own are left out: they can't be linked with any."""
    known = sets.select("cls", F.xxhash64("cls").alias("id"), F.size("shingles").cast("long").alias("n"))
    own = (
        sets.select(F.explode("shingles").alias("h"), F.xxhash64("cls").alias("id"))
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("sets"), F.min("id").alias("id"))
        .where("sets = 1")
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("own"))
    )
    free = F.col("n") - F.coalesce("own", F.lit(0))
    out = known.join(shuffled(own), "id", "left").select("cls", "n", free.alias("free"))
    return out.where(100 * F.col("free") >= percent * F.col("n"))


def _heads(buckets: DataFrame) -> DataFrame:
    """The most central set of each bucket, that with the least share of own shingles."""
    order = F.struct(
        (-F.col("free") / F.col("n")).alias("off"),
        F.xxhash64("cls").alias("draw"),
        F.col("cls").alias("head"),
        F.col("n").alias("head_n"),
        F.col("free").alias("head_free"),
    )
    return buckets.groupBy("key").agg(F.min(order).alias("h")).select("key", "h.*")


def _star_pairs(buckets: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """Each set with the most central one of each of its buckets."""
    near = _possible(F.col("n"), F.col("free"), F.col("head_n"), F.col("head_free"), percent)
    pairs = buckets.join(shuffled(heads), "key").where((F.col("cls") != F.col("head")) & near)
    return pairs.select(F.least("cls", "head").alias("a"), F.greatest("cls", "head").alias("b")).distinct()


def _farthest(n: Column, other_n: Column, percent: int) -> Column:
    """Most shingles that only one of two linked sets of given sizes may have."""
    return F.floor((n + other_n) * (100 - percent) / (100 + percent))


def _members(buckets: DataFrame, heads: DataFrame, labels: DataFrame) -> DataFrame:
    """(``head``, ``cls``, ``n``, ``free``, ``comp``): whom each bucket's central set shares it with, where these are of
    several components."""
    of = buckets.join(shuffled(heads.select("key", "head")), "key").where("cls <> head")
    pairs = of.select("head", "cls", "n", "free").distinct()
    marked = stored(pairs.join(shuffled(labels), "cls"), "marked")
    open_heads = marked.groupBy("head").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return stored(marked.join(shuffled(stored(open_heads.select("head"), "open")), "head"), "left")


def _apart(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """A row for each member and shingle that only one of it and its head has: ``token``; how many such it has,
    ``d``; whether both are ``linked``; the head's size ``head_n``."""
    own = sets.select("cls", F.col("shingles").alias("s"))
    center = sets.select(F.col("cls").alias("head"), F.col("shingles").alias("c"))
    both = members.join(shuffled(own), "cls").join(shuffled(center), "head")
    tokens = F.array_union(F.array_except("s", "c"), F.array_except("c", "s"))
    found = both.withColumns({"head_n": F.size("c").cast("long"), "tokens": tokens}).drop("s", "c")
    found = found.withColumn("d", F.size("tokens").cast("long"))
    linked = F.col("d") <= _farthest(F.col("n"), F.col("head_n"), percent)
    return found.withColumn("linked", linked).withColumn("token", F.explode("tokens")).drop("tokens")


def _rest_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of a head that aren't of one component yet and could be linked.

    Of two such sets one at least isn't linked with their head. Sets x and y that differ from it in d(x) and d(y)
    shingles differ from each other in d(x) + d(y) - 2 * c, where c counts the shingles in which both differ from it. If
    they are linked that is at most ``_farthest``, so c has to be large: copies that were edited apart share hardly any
    edit. Shingles are put in one order, rare ones first; the first that two sets share then leaves either with c
    shingles at least, itself included. Shingles that no other member has take their places and pair with none.
    """
    rows = stored(_apart(members, sets, percent), "apart")
    counts = rows.groupBy("head", "token").agg(F.count(F.lit(1)).alias("sets"))
    order = Window.partitionBy("head", "cls").orderBy("sets", "token")
    placed = rows.join(shuffled(stored(counts, "counts")), ["head", "token"])
    placed = placed.withColumn("after", F.col("d") - F.row_number().over(order) + 1).where("sets > 1")
    # Whatever the other one, c is at least this for a set that is linked with one that isn't linked with the head.
    larger = F.ceil(F.greatest(F.col("n") - F.col("head_n"), F.lit(0)) * (100 - percent) / (100 + percent))
    least = F.greatest(F.ceil((F.col("d") + 1 - larger) / 2), F.lit(1))
    placed = stored(placed.withColumn("early", F.col("after") >= least).drop("sets", "head_n"), "placed")
    a, b = (
        placed.where(which).select(
            "head", "token", *[F.col(c).alias(f"{c}_{side}") for c in ("cls", "comp", "n", "free", "d", "linked", "after")]
        )
        for which, side in (("not linked", "a"), ("early", "b"))
    )
    common = F.ceil((F.col("d_a") + F.col("d_b") - _farthest(F.col("n_a"), F.col("n_b"), percent)) / 2)
    near = _possible(F.col("n_a"), F.col("free_a"), F.col("n_b"), F.col("free_b"), percent)
    once = F.col("linked_b") | (F.col("cls_a") < F.col("cls_b"))
    apart = (F.col("comp_a") != F.col("comp_b")) & near & once & (F.least("after_a", "after_b") >= common)
    pairs = a.join(shuffled(b), (a["head"] == b["head"]) & (a["token"] == b["token"]) & apart)
    return pairs.select(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b")).distinct()


def classes(signed: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(``cls``, ``comp``) of the set classes that may be linked with another one."""
    keys = stored(signed.select(F.explode("bands").alias("key"), "cls").distinct(), "keys")
    shared = keys.groupBy("key").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi")
    buckets = stored(keys.join(shuffled(stored(shared.select("key"), "shared")), "key"), "buckets")
    nodes = buckets.select("cls").distinct()

    rep = signed.groupBy("cls").agg(F.min(F.struct("doc_id", "_th")).alias("r"))
    wanted = stored(rep.join(shuffled(nodes), "cls").select("cls", "r.doc_id", "r._th"), "wanted")
    here = docs.select("doc_id", "text", F.xxhash64("text").alias("_th"))
    on = same(here["doc_id"], wanted["doc_id"]) & (here["_th"] == wanted["_th"])
    found = here.join(shuffled(wanted), on).select("cls", "text").dropDuplicates(["cls"])
    sets = stored(found.mapInArrow(_sets(k), "cls binary, shingles array<bigint>"), "sets")

    live = stored(_live(sets, percent), "live")
    buckets = stored(buckets.join(shuffled(live), "cls"), "live_buckets")
    heads = stored(_heads(buckets), "heads")
    pairs = stored(_star_pairs(buckets, heads, percent), "pairs")
    links = stored(_linked(pairs, sets, percent), "links")
    labels = components(live, links)
    members = _members(buckets, heads, labels)
    rest = stored(_rest_pairs(members, sets, percent).join(pairs, ["a", "b"], "left_anti"), "rest")
    more = stored(_linked(rest, sets, percent), "more_links")
    a, b = (labels.select(F.col("cls").alias(c), F.col("comp").alias(f"c{c}")) for c in "ab")
    bridges = more.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
    roots = components(labels.select(F.col("comp").alias("cls")).distinct(), bridges)
    roots = roots.select(F.col("cls").alias("comp"), F.col("comp").alias("root"))
    return labels.join(shuffled(roots), "comp").select("cls", F.col("root").alias("comp"))


def _grouped(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The signed rows with ``first``, the row that stands for their component: smallest id, none last, then the
    smallest hash of its text; null for rows without shingles."""
    docs = docs.select("doc_id", "text")
    given = docs.withColumn("_th", F.xxhash64("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    signed = stored(given.mapInArrow(_signatures(k), f"doc_id {id_type}, _th bigint, {_SIGNED}"), "signed")
    some = signed.where("cls is not null")
    with steps(docs.sparkSession) as kept:
        labels = classes(some, docs, k, percent)
        place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_th")
        lowest = some.groupBy("cls").agg(F.min(place).alias("low")).join(shuffled(labels), "cls", "left")
        lowest = stored(lowest.select("cls", F.coalesce("comp", "cls").alias("comp"), "low"), "lowest")
        roots = stored(lowest.groupBy("comp").agg(F.min("low").alias("first")), "roots")
        of = stored(lowest.join(shuffled(roots), "comp").select("cls", "first"), "first_of")
        kept.append(of)
    return signed.join(shuffled(of), "cls", "left")


def near_duplicates(docs: DataFrame, k: int = 2, percent: int = 80) -> DataFrame:
    """A row for each row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``_th`` (hash of the text), ``n_shingles``,
    ``component_id``, ``kept``.

    Two documents are linked if 100 * |A and B| >= ``percent`` * |A or B| for their sets of ``k``-word shingles
    (lower-cased A-Z). Candidates share a band of their min-max signatures; links are confirmed on whole sets.
    ``component_id`` is the smallest id of those that a document reaches over links, ``kept`` whether it is its own.

    Documents of equal sets are one class and are never paired. A class most of whose shingles no other candidate has
    can't be linked and drops out. Within a bucket, first all are compared with its most central member, then those of
    other components, by the shingles in which they differ from that member (see ``_rest_pairs``). So a large group of
    copies costs a few comparisons for each member, and no link between different components is left out.

    Null, empty and blank texts have no shingles and are components of their own. Null ids link like others but are
    never a ``component_id``; a component of null ids only has null and keeps all. Rows with one id are judged by
    their own texts, and equal rows alike. Columns besides the two are ignored; an empty table gives no rows.
    """
    out = _grouped(docs, k, percent)
    root: Column = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return out.select(
        "doc_id",
        "_th",
        F.col("n_shingles").cast("long").alias("n_shingles"),
        root.alias("component_id"),
        F.coalesce(F.col("doc_id") == root, root.isNull()).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, all columns; see ``near_duplicates``. It is the one of smallest id, null
    last, and then of the smallest hash of its text; of equal rows any one. Rows without words all stay."""
    with steps(docs.sparkSession) as kept:
        rows = _grouped(docs, k, percent).where("cls is not null")
        stays = same(F.col("doc_id"), F.col("first.doc_id")) & (F.col("_th") == F.col("first._th"))
        rows = stored(rows.select(F.col("doc_id").alias("_id"), F.col("_th").alias("_t"), stays.alias("_stays")), "judged")
        gone = stored(rows.where("not _stays").select("_id", "_t").distinct(), "gone")
        again = rows.where("_stays").groupBy("_id", "_t").count().where("count > 1").select("_id", "_t")
        again = stored(again, "again")
        kept += [gone, again]
    rows = without(docs, ["_id", "_t"])
    on = same(F.col("doc_id"), F.col("_id")) & (F.xxhash64("text") == F.col("_t"))
    left = rows.join(shuffled(gone), on, "left_anti")
    if again.isEmpty():
        return left
    one = left.join(shuffled(again), on, "left_semi").withColumn("_t", F.xxhash64("text"))
    one = one.dropDuplicates(["doc_id", "_t"]).drop("_t")
    return left.join(shuffled(again), on, "left_anti").unionByName(one)
