"""Benchmark decontamination with spaced seeds, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NO_TERM, same, shuffled, stored, without

#: Word positions that each mask looks at. Five words a mask; no mask needs every residue of a period of five, so a
#: passage with each fifth word replaced is found as well.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 3, 5), (0, 1, 3, 5, 6), (0, 2, 3, 5, 7))
#: Further masks, of four words, for items of these numbers of words: with a fifth of their words replaced not every one
#: has five left that a mask above fits. Of every five words in a row one at most is replaced somewhere, and these four
#: masks see any four of five.
SHORT_MASKS = ((0, 1, 2, 3), (0, 2, 3, 4), (0, 1, 3, 4), (0, 1, 2, 4))
SHORT = (5, 6, 7, 10, 11, 15)
LEAST = 0.8
#: Longer items are compared in every stretch of so many words.
STRETCH = 20
#: Words of benchmark text that are broadcast at once; more items take further passes over the documents.
BLOCK_WORDS = 2_000_000
#: Positions of a text that are looked up at once: what is found in them is held until all of them are done.
PIECE = 512


Masks = tuple[tuple[int, ...], ...]


def terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NO_TERM), "")


def _hashes(words: Column, at: Column, masks: Masks) -> Column:
    """Hash of each mask laid at a position (counted from 0)."""
    return F.array(
        *[F.xxhash64(F.lit(m), *[F.get(words, at + offset) for offset in mask]) for m, mask in enumerate(masks)]
    )


def _positions(words: Column, masks: Masks) -> Column:
    shortest = min(max(mask) for mask in masks) + 1
    return F.when(F.size(words) >= shortest, F.sequence(F.lit(0), F.size(words) - shortest))


def overlaps(docs: DataFrame, items: DataFrame, least: float = LEAST, stretch: int = STRETCH) -> DataFrame:
    """Benchmark items found in documents: ``doc_id``, ``_th`` (hash of the text), ``item_id``, ``start`` (the word at
    which the item begins, negative if its beginning is missing), ``length`` (words compared), ``similarity``.

    Words are runs of letters and digits in lower case. An item is found where, word by word, a share of at least
    ``least`` of the item equals the document; items of more than ``stretch`` words count as found if any ``stretch``
    consecutive words do. Substituted words are tolerated, not inserted ones: behind an insertion the rest of a long
    item is found by itself. Items under five words are never found. Every text is searched whole. Where there are items
    of ``SHORT`` lengths the documents are searched with ``SHORT_MASKS`` as well.

    One row for each document and item, the best place. Null and empty texts, in either table, match nothing. Equal
    rows are one document; items with one id and several texts are all searched. Other columns are ignored, whatever
    their names; empty tables give no rows.
    """
    items = items.select("item_id", terms(F.col("text")).alias("iw")).where(F.size("iw") >= 5).distinct()
    items = items.withColumn("key", F.xxhash64("item_id", "iw"))
    total, longest = items.agg(F.sum(F.size("iw")), F.max(F.size("iw"))).first()
    blocks = max(1, -(-(total or 0) // BLOCK_WORDS))
    masks = MASKS if items.where(F.size("iw").isin(*SHORT)).isEmpty() else MASKS + SHORT_MASKS
    # Every stretch of so many words that is alike enough is hit by a mask of its own, so no hit has to see far from it.
    reach = stretch if least >= LEAST and stretch >= STRETCH else max(longest or 0, stretch)
    rows = docs.select("doc_id", F.xxhash64("text").alias("_th"), terms(F.col("text")).alias("w"))
    rows = _pieces(rows, masks, reach)
    found = None
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod("key", F.lit(blocks)) == block)
        here = _overlaps_of_block(rows, part, least, stretch, masks, reach)
        found = here if found is None else found.unionAll(here)
    best = F.max(F.struct("similarity", "length", (-F.col("start")).alias("back"))).alias("b")
    return (
        found.groupBy("doc_id", "_th", "item_id")
        .agg(best)
        .select("doc_id", "_th", "item_id", (-F.col("b.back")).alias("start"), "b.length", "b.similarity")
    )


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def _pieces(rows: DataFrame, masks: Masks, reach: int) -> DataFrame:
    """Texts in pieces of ``PIECE`` positions each: ``base`` (of the piece's first word), ``w`` and ``h`` (its words and
    their hashes, with what hits see before and behind them), ``first`` and ``last`` position in ``w``.

    Spark keeps all rows that the explodes and the join below make of one row until that row is done, so it must be
    short, and none of them may hold a whole text. Hashing the words ends the generated code that makes the pieces.
    """
    shortest = min(max(mask) for mask in masks) + 1
    last = F.size("w") - shortest
    starts = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(PIECE)))
    base = F.greatest(F.col("s") - reach, F.lit(0))
    out = rows.select("doc_id", "_th", "w", F.explode(starts).alias("s")).select(
        "doc_id",
        "_th",
        base.alias("base"),
        F.slice("w", base + 1, F.col("s") - base + PIECE + 2 * reach).alias("w"),
        (F.col("s") - base).alias("first"),
        (F.least(F.col("s") + (PIECE - 1), last) - base).alias("last"),
    )
    return out.withColumn("h", _word_hashes(F.col("w")))


def _overlaps_of_block(
    rows: DataFrame, items: DataFrame, least: float, stretch: int, masks: Masks, reach: int
) -> DataFrame:
    seeds = items.select("key", "iw", _word_hashes(F.col("iw")).alias("h"))
    seeds = seeds.select("key", "iw", "h", F.explode(_positions(F.col("iw"), masks)).alias("k"))
    seeds = seeds.select("key", "iw", "k", F.posexplode(_hashes(F.col("h"), F.col("k"), masks)).alias("mask", "hash"))
    seeds = seeds.where((F.col("mask") < len(MASKS)) | F.size("iw").isin(*SHORT)).drop("iw")
    places = rows.select("*", F.explode(F.sequence("first", "last")).alias("i"))
    places = places.select("*", F.explode(_hashes(F.col("h"), F.col("i"), masks)).alias("hash"))
    hits = places.join(F.broadcast(seeds), "hash")

    # A hit keeps the words from ``reach`` before it to twice that behind it, of the text and of the item.
    low = F.greatest(F.col("i") - reach, F.lit(0))
    hits = hits.select(
        "doc_id",
        "_th",
        "key",
        "k",
        "mask",
        (F.col("base") + F.col("i")).alias("i"),
        (F.col("i") - low).alias("at"),
        F.slice("w", low + 1, F.col("i") - low + 2 * reach).alias("w"),
    )
    hits = hits.join(F.broadcast(items), "key")

    # A mask that also fits one word earlier has already shown this place, unless that was too far away.
    offsets = F.array(*[F.array(*[F.lit(o) for o in mask]) for mask in masks])
    before = F.forall(
        F.get(offsets, F.col("mask")),
        lambda o: F.get("w", F.col("at") - 1 + o) == F.get("iw", F.col("k") - 1 + o),
    )
    hits = hits.where((F.col("i") == 0) | (F.col("k") % reach == 0) | ~F.coalesce(before, F.lit(False)))

    n = F.size("iw")
    length = F.least(n, F.lit(stretch))
    low = F.greatest(F.col("k") - reach, F.lit(0))
    ahead = F.least(n, F.col("k") + 2 * reach)
    hits = hits.select(
        "doc_id",
        "_th",
        "item_id",
        (F.col("i") - F.col("k")).alias("start"),
        length.alias("length"),
        "w",
        F.slice("iw", low + 1, ahead - low).alias("iw"),
        (F.col("at") - F.col("k") + low).alias("from"),
    )
    equal = F.transform("iw", lambda word, q: F.coalesce(F.get("w", F.col("from") + q) == word, F.lit(False)))
    hits = hits.withColumn("eq", F.transform(equal, lambda e: e.cast("int")))
    total = F.aggregate("eq", F.lit(0), lambda a, e: a + e)
    hits = hits.where(total >= F.ceil(F.col("length") * least))
    parts = F.transform(
        F.sequence(F.lit(1), F.size("eq") - F.col("length") + 1),
        lambda s: F.aggregate(F.slice("eq", s, F.col("length")), F.lit(0), lambda a, e: a + e),
    )
    hits = hits.withColumn("similarity", F.array_max(parts) / F.col("length"))
    return hits.where(F.col("similarity") >= least).select("doc_id", "_th", "item_id", "start", "length", "similarity")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents without those that hold a benchmark item, all columns; nulls and repeated rows as in ``overlaps``."""
    held = overlaps(docs, items).select(F.col("doc_id").alias("_id"), F.col("_th").alias("_t")).distinct()
    rows = without(docs, ["_id", "_t"])
    return rows.join(
        shuffled(stored(held, "held")), same(F.col("doc_id"), F.col("_id")) & (F.xxhash64("text") == F.col("_t")), "left_anti"
    )
