"""Document fingerprints by I-Match, in DataFrame operations only.

Terms within a band of document frequency make up the lexicon. A term's hash puts it into nested random subsets of the
lexicon, each level half of the one before. A document's fingerprint has, for the levels at which few of its terms are
left, a hash of its distinct terms in each subset; a change to the text changes only the subsets that it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NO_TERM, ranked, same, shuffled, stored

#: Share of all documents that a term must be in, least and most.
LOW, HIGH = 3e-4, 0.1
#: Independent subsets to a level, levels, and levels in a fingerprint. The hashes of a term hold 32 bits for each
#: subset, one to a level; no text has the 2^30 distinct terms at which a document would run out of levels.
SUBSETS, LEVELS, USED = 8, 33, 3
#: A lexicon has at most (distinct terms of a mean document) / LOW terms; beyond this many it is joined by shuffle.
BROADCAST_TERMS = 4_000_000


def _distinct_terms(text: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NO_TERM), ""))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """(``h``): hashes of the terms in a share of the documents between ``low`` and ``high``, counted over all texts."""
    total = docs.count()
    terms = docs.select(F.explode(_distinct_terms(F.col("text"))).alias("t")).select(F.xxhash64("t").alias("h"))
    counted = terms.groupBy("h").count()
    return stored(counted.where((F.col("count") >= low * total) & (F.col("count") <= high * total)).select("h"), "lexicon")


def _marked(rows: DataFrame, keys: list[str], words: DataFrame) -> DataFrame:
    """(``keys``, ``h``, ``k``): the hash of each distinct term of each ``body``, null for a row without terms, and the
    same hash again where the lexicon has it."""
    terms = rows.select(*keys, F.explode_outer(_distinct_terms(F.col("body"))).alias("t"))
    hashed = terms.select(*keys, F.when(F.col("t").isNotNull(), F.xxhash64("t")).alias("h"))
    known = words.select(F.col("h").alias("k"))
    known = F.broadcast(known) if words.count() <= BROADCAST_TERMS else shuffled(known)
    return hashed.join(known, F.col("h") == F.col("k"), "left")


def fingerprints(rows: DataFrame, keys: list[str], words: DataFrame) -> DataFrame:
    """(``keys``, ``level``, ``parts``) for the ``body`` of each row; ``keys`` must tell the rows apart.

    ``parts`` are strings of a level, a subset and the hash of the row's terms there; subsets without a term are left
    out. Hashes of the distinct terms are combined by exclusive or, whose outcome no order changes, as sorting them
    would. A text without a term of the lexicon has one part made of all its terms, one without terms none.

    The terms of the lexicon in a row decide its levels, hence they are counted first, unless ``rows`` brings their
    number as ``n``; then only the subsets of its own levels are summed.
    """
    if "n" not in rows.columns:
        counts = stored(_marked(rows, keys, words).groupBy(*keys).agg(F.count("k").alias("n")), "term_counts")
        counts = counts.select("n", *[F.col(key).alias(f"_{i}") for i, key in enumerate(keys)])
        on = [same(F.col(key), F.col(f"_{i}")) for i, key in enumerate(keys)]
        rows = rows.join(shuffled(counts), on).select(*keys, "body", "n")
    rows = rows.withColumn("level", F.floor(F.log2(F.greatest("n", F.lit(1)))).cast("int"))
    marked = _marked(rows, [*keys, "n", "level"], words)
    marked = marked.select(
        *keys,
        "n",
        "level",
        F.when(F.col("h").isNotNull(), F.xxhash64("h", F.lit(3))).alias("m"),
        F.when(F.col("k").isNotNull(), F.xxhash64("k", F.lit(3))).alias("km"),
        *[F.xxhash64("k", F.lit(seed)).alias(name) for name, seed in (("b0", 1), ("b1", 2), ("c0", 4), ("c1", 5))],
    )
    marked = marked.select(
        *keys,
        "n",
        "level",
        "m",
        "km",
        *[_bits(subset).alias(f"v{subset}") for subset in range(SUBSETS)],
        *[F.expr(f"shiftleft(1L, level + {up}) - 1").alias(f"mask{up}") for up in range(USED)],
    )
    sums = [
        F.bit_xor(F.when(F.col(f"v{subset}").bitwiseAND(F.col(f"mask{up}")) == 0, F.col("km"))).alias(f"s{up}_{subset}")
        for up in range(USED)
        for subset in range(SUBSETS)
    ]
    out = marked.groupBy(*keys, "n", "level").agg(F.bit_xor("m").alias("every"), *sums)

    def of_level(up: int) -> Column:
        values = F.array(*[F.col(f"s{up}_{subset}") for subset in range(SUBSETS)])
        at = F.col("level") + up
        part = F.transform(
            values,
            # All subsets of level 0 are the whole lexicon: one of them stands for it.
            lambda v, j: F.when(
                v.isNotNull() & ((at > 0) | (j == 0)),
                F.concat(
                    F.lpad(at.cast("string"), 2, "0"),
                    F.lit("."),
                    j.cast("string"),
                    F.lit(":"),
                    F.lower(F.lpad(F.hex(v.bitwiseAND(0xFFFFFFFF)), 8, "0")),
                ),
            ),
        )
        return F.filter(part, lambda p: p.isNotNull())

    parts = F.concat(*[of_level(up) for up in range(USED)])
    whole = F.when(F.col("every").isNotNull(), F.array(F.concat(F.lit("w:"), F.lower(F.hex("every")))))
    empty = F.array().cast("array<string>")
    return out.select(*keys, "level", F.when(F.col("n") > 0, parts).otherwise(F.coalesce(whole, empty)).alias("parts"))


def _bits(subset: int) -> Column:
    """32 bits of a term's hashes; it is in the subset's level if as many of the lowest ones are 0."""
    low, high = (F.shiftrightunsigned(f"{of}{subset // 4}", 16 * (subset % 4)).bitwiseAND(0xFFFF) for of in "bc")
    return low.bitwiseOR(F.shiftleft(high, 16))


def fingerprint(level: Column, parts: Column) -> Column:
    return F.concat(level.cast("string"), F.lit("|"), F.array_join(parts, " "))


def likeness(level: Column, parts: Column, other_level: Column, other_parts: Column) -> Column:
    """Share of equal parts, from 0 to 1, on the levels that both fingerprints have; 1 if nothing differs."""
    first, last = F.greatest(level, other_level), F.least(level, other_level) + USED - 1

    def common(of: Column) -> Column:
        number = lambda p: F.coalesce(F.try_to_number(F.substring(p, 1, 2), F.lit("99")).cast("int"), F.lit(-1))
        return F.filter(of, lambda p: (number(p) >= first) & (number(p) <= last))

    a, b = common(parts), common(other_parts)
    both, sizes = F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)
    same = (level == other_level) & (parts == other_parts)
    return F.when(same, 1.0).when(sizes == 0, 0.0).otherwise(2.0 * both / sizes)


def edited_texts(docs: DataFrame) -> DataFrame:
    """Each document and its edited text: ``rank`` (from 0, by id, then by a hash of the text), ``doc_id``, ``text``,
    ``n_chars``, ``edited``, and ``k1`` and ``k2``, hashes of id and text. Of a text of n code points the last floor(n / 4) are replaced by the first as many, or all
    there are, of the next document; the last document takes them from the first.

    Ranks come from a range sort of ids and lengths only. Texts are shuffled once, by a hash of id and text; a prefix
    travels to the document before it.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumns(
        {
            "k1": F.xxhash64("doc_id", F.col("doc_id").isNull(), "text"),
            "k2": F.xxhash64(F.lit(1), "text", "doc_id"),
        }
    )
    slim = keyed.select("doc_id", "k1", "k2", F.char_length("text").alias("n_chars")).distinct()
    order = stored(ranked(slim, ["doc_id", "k1", "k2"]), "order")
    total = order.count()
    before = order.select(
        F.pmod(F.col("rank") + 1, F.lit(max(1, total))).alias("rank"),
        F.col("k1").alias("p1"),
        F.col("k2").alias("p2"),
        F.floor(F.col("n_chars") / 4).cast("int").alias("give"),
    )
    places = stored(order.join(shuffled(before), "rank"), "places")
    # Both uses take the same columns of the texts, so that Spark shuffles them once.
    bodies = keyed.select("k1", "k2", "text").dropDuplicates(["k1", "k2"])
    here = bodies.join(shuffled(places), ["k1", "k2"])
    prefixes = here.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.expr("left(text, give)").alias("prefix"))
    joined = here.join(shuffled(prefixes), ["k1", "k2"])
    edited = F.concat(F.expr("left(text, n_chars - floor(n_chars / 4))"), F.expr("left(prefix, floor(n_chars / 4))"))
    n_chars = F.col("n_chars").cast("long").alias("n_chars")
    return joined.select("k1", "k2", "rank", "doc_id", "text", n_chars, edited.alias("edited"))


def compare_edited(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Fingerprints of documents and of their edited texts, and their likeness.

    ``docs`` has ``doc_id`` and ``text`` (null: empty). Result: ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next`` (likeness to the next document by id).

    Equal texts have equal fingerprints. Texts without terms have the fingerprint "0|". Null ids come first; documents
    with one id go in the order of a hash. Rows equal in id and text are one document and give one row. A table of one
    document takes it as its own next. Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    words = lexicon(docs, low, high)
    rows = edited_texts(docs)
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("side"), F.col("edited").alias("body")),
    )
    sided = rows.select("k1", "k2", F.explode(sides).alias("s")).select("k1", "k2", "s.side", "s.body")
    number = [F.count(F.when(F.col("side") == side, F.col("k"))).alias(f"n{side}") for side in (0, 1)]
    counts = stored(_marked(sided, ["k1", "k2", "side"], words).groupBy("k1", "k2").agg(*number), "term_counts")
    # Texts and counts lie by the same hashes, so that the counts go to the texts.
    rows = rows.join(shuffled(counts), ["k1", "k2"]).withColumn("edited_sha256", F.sha2("edited", 256))
    about = ["rank", "doc_id", "n_chars", "edited_sha256"]
    rows = rows.select(*about, "n0", "n1", F.explode(sides).alias("s")).select(*about, "n0", "n1", "s.side", "s.body")
    rows = rows.select(*about, "side", "body", F.when(F.col("side") == 0, F.col("n0")).otherwise(F.col("n1")).alias("n"))
    prints = fingerprints(rows, [*about, "side"], words)
    prints = stored(prints, "prints")
    own = prints.where("side = 0").drop("side")
    edited = prints.where("side = 1").select("rank", F.col("level").alias("e_level"), F.col("parts").alias("e_parts"))
    total = own.count()
    after = own.select(
        F.pmod(F.col("rank") - 1, F.lit(max(1, total))).alias("rank"),
        F.col("level").alias("x_level"),
        F.col("parts").alias("x_parts"),
    )
    both = own.join(shuffled(edited), "rank").join(shuffled(after), "rank")
    level, parts = F.col("level"), F.col("parts")
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(level, parts).alias("fingerprint"),
        fingerprint(F.col("e_level"), F.col("e_parts")).alias("edited_fingerprint"),
        likeness(level, parts, F.col("e_level"), F.col("e_parts")).alias("near_edited"),
        likeness(level, parts, F.col("x_level"), F.col("x_parts")).alias("near_next"),
    )
