"""Substring dedup by recompression: rounds that name runs and pairs give equal substrings equal inner symbols.

A round names every maximal run of one symbol, then every pair of a left symbol followed by a right one; a hash of the
symbol decides its side. Names are hashes of what they stand for, so all tasks of the cluster give equal substrings
equal names without exchanging a dictionary. With each symbol goes its context, the words that decide that it is there.
Where a context lies inside of a window of words, every equal window holds the same symbol at the same place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, same, shuffled, steps, stored
from .wordhash import constants, mix, slices, texts, word_hashes

#: After two rounds a symbol stands for a few words, and nearly every window of twenty holds one with its context.
ROUNDS = 2
SEED = 17
#: Bits of a place that count words; the rest number the documents.
WORD_BITS = 28

_FAR = np.int64(1) << np.int64(60)
_C = constants(64, SEED)
_BASES = (int(_C[0]), int(_C[1]))


class Symbols:
    """Symbols of consecutive documents: names, contexts [lo, hi) in words, and the document of each."""

    def __init__(self, name: np.ndarray, doc: np.ndarray):
        self.name, self.doc = name, doc
        self.lo = np.arange(len(name), dtype=np.int64)
        self.hi = self.lo + 1

    def _touching(self) -> np.ndarray:
        """Whether symbols i and i + 1 are of one document."""
        return self.doc[1:] == self.doc[:-1]

    def name_runs(self, turn: int) -> None:
        n = len(self.name)
        if not n:
            return
        touching = self._touching()
        head = np.ones(n, bool)
        head[1:] = ~(touching & (self.name[1:] == self.name[:-1]))
        first = np.flatnonzero(head)
        last = np.append(first[1:], n) - 1
        length = (last - first + 1).astype(np.uint64)
        # That a run ends is decided by its neighbours; at the rim of a document by what no window can show.
        left = np.where(first > 0, self.lo[first - 1], -_FAR)
        left[1:][~touching[first[1:] - 1]] = -_FAR
        right = np.full(len(last), _FAR)
        right[:-1] = np.where(touching[last[:-1]], self.hi[last[:-1] + 1], _FAR)
        name = self.name[first]
        many = length > 1
        name[many] = mix(name[many] * _C[2 + turn] + length[many])
        self.lo, self.hi = np.minimum(self.lo[first], left), np.maximum(self.hi[last], right)
        self.name, self.doc = name, self.doc[first]

    def name_pairs(self, turn: int) -> np.ndarray:
        """Joins pairs; returns which symbols are new pairs."""
        n = len(self.name)
        if n < 2:
            return np.zeros(n, bool)
        right_side = (mix(self.name ^ _C[10 + turn]) & np.uint64(1)).astype(bool)
        touching = self._touching()
        opens = np.zeros(n, bool)
        opens[:-1] = ~right_side[:-1] & right_side[1:] & touching
        closes = np.zeros(n, bool)
        closes[1:] = opens[:-1]
        alone = ~opens & ~closes
        # A left symbol stays alone because of what follows it, a right one because of what precedes it.
        lo, hi = self.lo.copy(), self.hi.copy()
        after = np.append(np.where(touching, self.hi[1:], _FAR), _FAR)
        before = np.insert(np.where(touching, self.lo[:-1], -_FAR), 0, -_FAR)
        hi = np.where(alone & ~right_side, np.maximum(hi, after), hi)
        lo = np.where(alone & right_side, np.minimum(lo, before), lo)
        at = np.flatnonzero(opens)
        name = self.name.copy()
        name[at] = mix(self.name[at] * _C[20 + turn] + self.name[at + 1] * _C[30 + turn])
        hi[at] = self.hi[at + 1]
        keep = ~closes
        self.name, self.lo, self.hi, self.doc = name[keep], lo[keep], hi[keep], self.doc[keep]
        return opens[keep]


class Rolling:
    """Hashes of any stretch of words, from sums of words times powers of an odd base."""

    def __init__(self, words: np.ndarray, base: int):
        n = len(words)
        powers = np.full(n, np.uint64(base))
        powers[:1] = 1
        powers = np.multiply.accumulate(powers)
        self.back = np.full(n + 1, np.uint64(pow(base, -1, 2**64)))
        self.back[0] = 1
        self.back = np.multiply.accumulate(self.back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * powers, out=self.sums[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.sums[hi] - self.sums[lo]) * self.back[lo] + (hi - lo).astype(np.uint64))


def anchors(words: np.ndarray, doc: np.ndarray, window: int, rounds: int = ROUNDS):
    """The symbol that stands for each window of ``words``: arrays (key, place of the symbol, first window, windows),
    one entry for each run of windows with one symbol.

    A window takes, of the highest round that has any, the smallest-named pair whose context lies inside of it; without
    one it stands for itself. The key is a hash of the words of the context, so equal windows have equal keys.
    """
    n = len(words) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none
    p = np.arange(n, dtype=np.int64)
    valid = doc[:n] == doc[window - 1 :]
    roll = Rolling(words, _BASES[0])
    key, place = np.zeros(n, np.uint64), np.full(n, -1, np.int64)
    symbols = Symbols(words, doc)
    found = []
    for turn in range(rounds):
        if turn:
            symbols.name_runs(turn)
        fresh = symbols.name_pairs(turn)
        usable = fresh & (symbols.lo >= 0) & (symbols.hi <= len(words)) & (symbols.hi - symbols.lo <= window)
        found.append((symbols.name[usable], symbols.lo[usable], symbols.hi[usable]))
    for name, lo, hi in reversed(found):
        todo = np.flatnonzero(valid & (place < 0))
        if not len(todo) or not len(name):
            continue
        first = np.searchsorted(lo, todo, "left")
        last = np.searchsorted(hi, todo + window, "right")
        best, chosen = np.full(len(todo), np.uint64(2**64 - 1)), np.full(len(todo), -1, np.int64)
        for step in range(int((last - first).max(initial=0))):
            i = first + step
            i_ok = np.minimum(i, len(name) - 1)
            better = (i < last) & ((name[i_ok] < best) | (chosen < 0))
            best, chosen = np.where(better, name[i_ok], best), np.where(better, i_ok, chosen)
        has = chosen >= 0
        at, c = todo[has], chosen[has]
        place[at] = lo[c]
        key[at] = roll.of(lo[c], hi[c])
    alone = np.flatnonzero(valid & (place < 0))
    place[alone] = alone
    key[alone] = roll.of(alone, alone + window)
    start = np.ones(n, bool)
    start[1:] = (place[1:] != place[:-1]) | (key[1:] != key[:-1]) | ~valid[:-1] | (doc[1:n] != doc[: n - 1])
    start &= valid
    ends = np.ones(n, bool)
    ends[:-1] = start[1:] | ~valid[1:]
    ends &= valid
    p0 = p[start]
    return key[p0].view(np.int64), place[p0], p0, p[ends] - p0 + 1


def _joined(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of several documents, the document of each word, and where each document begins."""
    sizes = np.array([len(w) for w in found], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return np.concatenate(found), np.repeat(np.arange(len(found)), sizes), starts


def _anchor_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            words, doc, starts = _joined([word_hashes(t) for t in texts(batch.column("text"))])
            key, _, first, count = anchors(words, doc, window)
            of = doc[first]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key),
                    batch.column("doc_id").take(pa.array(of)),
                    batch.column("_th").take(pa.array(of)),
                    pa.array((first - starts[of]).astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                ],
                ["key", "doc_id", "_th", "first", "windows"],
            )

    return run


def _spread(spans: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each span."""
    total = int(counts.sum())
    offsets = np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(spans, counts) + np.arange(total) - offsets


def _span_arrays(column: pa.Array, row: int) -> np.ndarray:
    value = column[row]
    return value.values.to_numpy(zero_copy_only=False).astype(np.int64) if value.is_valid else np.zeros(0, np.int64)


def _window_rows(window: int):
    """For every window of the listed spans: 96 bits of hash, and its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            ranks = batch.column("rank").to_numpy()
            for row, text in enumerate(texts(batch.column("text"))):
                words = word_hashes(text)
                at = _spread(_span_arrays(batch.column("firsts"), row), _span_arrays(batch.column("counts"), row))
                w1 = Rolling(words, _BASES[0]).of(at, at + window).view(np.int64)
                w2 = Rolling(words, _BASES[1]).of(at, at + window).view(np.int64) >> 32
                places = (ranks[row] << WORD_BITS) + at
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1), pa.array(w2.astype(np.int32)), pa.array(places)], ["w1", "w2", "place"]
                )

    return run


def _kept_rows(window: int, whole: bool):
    """What is left of each text: counts, and the digest of the kept words or the kept text itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            counts, removed, left = [], [], []
            for row, text in enumerate(texts(batch.column("text"))):
                found = (text or b"").split()
                at = _spread(_span_arrays(batch.column("firsts"), row), _span_arrays(batch.column("counts"), row))
                later = np.setdiff1d(at, _span_arrays(batch.column("origins"), row), assume_unique=False)
                edge = np.zeros(len(found) + 1, np.int64)
                np.add.at(edge, later, 1)
                np.add.at(edge, later + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = b" ".join(found[i] for i in np.flatnonzero(~gone)) if gone.any() else b" ".join(found)
                counts.append(len(found))
                removed.append(int(gone.sum()))
                left.append(kept.decode() if whole else hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(left, pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def drop_repeats(docs: DataFrame, window: int = 20, whole: bool = True) -> DataFrame:
    """Each document without the words that repeat earlier ones: ``doc_id``, ``n_words``, ``n_removed``, ``kept``.

    ``docs`` has ``doc_id`` and ``text``. A word goes if it lies in a window of ``window`` consecutive words whose
    sequence also starts earlier: in a document of smaller id, or earlier in its own. Windows are judged on the input.
    ``kept`` is the kept words joined by a space or, with ``whole`` off, the SHA-256 of that in lower-case hex.

    Symbols that occur once are dropped by counting. The windows of the others are compared as wholes, by 96 bits of
    hash, and the first place of each sequence is kept; no group of equal windows is gathered anywhere.

    Null and empty texts have no words. Documents with one id come in the order of a hash of their texts, null ids
    first; rows with equal id and text are one document that comes back as often as it came. Other columns are ignored,
    whatever their names; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text").withColumn("_th", F.xxhash64("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    with steps(docs.sparkSession) as kept:
        known = _known(docs, window, id_type)
        kept.append(known)
    known = known.select(F.col("doc_id").alias("_id"), F.col("_th").alias("_t"), "firsts", "counts", "origins")
    on = same(docs["doc_id"], known["_id"]) & (docs["_th"] == known["_t"])
    return docs.join(shuffled(known), on, "left").select("doc_id", "text", "firsts", "counts", "origins").mapInArrow(
        _kept_rows(window, whole), f"doc_id {id_type}, n_words bigint, n_removed bigint, kept string"
    )


def _candidates(docs: DataFrame, window: int, id_type: str) -> DataFrame:
    """(``doc_id``, ``_th``, ``firsts``, ``counts``): for each document the runs of windows whose symbols are shared."""
    symbols = f"key bigint, doc_id {id_type}, _th bigint, first int, windows int"
    found = stored(docs.mapInArrow(_anchor_rows(window), symbols), "symbols")
    shared = stored(found.groupBy("key").count().where("count > 1").select("key"), "shared_symbols")
    spans = (
        found.join(shuffled(shared), "key")
        .groupBy("doc_id", "_th")
        .agg(F.sort_array(F.collect_set(F.struct("first", "windows"))).alias("spans"))
        .select("doc_id", "_th", F.col("spans.first").alias("firsts"), F.col("spans.windows").alias("counts"))
    )
    return stored(spans, "spans")


def _known(docs: DataFrame, window: int, id_type: str) -> DataFrame:
    """Candidates with ``origins``, those of their windows that are the first of their sequence."""
    with steps(docs.sparkSession) as kept:
        spans = _candidates(docs, window, id_type)
        kept.append(spans)
    numbers = stored(ranked(spans.select("doc_id", "_th"), ["doc_id", "_th"]), "numbers")
    spans = stored(_on_document(spans, numbers).select("doc_id", "_th", "rank", "firsts", "counts"), "candidates")
    unique = spans.select(F.col("doc_id").alias("_id"), F.col("_th").alias("_t"), "rank", "firsts", "counts")
    on = same(docs["doc_id"], unique["_id"]) & (docs["_th"] == unique["_t"])
    windows = docs.join(shuffled(unique), on).select("text", "rank", "firsts", "counts").mapInArrow(
        _window_rows(window), "w1 bigint, w2 int, place bigint"
    )
    origins = windows.groupBy("w1", "w2").agg(F.min("place").alias("place"))
    origins = (
        origins.select(
            F.shiftright("place", WORD_BITS).alias("rank"),
            F.col("place").bitwiseAND((1 << WORD_BITS) - 1).cast("int").alias("at"),
        )
        .groupBy("rank")
        .agg(F.collect_list("at").alias("origins"))
    )
    origins = stored(origins, "origins")
    return stored(spans.join(shuffled(origins), "rank", "left").drop("rank"), "known")


def _on_document(spans: DataFrame, numbers: DataFrame) -> DataFrame:
    numbers = numbers.select(F.col("doc_id").alias("_id"), F.col("_th").alias("_t"), "rank")
    return spans.join(shuffled(numbers), same(spans["doc_id"], numbers["_id"]) & (spans["_th"] == numbers["_t"]))
