"""Runs of words that repeat with a fixed period, found by recursive frequency splitting.

A run holds at least three periods, so each of its words occurs three times or more in any segment around it. Words
that are rarer than that within their segment split it; the parts are judged by their own counts, until nothing more
splits. Only what survives is scanned at lags.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import without
from .wordhash import constants, mix, slices, texts

LEAST_WORDS, LEAST_PERIODS = 24, 3
SEED = 12
_OWN = ["n_words", "runs", "collapsed"]
_RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])
_KINDS = [LongType(), ArrayType(_RUN), StringType()]
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
Run = tuple[int, int, int]


class _Codes(dict):
    """A number for each distinct word."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def segments(codes: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches of ``codes`` that may hold runs. ``codes``: the words of texts of ``lengths``, one
    text after the other; no stretch crosses from one to another.

    Each round counts every word within its segment, drops the words with fewer than ``LEAST_PERIODS`` and the parts
    with fewer than ``LEAST_WORDS``. Segments that lose nothing are final."""
    kinds = int(codes.max()) + 1 if len(codes) else 1
    at = np.arange(len(codes))
    of = np.repeat(np.arange(len(lengths)), lengths)
    final: list[tuple[int, int]] = []
    first = True
    while len(at):
        if not first:
            _, place, counts = np.unique(of * kinds + codes[at], return_inverse=True, return_counts=True)
            enough = counts[place] >= LEAST_PERIODS
            whole = np.bincount(of[~enough], minlength=of[-1] + 1)[of] == 0
            edges = np.flatnonzero(whole & (np.diff(of, prepend=-1) != 0))
            ends = np.flatnonzero(whole & (np.diff(of, append=of[-1] + 1) != 0))
            final += zip(at[edges].tolist(), (at[ends] + 1).tolist(), strict=True)
            stay = enough & ~whole
            at, of = at[stay], of[stay]
        first = False
        if len(at):
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) != 1) | (np.diff(of) != 0)
            of = np.cumsum(new) - 1
            stay = np.bincount(of)[of] >= LEAST_WORDS
            at, of = at[stay], of[stay]
    return sorted(final)


def lag_scan(codes: np.ndarray) -> list[Run]:
    """(start, length, period) of all runs in one segment, by start, then period.

    A run's words equal those one period on, for two periods at least. So two blocks in a row, of a period's length and
    starting at a multiple of it, are equal: at each lag only the sums of such blocks are compared, n / lag of them, and
    the words themselves where two agree. Smaller lags come first, and what a run of a period covers is not looked at
    again at its multiples."""
    n = len(codes)
    power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, constants(1, SEED)[0]))])
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * power[:n])])
    found: dict[int, list[tuple[int, int]]] = {}
    ends: set[tuple[int, int]] = set()
    for q in range(1, n // LEAST_PERIODS + 1):
        blocks = np.diff(sums[::q])
        hits = np.flatnonzero(blocks[:-1] * power[q] == blocks[1:]) * q
        for p, runs in found.items():
            if len(hits) and q % p == 0:
                starts, stops = np.array(runs).T
                last = np.searchsorted(starts, hits, "right") - 1
                hits = hits[(last < 0) | (stops[last] < hits + 2 * q)]
        if not len(hits):
            continue
        alike = np.zeros(n - q + 2, bool)
        alike[1:-1] = codes[:-q] == codes[q:]
        turns = np.flatnonzero(alike[1:] != alike[:-1])
        for start, stop in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
            stop += q
            if stop - start >= max(LEAST_WORDS, LEAST_PERIODS * q) and (start, stop) not in ends:
                ends.add((start, stop))
                found.setdefault(q, []).append((start, stop))
    return sorted((start, stop - start, q) for q, runs in found.items() for start, stop in runs)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 256):
        named = _Codes()
        words = [t.split() if t else [] for t in texts(batch.column("text"))]
        lengths = np.array([len(w) for w in words])
        codes = np.fromiter((named[w] for text in words for w in text), np.int64, lengths.sum())
        starts = np.cumsum(lengths) - lengths
        runs: list[list[Run]] = [[] for _ in words]
        for start, end in segments(codes, lengths):
            row = int(np.searchsorted(starts, start, "right")) - 1
            shift = start - int(starts[row])
            runs[row] += [(s + shift, length, q) for s, length, q in lag_scan(codes[start:end])]
        left = []
        for text, these in zip(words, runs, strict=True):
            if these:
                kept = np.ones(len(text), bool)
                for start, length, q in these:
                    kept[start + q : start + length] = False
                text = [text[i] for i in np.flatnonzero(kept)]
            left.append(b" ".join(text))
        out = [
            pa.array(lengths, pa.int64()),
            pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in runs], _RUNS),
            pa.array(left, pa.binary()).view(pa.string()),
        ]
        others = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], *out], [*others, *_OWN])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` but ``text``, and ``n_words``, ``runs`` (array of ``start``, ``length``, ``period``, by
    start, then period) and ``collapsed``: the words outside of repetitions, joined by one space.

    Words are split at runs of space, tab to carriage return, and numbered from 0. A run is a stretch of words with
    smallest period q that no neighbouring word extends, of ``LEAST_PERIODS`` periods and ``LEAST_WORDS`` words at
    least. Runs may overlap. A word goes if a run holds it after that run's first q words.

    Null, empty and blank texts have no words and no runs. Rows are judged one by one, so equal rows give equal rows and
    ids don't matter. Input columns named like one of the result's are replaced. An empty table gives no rows. A text is
    held whole by one task.
    """
    rows = without(docs, _OWN)
    schema = without(rows, ["text"]).schema
    for name, kind in zip(_OWN, _KINDS, strict=True):
        schema = schema.add(name, kind)
    return rows.mapInArrow(_find, schema)


def strongest(runs: Column) -> Column:
    """The run with the most periods, exactly compared; of equal ones the first, so that of smallest start, then
    period. Null without runs."""

    def times(a: Column, b: Column) -> Column:
        return a.cast("decimal(19)") * b.cast("decimal(19)")

    def better(best: Column, run: Column) -> Column:
        more = times(run["length"], best["period"]) > times(best["length"], run["period"])
        return F.when(more, run).otherwise(best)

    return F.aggregate(runs, F.get(runs, F.lit(0)), better)
