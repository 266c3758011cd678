"""Toxicity by a weighted lexicon: Aho-Corasick over folded text, hits relative to the length, benign phrases excepted."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled, stored
from .logistic import fit, sigmoid
from .wordhash import slices

# Letters of other scripts that look like Latin ones, and signs that stand for letters inside of words.
LOOKALIKES = "аa еe оo рp сc уy хx іi јj ѕs кk мm тt вb нh ԁd ɡg ο o αa εe ιi κk νv ρp τt υu χx".replace("ο o", "οo")
SIGNS = "0o 1i 3e 4a 5s 7t 8b @a $s !i"
# Ordinary phrases that hold a word which is rude by itself.
EXCEPTIONS = (
    "trash can",
    "trash bin",
    "trash bag",
    "clown fish",
    "clown nose",
    "pathetic fallacy",
    "pond scum",
    "soap scum",
    "stupid simple",
    "idiot proof",
    "sore loser",
)

#: Labelled documents that a lexicon is learnt from at most, those with the smallest hashes of their ids.
SAMPLE = 12_000
#: Entries of a learnt lexicon at most.
ENTRIES = 400
#: What a hit means: so many occurrences at least, and so many to a word of the text.
LEVELS = ((1, 0.0), (1, 0.01), (2, 0.004), (2, 0.01), (3, 0.02))
BEGINNINGS = range(4, 9)
THRESHOLD = 0.7

_LOOK = str.maketrans({pair[0]: pair[1] for pair in LOOKALIKES.split()})
_SIGN = str.maketrans({pair[0]: pair[1] for pair in SIGNS.split()})
_FOREIGN = re.compile("[ɐ-ʯͰ-ԯ！-～]")
_WIDE = {code: code - 0xFEE0 for code in range(0xFF01, 0xFF5F)}
# A run of letters, digits and signs that has more than letters: what precedes its letters, the run between, what follows.
_MIXED = re.compile(r"(?<![^\W\d_])[^\W\d_]*+[0-9@$!](?:[^\W_]|[@$!])*+")
_PARTS = re.compile(r"([0-9@$!]*)((?:[^\W\d_].*)?[^\W\d_])(.*)", re.DOTALL)
#: What stands for letters in each reading of a text: before a word 2 all digits and signs, 1 those from the first digit
#: on, 0 none; after it 1 all, 0 none.
READINGS = ((2, 1), (1, 1), (0, 1), (2, 0), (1, 0), (0, 0))
_GAPS = re.compile(r"[\W\d_]+")


def fold(text: str | None, before: int = 2, after: int = 1) -> str:
    """Words in lower case between single spaces, with look-alike letters and digits in words as plain letters.

    Digits and signs before and after the letters of a word are letters of it, as ``READINGS`` has them, or no part of
    it: so are "!" at its end, and all on one side if one of them stands for no letter, as in "covid19". All readings of
    a text have the same number of words.
    """
    out = (text or "").lower()
    if _FOREIGN.search(out):
        out = out.translate(_WIDE).translate(_LOOK).lower()

    def plain(found: re.Match[str]) -> str:
        parts = _PARTS.fullmatch(found[0])
        if not parts:
            return found[0]
        lead = parts[1].lstrip("@$!") if before == 1 else parts[1]
        lead, word, trail = (part.translate(_SIGN) for part in (lead, parts[2], parts[3].rstrip("!")))
        return (lead if before and lead.isalpha() else " ") + word + (trail if after and trail.isalpha() else " ")

    if any(c.isdigit() or c in "@$!" for c in out):
        out = _MIXED.sub(plain, out)
    return f" {_GAPS.sub(' ', out).strip()} "


def readings(text: str | None) -> list[str]:
    """The different outcomes of ``fold``, first the one with all signs as letters."""
    first, least = fold(text), fold(text, 0, 0)
    return [first] if first == least else list(dict.fromkeys([first, *[fold(text, *how) for how in READINGS], least]))


@dataclass(frozen=True)
class Lexicon:
    """Patterns (" word " or " beginning") with the level at which each counts, their weights, and benign phrases."""

    entries: tuple[tuple[str, int], ...]
    weights: tuple[float, ...]
    bias: float
    exceptions: tuple[str, ...] = EXCEPTIONS


class Matcher:
    """Counts of a lexicon's patterns in folded texts; an occurrence inside of a benign phrase doesn't count."""

    def __init__(self, entries: tuple[tuple[str, int], ...], exceptions: tuple[str, ...] = ()):
        self.patterns = sorted({pattern for pattern, _ in entries})
        number = {pattern: i for i, pattern in enumerate(self.patterns)}
        self.column = np.array([number[pattern] for pattern, _ in entries], np.int64)
        self.least = np.array([LEVELS[level][0] for _, level in entries], np.float64)
        self.rate = np.array([LEVELS[level][1] for _, level in entries], np.float64)
        self.automaton = ahocorasick.Automaton()
        for pattern, i in number.items():
            self.automaton.add_word(pattern, (i, len(pattern)))
        phrases = {f" {' '.join(fold(phrase).split())} " for phrase in exceptions} - set(self.patterns)
        for phrase in phrases:
            self.automaton.add_word(phrase, (-1, len(phrase)))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str, *others: str) -> np.ndarray:
        """Which entries a folded text reaches; a pattern counts once for a word, in whichever readings it is there."""
        counts = np.zeros(len(self.patterns))
        if len(self.automaton) and len(self.patterns):
            rude, spared = set(), set()
            for reading in (folded, *others):
                found = list(self.automaton.iter(reading))
                benign = [(end - length + 1, end) for end, (i, length) in found if i < 0]
                at = word = 0
                for start, end, i in sorted((end - length + 1, end, i) for end, (i, length) in found if i >= 0):
                    word, at = word + reading.count(" ", at, start), start
                    inside = any(a <= start and end <= b for a, b in benign)
                    (spared if inside else rude).add((i, word))
            for i, _ in rude - spared:
                counts[i] += 1
        each = counts[self.column] if len(self.column) else counts
        words = max(1, folded.count(" ") - 1)
        return (each >= self.least) & (each >= self.rate * words)


def _patterns(word: str) -> list[str]:
    return [f" {word} ", *[f" {word[:size]}" for size in BEGINNINGS if size < len(word)]]


def candidates(folded: str, *others: str) -> set[tuple[str, int]]:
    """Entries that a text could support: its words, and the beginnings of its words, at the levels that they reach.
    Of a word with several readings each pattern counts once."""
    found = folded.split()
    counts: Counter[str] = Counter()
    for word, n in Counter(found).items():
        for pattern in _patterns(word):
            counts[pattern] += n
    if others:
        for forms in zip(found, *[other.split() for other in others], strict=True):
            if len(set(forms)) > 1:
                own = set(_patterns(forms[0]))
                counts.update({p for form in set(forms) for p in _patterns(form)} - own)
    out = set()
    for pattern, n in counts.items():
        for level, (least, rate) in enumerate(LEVELS):
            if n >= least and n >= rate * len(found) and (rate or pattern.endswith(" ")):
                out.add((pattern, level))
    return out


def _candidate_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 16):
        patterns, levels, toxic = [], [], []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            for pattern, level in candidates(*readings(text)):
                patterns.append(pattern)
                levels.append(level)
                toxic.append(label)
        columns = [pa.array(patterns, pa.string()), pa.array(levels, pa.int32()), pa.array(toxic, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["pattern", "level", "toxic"])


def _hit_rows(entries: tuple[tuple[str, int], ...], exceptions: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(entries, exceptions)
        for batch in slices(batches, 256):
            packed = [np.packbits(matcher.hits(*readings(t))).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(packed, pa.binary())], ["toxic", "hits"]
            )

    return run


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """A lexicon from ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``toxic`` 0 or 1): the words and
    beginnings of words that set toxic texts apart, with the weights of a logistic regression on which of them a text
    reaches.

    At most ``sample`` labels are used, those with the smallest hashes of their ids. Null labels, and labels without a
    document, are left out; without any or with one class the lexicon is empty and the score is the base rate.
    """
    known = labels.where(F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    rows = docs.select("doc_id", "text").join(F.broadcast(sampled(known, sample)), "doc_id")
    # One text for each id: an id that many rows repeat counts once.
    rows = stored(rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "labelled")
    spread = rows.repartition(48, F.xxhash64("doc_id"))
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    counted = (
        spread.mapInArrow(_candidate_rows, "pattern string, level int, toxic int")
        .groupBy("pattern", "level")
        .agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
    )
    in_toxic = (F.col("t") + 0.5) / (toxic + 1.0)
    in_clean = (F.col("n") - F.col("t") + 0.5) / (clean + 1.0)
    gain = F.col("t") * F.log(in_toxic / in_clean)
    best = (
        counted.where((F.col("t") >= max(3, 0.01 * toxic)) & (in_toxic >= 4 * in_clean))
        .orderBy(gain.desc(), "pattern", "level")
        .limit(ENTRIES)
        .collect()
    )
    entries = tuple((r["pattern"], r["level"]) for r in best)
    hits = spread.mapInArrow(_hit_rows(entries, exceptions), "toxic int, hits binary").toPandas()
    y = hits["toxic"].to_numpy(np.float64)
    x = np.zeros((len(y), len(entries)))
    for i, packed in enumerate(hits["hits"]):
        x[i] = np.unpackbits(np.frombuffer(packed, np.uint8))[: len(entries)]
    weights, bias = fit(x, y, ridge=1.0, positive=True)
    return Lexicon(entries, tuple(weights.tolist()), bias, exceptions)


def score_texts(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """(``doc_id``, ``score`` from 0 to 1, ``predicted``: 1 from ``threshold`` on) for each row of ``docs``.

    The whole text is matched. Null and empty texts reach no entry and score as such; equal rows score alike. Columns
    besides ``doc_id`` and ``text`` are ignored, whatever their names; an empty table gives no rows.
    """
    weights, bias = np.array(lexicon.weights), lexicon.bias
    entries, exceptions = lexicon.entries, lexicon.exceptions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(entries, exceptions)
        for batch in slices(batches, 256):
            texts = batch.column("text").to_pylist()
            score = np.array([float(sigmoid(np.array(bias + weights[matcher.hits(*readings(t))].sum()))) for t in texts])
            columns = [batch.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double, predicted int")
