"""Packing of documents into token sequences along a Hilbert curve through their hashed vectors."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from itertools import batched, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .wordhash import mix, slices, texts

SEQUENCE = 2048
END = 1
#: Dimensions and bits of the space that the curve fills.
DIMENSIONS, BITS = 3, 10
#: Words of letters that a worker remembers, some 20 bytes each.
REMEMBERED = 400_000
#: Tokens to a partition: small inputs take fewer partitions, large ones larger partitions.
FEW_TOKENS, MANY_TOKENS = 4_000_000, 32_000_000

_PIECES = "start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


#: How a tokenizer prepares texts whose words may be encoded one by one.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


#: Latin letters that composing leaves alone and that stay letters in lower case.
LATIN = [chr(c) for c in range(0x250) if chr(c).isalpha() and chr(c).lower().isalpha()]


class WordIds:
    """Token ids of texts.

    A tokenizer that composes letters, ignores case and drops white space treats words by themselves, so each different
    word of a batch is encoded once. Words end at ASCII white space only; what else the tokenizer takes for a space
    stays inside of a word for it. Words of Latin letters need no more than the tokenizer's model, and the signs that
    end a word are encoded by themselves. Only words of letters are remembered, so what a text gives depends on it alone.
    Of any other tokenizer whole texts are encoded.
    """

    SIGNS = "%#$&*!.,|"
    #: Words whose ids are gathered at once.
    CHUNK = 1 << 18

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        parts = json.loads(self.tokenizer.to_str())
        suffix = parts["model"].get("end_of_word_suffix")
        self.by_word = bool(suffix) and self._splits_words(parts)
        if self.by_word:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
            # The model alone, which sees each byte as a letter of its own.
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = CharDelimiterSplit(" ")
            in_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            self.letters = np.full(256, ord(" "), np.uint32)
            for letter in LATIN:
                self.letters[list(letter.encode())] = [ord(x) for x in in_bytes(letter)[0][0]]
            self.known = pa.array([], pa.string())
            self.known_ids, self.known_sizes = np.zeros(0, self.type), np.zeros(0, np.int64)

    @staticmethod
    def _splits_words(parts: dict) -> bool:
        first, *rest = (parts["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        in_bytes = [(x["type"], x["add_prefix_space"], x["use_regex"]) for x in rest if x["type"] == "ByteLevel"]
        return (
            parts["normalizer"] == NORMALIZER
            and parts["post_processor"] is None
            and (first.get("type"), first.get("behavior"), first.get("invert")) == ("Split", "Removed", True)
            and first["pattern"] == {"Regex": PIECES}
            and len(rest) == 1
            and in_bytes == [("ByteLevel", False, False)]
            and all("<|" in token["content"] and not token["normalized"] for token in parts["added_tokens"])
            and not any(set(token["content"]) & set(" \t\n\v\f\r") for token in parts["added_tokens"])
        )

    def _whole(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one behind the other, and how many each has."""
        ids = [
            e.ids
            for start in range(0, len(found), 2000)
            for e in self.tokenizer.encode_batch_fast(found[start : start + 2000], add_special_tokens=False)
        ]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), self.type, sizes.sum()), sizes

    def _plain(self, stems: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces, how many each has, and the pieces that are these different words of Latin letters."""
        at = pc.index_in(stems, value_set=self.known)
        new = stems.filter(pc.is_null(at))
        ids, sizes = self._of_letters(new)
        place = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        place[place < 0] = len(self.known) + np.arange(len(new))
        ids, sizes = np.concatenate([self.known_ids, ids]), np.concatenate([self.known_sizes, sizes])
        if len(sizes) <= REMEMBERED:
            self.known, self.known_ids, self.known_sizes = pa.concat_arrays([self.known, new]), ids, sizes
        return ids, sizes, place

    def _of_letters(self, stems: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of Latin letters and how many each has: one text of all, cut behind each token that ends a
        word."""
        if not len(stems):
            return np.zeros(0, self.type), np.zeros(0, np.int64)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(stems)], pa.int32()), stems), " ")[0].as_py()
        letters = np.frombuffer(joined.lower().encode(), np.uint8)
        prepared = self.letters[letters].tobytes().decode("utf-32-le")
        ids = np.array(self.model.encode_batch_fast([prepared])[0].ids, self.type)
        return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words and how many each has: those of a stem, then those of the signs behind it."""
        stems = pc.utf8_rtrim(words, characters=self.SIGNS)
        plain = pc.match_substring_regex(stems, f"^[{''.join(LATIN)}]+$")
        bare = stems.filter(plain).dictionary_encode()
        signs = _behind(words.filter(plain), stems.filter(plain)).dictionary_encode()
        others = words.filter(pc.invert(plain))
        stem_ids, stem_sizes, place = self._plain(bare.dictionary)
        sign_ids, sign_sizes = self._whole(signs.dictionary.to_pylist())
        other_ids, other_sizes = self._whole(others.to_pylist())
        ids = np.concatenate([stem_ids, sign_ids, other_ids])
        # Two pieces to each word; behind a word that is encoded whole comes an empty one, the last of all.
        sizes = np.concatenate([stem_sizes, sign_sizes, other_sizes, [0]])
        mask = plain.to_numpy(zero_copy_only=False)
        pair = np.full((len(words), 2), len(sizes) - 1)
        pair[mask, 0] = place[bare.indices.to_numpy()]
        pair[mask, 1] = len(stem_sizes) + signs.indices.to_numpy()
        pair[~mask, 0] = len(stem_sizes) + len(sign_sizes) + np.arange(len(others))
        return self._gathered(ids, sizes, pair.ravel()), sizes[pair].sum(axis=1)

    def _gathered(self, ids: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
        """``ids`` of pieces of ``sizes``, in another order of the pieces."""
        begin = np.cumsum(sizes) - sizes
        out = []
        for start in range(0, len(order), self.CHUNK):
            chosen = order[start : start + self.CHUNK]
            each = sizes[chosen]
            out.append(ids[np.arange(each.sum()) + np.repeat(begin[chosen] - (np.cumsum(each) - each), each)])
        return np.concatenate(out) if out else ids[:0]

    @staticmethod
    def _words(column: pa.Array) -> pa.ListArray:
        text = pc.fill_null(column.cast(pa.binary()).view(pa.string()), "")
        # Case is ignored, but for the names of special tokens, and for letters before a combining mark (U+0300 on): a
        # capital may compose with it to another letter than a small one does.
        raw = text.view(pa.binary())
        as_is = reduce(pc.or_, [pc.match_substring(raw, part) for part in (b"<|", b"\xcc", b"\xcd")])
        return pc.ascii_split_whitespace(pc.if_else(as_is, text, pc.ascii_lower(text)))

    def flat(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, one behind the other and each with the closing one, and where each begins and
        the last ends."""
        if self.by_word:
            split = self._words(column)
            coded = split.flatten().dictionary_encode()
            ids, sizes = self._distinct(coded.dictionary)
            counts, words = np.diff(split.offsets.to_numpy()), coded.indices.to_numpy()
        else:
            ids, sizes = self._whole([(text or b"").decode() for text in texts(column)])
            counts, words = np.ones(len(column), np.int64), np.arange(len(column))
        # The closing id is one more word at the end of each text.
        words = np.insert(words.astype(np.int64), np.cumsum(counts), len(sizes))
        ids, sizes = np.append(ids, np.array(END, self.type)), np.append(sizes, 1)
        ends = np.cumsum(sizes[words])[np.cumsum(counts + 1) - 1]
        return self._gathered(ids, sizes, words), np.concatenate([[0], ends])

    def encode(self, found: list[bytes | None]) -> list[np.ndarray]:
        ids, starts = self.flat(pa.array(found, pa.binary()))
        return [ids[a:b] for a, b in pairwise(starts.tolist())]


def _behind(words: pa.Array, stems: pa.Array) -> pa.Array:
    """What each word has behind its stem: its last bytes."""
    sizes = pc.binary_length(words).to_numpy().astype(np.int64)
    rest = sizes - pc.binary_length(stems).to_numpy()
    every = np.frombuffer("".join(words.to_pylist()).encode(), np.uint8)
    ends = np.cumsum(rest)
    data = every[np.arange(rest.sum()) + np.repeat(np.cumsum(sizes) - ends, rest)]
    offsets = np.append(0, ends).astype(np.int32)
    return pa.StringArray.from_buffers(len(words), pa.py_buffer(offsets), pa.py_buffer(data))


_TOKENIZERS: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


def projected(ids: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean over each document's tokens of their hashed directions: sums of whole numbers, whatever comes before."""
    sums = np.add.reduceat(table[ids], starts[:-1], axis=0, dtype=np.int64)
    return sums / np.diff(starts)[:, None]


def directions(vocabulary: int) -> np.ndarray:
    """For each token a hashed direction of -1 and 1."""
    bits = mix(np.arange(vocabulary, dtype=np.uint64) + np.uint64(1))[:, None] >> np.arange(DIMENSIONS, dtype=np.uint64)
    return (bits & np.uint64(1)).astype(np.int8) * 2 - 1


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve of integer points (rows), each coordinate of ``bits`` bits."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:  # undo the turns and reflections of each level
        low = bit - 1
        for i in range(n):
            set_here = (x[i] & bit) != 0
            swap = np.where(set_here, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_here, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn = np.where(x[n - 1] & bit, turn ^ (bit - 1), turn)
        bit >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def _bounded(batches: Iterator[pa.RecordBatch], rows: int = 512, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut to so many rows and, where it takes more than one row, bytes of text."""
    for batch in slices(batches, rows):
        while batch.num_rows > 1 and batch.column("text").nbytes > size:
            yield batch.slice(0, batch.num_rows // 2)
            batch = batch.slice(batch.num_rows // 2)
        if batch.num_rows:
            yield batch


def _tokenised(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _word_ids(path)
        table = directions(encoder.tokenizer.get_vocab_size())
        for batch in _bounded(batches):
            ids, starts = encoder.flat(batch.column("text"))
            means = projected(ids, starts, table)
            cells = np.clip((means + 0.5) * (1 << BITS), 0, (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(starts)),
                    pa.array(hilbert(cells)),
                    pa.array([ids[a:b].tobytes() for a, b in pairwise(starts.tolist())], pa.binary()),
                ],
                ["doc_id", "doc_tokens", "curve", "tokens"],
            )

    return run


def _cut(pieces: list[tuple], lengths: list[int], number: int) -> Iterator[tuple]:
    """Pieces of one open sequence, dealt to sequences of the given lengths."""
    room, offset = lengths[0], 0
    turn = 0
    for doc, start, ids, total in pieces:
        while len(ids):
            take = min(room, len(ids))
            yield doc, start, ids[:take], total, number + turn, offset
            ids, start, offset, room = ids[take:], start + take, offset + take, room - take
            if not room and turn + 1 < len(lengths):
                turn += 1
                room, offset = lengths[turn], 0


def pack(documents: Iterator[tuple], length: int) -> Iterator[tuple]:
    """(doc, start, ids, tokens of the document, sequence, offset) of consecutive documents (doc, ids).

    Sequences fill up one after the other. What is left for the last one is cut at powers of two, which need no
    padding.
    """
    number, held, filled = 0, [], 0
    for doc, ids in documents:
        start, total = 0, len(ids)
        while start < total:
            take = min(length - filled, total - start)
            held.append((doc, start, ids[start : start + take], total))
            start, filled = start + take, filled + take
            if filled == length:
                yield from _cut(held, [length], number)
                number, held, filled = number + 1, [], 0
    if filled:
        yield from _cut(held, [1 << b for b in range(length.bit_length(), -1, -1) if filled >> b & 1], number)


def _packed(length: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = next(batches, None)
        if batch is None:
            return
        first, id_type = batch.column("_part")[0].as_py() << 40, batch.column("doc_id").type

        def documents() -> Iterator[tuple]:
            for part in slices(chain([batch], batches), 256):
                columns = (part.column(name).to_pylist() for name in ("doc_id", "tokens"))
                for doc, tokens in zip(*columns, strict=True):
                    yield doc, np.frombuffer(tokens, kind)

        for held in batched(pack(documents(), length), 512):
            yield _pieces(held, first, id_type)

    return run


def _pieces(held: tuple[tuple, ...], first: int, id_type: pa.DataType) -> pa.RecordBatch:
    doc, start, ids, total, number, offset = zip(*held, strict=True)
    whole = [pa.array(x, pa.int64()) for x in (start, [len(i) for i in ids], total, [first + n for n in number], offset)]
    raw = pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(doc, id_type), *whole, raw], names)


def pack_documents(docs: DataFrame, vocabulary: str, length: int = SEQUENCE) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` tokens: ``doc_id``, ``start`` (tokens of the document
    before the piece), ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` (in the sequence), ``ids`` (unsigned
    32-bit, little-endian).

    ``docs`` has ``doc_id`` and ``text``; ``vocabulary`` is the file of a tokenizer that splits at white space. The
    document's tokens are followed by ``END``. A document's hashed token vector, projected to three dimensions, gives
    its place on a Hilbert curve; documents are range-sorted along it and cut freely, so neighbours share sequences.
    Each partition fills its own sequences, and cuts its last tokens at powers of two, so that nothing is padded.

    Null and empty texts have the closing token only. Documents on one point of the curve go by id (null first) and
    tokens; equal rows are documents of their own. Other columns are ignored, whatever their names; an empty table gives
    no rows. ``sequence_id`` has the partition above its fortieth bit. Small tables are cut into no more partitions than
    ``spark.sql.shuffle.partitions``, so another setting may deal the pieces to other sequences.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(
        _tokenised(vocabulary), f"doc_id {id_type}, doc_tokens bigint, curve bigint, tokens binary"
    )
    rows = stored(rows, "tokens")
    total = rows.agg(F.sum("doc_tokens")).first()[0] or 0
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(-(-total // MANY_TOKENS), min(usual, -(-total // FEW_TOKENS)), 1)
    order = ["curve", "doc_id", F.crc32("tokens"), "tokens"]
    # Equal rows may go to several ranges.
    spread = F.xxhash64(F.monotonically_increasing_id())
    along = rows.repartitionByRange(parts, *order[:3], spread).sortWithinPartitions(*order)
    along = along.select("doc_id", "tokens", F.spark_partition_id().alias("_part"))
    kind = _word_ids(vocabulary).type.str
    return along.mapInArrow(_packed(length, kind), f"doc_id {id_type}, {_PIECES}")
