"""Encoding texts with a public tokenizer inside Spark tasks.

The ``tokenizers`` library first splits a text into pieces and then merges each piece on its own, so a piece's ids
never depend on its neighbours. ``PieceEncoder`` finds where pieces begin with array operations on many texts at once
and asks the library for each new piece only once. A text with characters outside ``PLAIN``, where the two splits could
differ, or with an added token spelled out in it, which the library cuts out first, goes through the library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from .common import small_batches

# Characters whose class is the same for all versions of the library: up to U+024F, and common punctuation.
PLAIN = re.compile("[^\t\n\r -~¡-įı-ɏ‘’“”–—…€]")
LETTER, DIGIT, OTHER, SPACE, BETWEEN = range(5)
SEPARATOR = "\0"  # stands between texts; it is not in PLAIN


def _classes() -> np.ndarray:
    table = np.full(0x3000, OTHER, np.uint8)
    # The last two are the only letters that two of PLAIN have in lower case and that are not in it.
    for code in (*range(0x250), 0x2C65, 0x2C66):
        char = chr(code)
        if char.isalpha():
            table[code] = LETTER
        elif char.isnumeric():
            table[code] = DIGIT
    table[[9, 10, 13, 32]] = SPACE
    table[0] = BETWEEN
    return table


CLASSES = _classes()
BYTE_CLASSES = bytes(CLASSES[:0x100])


def piece_starts(raw: bytes, by_word: bool) -> np.ndarray:
    """Whether a piece begins at each byte of joined texts; ``raw`` is their UTF-8, characters of up to three bytes.

    Pieces are runs of letters, of digits (one each, ``by_word``) or of other signs; an apostrophe that begins such a
    run with s, t, re, ve, m, ll or d behind it is a piece with these letters. Otherwise than ``by_word``, a blank
    belongs to the run behind it, and white space but for its last character to a piece of its own.
    """
    codes = np.frombuffer(raw, np.uint8)
    # A byte at a time for ASCII; what is longer gets the class of its character in each of its bytes.
    kind = np.frombuffer(bytearray(raw.translate(BYTE_CLASSES)), np.uint8)
    lead = np.flatnonzero(codes >= 0xC0)
    if len(lead):
        first, second = codes[lead].astype(np.int32), codes[lead + 1] & 0x3F
        long = np.flatnonzero(first >= 0xE0)
        code = (first & 0x1F) << 6 | second
        code[long] = (first[long] & 0xF) << 12 | second[long].astype(np.int32) << 6 | codes[lead[long] + 2] & 0x3F
        kinds = CLASSES[code]
        kind[lead] = kind[lead + 1] = kinds
        kind[lead[long] + 2] = kinds[long]
    start = np.ones(len(kind), bool)
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= kind == BETWEEN
    apostrophe = np.flatnonzero(codes == 39)
    before = kind[apostrophe - 1]
    if by_word:
        start |= kind == DIGIT
        if len(lead):
            start &= codes & 0xC0 != 0x80
        free = before != OTHER
    else:
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] < SPACE))
        start[last] = True
        start[last[codes[last] == 32] + 1] = False
        free = (before != OTHER) & (codes[apostrophe - 1] != 32)
    for at in apostrophe[free | (apostrophe == 0)].tolist():
        size = 2 if raw[at + 1 : at + 2] in (b"s", b"t", b"m", b"d") else 3 if raw[at + 1 : at + 3] in (b"re", b"ve", b"ll") else 0
        if size:
            start[at + 1 : at + size] = False
            if at + size < len(codes) and kind[at + size] == LETTER:
                start[at + size] = True
    return start


class PieceEncoder:
    """Texts to ids; ``spec`` is the JSON text of a tokenizer file.

    Pieces are remembered in two generations of ``remember`` each: when the younger is full, the older one is let go,
    and a piece that is met again moves to the younger. So frequent pieces stay and memory is bounded.
    """

    def __init__(self, spec: str, remember: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.dtype = id_type(self.tokenizer.get_vocab_size())
        self.remember, self.known, self.older = remember, {}, {}
        parts = json.loads(spec)
        split = parts["pre_tokenizer"] or {}
        kinds = [p["type"] for p in split.get("pretokenizers", [split])]
        normal = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        self.by_word = kinds == ["Split", "ByteLevel"] and normal == ["NFC", "Replace", "Lowercase"]
        by_byte = kinds == ["ByteLevel"] and split["use_regex"] and not split["add_prefix_space"] and not parts["normalizer"]
        added = parts["added_tokens"]
        self.split = (self.by_word or by_byte) and not (parts["normalizer"] and any(t["normalized"] for t in added))
        # In any case, as pieces are of texts in lower case.
        self.added = re.compile("|".join(re.escape(t["content"]) for t in added) or "(?!)", re.IGNORECASE)
        # Signs that all of these have; to look for a sign is faster.
        self.signs = "".join(c for c in map(chr, range(33, 127)) if added and not c.isalpha() and all(c in t["content"] for t in added))
        # The ids that end a word, or begin with a blank (written as this letter in byte-level vocabularies).
        self.marked = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, n in self.tokenizer.get_vocab().items():
            self.marked[n] = token.endswith("</w>") if self.by_word else token.startswith("\u0120")

    def spelled(self, text: str) -> bool:
        """Whether an added token is spelled out in a text."""
        return all(c in text for c in self.signs) and bool(self.added.search(text))

    def odd(self, text: str) -> bool:
        """Whether a text has to go through the library whole."""
        return not self.split or bool(PLAIN.search(text)) or self.spelled(text)

    def whole(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian integers of ``dtype``, by the library alone."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _words(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces that are words (with a blank before each, unless ``by_word``): in one text, the library
        splits them apart again, and the first or last id of each is marked as such in the vocabulary."""
        text = ("" if not self.by_word else " ").join(pieces)
        if self.spelled(text):
            return self.whole(pieces)
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found[0].ids, self.dtype)
        marks = np.flatnonzero(self.marked[ids])
        if len(marks) != len(pieces):
            return self.whole(pieces)
        cuts = np.append(0, marks + 1) if self.by_word else np.append(marks, len(ids))
        raw, cuts = ids.tobytes(), (cuts * ids.itemsize).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces that are not ``known``, which they are from now on."""
        found = list(map(self.older.get, pieces))
        words, others = [], []
        for piece, ids in zip(pieces, found, strict=True):
            if ids is None:
                is_word = piece.isalpha() if self.by_word else piece[0] == " " and piece[1:].isalpha()
                (words if is_word else others).append(piece)
        new = dict(zip(others, self.whole(others), strict=True))
        for at in range(0, len(words), 1000):
            part = words[at : at + 1000]
            new.update(zip(part, self._words(part), strict=True))
        found = [new[p] if x is None else x for p, x in zip(pieces, found, strict=True)]
        if len(self.known) + len(pieces) > self.remember:
            self.known, self.older = {}, self.known
        self.known.update(zip(pieces, found, strict=True))
        return found

    def joined(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that are not ``odd`` one after the other, ``end_id`` behind each, and where each text ends."""
        text = "".join(t + SEPARATOR for t in texts)
        if self.by_word:
            text = text.lower()
        raw = text.encode()
        starts = np.flatnonzero(piece_starts(raw, self.by_word))
        offsets = np.full(len(starts) + 1, len(raw), np.int32)
        offsets[:-1] = starts
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw)).dictionary_encode()
        names, which = pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy()
        ids = list(map(self.known.get, names))
        end = names.index(SEPARATOR) if texts else -1
        if texts:
            ids[end] = np.array([end_id], self.dtype).tobytes()
        missing = [i for i, x in enumerate(ids) if x is None]
        for i, found in zip(missing, self._learn([names[i] for i in missing]), strict=True):
            ids[i] = found
        flat = np.frombuffer(b"".join(ids), self.dtype)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // flat.itemsize
        first = np.cumsum(sizes) - sizes
        size = sizes[which]
        ends = np.cumsum(size)
        at = np.repeat(first[which] - ends + size, size)
        at += np.arange(len(at))
        return flat[at], ends[which == end]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian integers of ``dtype``."""
        odd = [i for i, t in enumerate(texts) if self.odd(t)]
        plain = sorted(set(range(len(texts))).difference(odd))
        out = dict(zip(odd, self.whole([texts[i] for i in odd]), strict=True))
        ids, ends = self.joined([texts[i] for i in plain], 0)
        for i, a, b in zip(plain, [0, *ends.tolist()], ends.tolist(), strict=False):
            out[i] = ids[a : b - 1].tobytes()
        return [out[i] for i in range(len(texts))]


_ENCODERS: dict[tuple[int, int], PieceEncoder] = {}


def encoder(spec: str, remember: int = 400_000) -> PieceEncoder:
    """This worker's encoder of a tokenizer; it serves all tasks that the worker runs."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    name = (hash(spec), remember)
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = PieceEncoder(spec, remember)
    return _ENCODERS[name]


def forget_encoders() -> None:
    """Let this worker's encoder go; the next task makes one anew."""
    _ENCODERS.clear()


def id_type(vocabulary: int) -> str:
    """The narrowest little-endian integer type for ids below ``vocabulary``."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def slices(texts: list, chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts with about so many characters, so that a batch's working set stays bounded."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= chars:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def broadcast_spec(docs: DataFrame, tokenizer: str) -> Broadcast[str]:
    """The text of a tokenizer file on the driver, sent to all tasks: a vocabulary, a few MB whatever the data."""
    with open(tokenizer, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def texts_of(docs: DataFrame) -> DataFrame:
    return small_batches(docs).selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text")


def batch_ids(
    batch: pa.RecordBatch, encoder: PieceEncoder, end_id: int, chars: int = 4_000_000
) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Parts of a batch of ``doc_id, text``: doc_ids, their ids one after the other with ``end_id`` behind each text,
    and where each text ends. A null text is empty. Texts keep their order but for the odd ones."""
    texts = [t or "" for t in batch.column(1).to_pylist()]
    for a, b in slices(texts, chars):
        odd = [i for i in range(a, b) if encoder.odd(texts[i])]
        plain = sorted(set(range(a, b)).difference(odd))
        if plain:
            yield batch.column(0).take(pa.array(plain)), *encoder.joined([texts[i] for i in plain], end_id)
        if odd:
            end = np.array([end_id], encoder.dtype).tobytes()
            blobs = [x + end for x in encoder.whole([texts[i] for i in odd])]
            ids = np.frombuffer(b"".join(blobs), encoder.dtype)
            yield batch.column(0).take(pa.array(odd)), ids, np.cumsum([len(x) for x in blobs]) // ids.itemsize
