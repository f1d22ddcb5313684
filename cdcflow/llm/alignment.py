"""Alignment of two tokenizers' ids of the same texts.

Both tokenizers encode every whole text. Where tokens of both end at the same byte and the next tokens of both begin
with a space, the text is cut: windows of a few ids each, most of them a word. How a window aligns follows from its ids
alone, so it is remembered by them and computed once a worker as long as it stays in memory. Groups and links of a
text are those of its windows. Links are counted over all documents by chunks (see ``chunks``).

A null or empty text, and one whose tokens do not spell it, have no tokens and zeros. Rows that repeat count and are
returned each; a null doc_id stays. An empty table gives an empty result. A very long text is a chunk of its own: the
tokenizers need it whole, and a task then holds about 30 times its bytes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks
from .common import documents, stored
from .tokens import PieceEncoder, broadcast_spec, slices, texts_of

CHUNK_CHARS = 4_000_000
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
ENCODED = (
    f"chunk BIGINT, bucket INT, keys BINARY, n BINARY, doc_id ARRAY<BIGINT>, {', '.join(f'{c} ARRAY<BIGINT>' for c in COUNTS)}, "
    "groups_sha256 ARRAY<STRING>, doc_sizes BINARY, windows BINARY, times BINARY, window_sizes BINARY, links BINARY"
)
RESULT = (
    "doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, n_best BIGINT, count_sum BIGINT, groups_sha256 STRING"
)


class SegmentEncoder:
    """Texts to ids of a sentencepiece model, a space in front of each.

    No piece of the model holds a space behind another sign, so merges never cross the place before a run of spaces,
    and what stands between two such places has the same ids in any text. These segments are encoded once and
    remembered, in two generations of ``remember`` each.
    """

    def __init__(self, model: bytes, remember: int = 350_000):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.pieces.id_to_piece(n) for n in range(self.pieces.get_piece_size())]
        self.separable = not any("▁" in name.lstrip("▁") for name in names)
        self.blank = np.array([self.pieces.piece_to_id("▁")], "<u4").tobytes()
        self.remember, self.known, self.older = remember, {}, {}

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, "<u4") for x in self.pieces.encode(texts, num_threads=1)]

    def _segments(self, segments: list[bytes]) -> list[bytes]:
        known, older = self.known, self.older
        out = [known.get(x) for x in segments]
        missing = [i for i, x in enumerate(out) if x is None]
        for i in missing:
            out[i] = older.get(segments[i])
        new = [i for i in missing if out[i] is None]
        for i, ids in zip(new, self.pieces.encode([segments[i][1:].decode() for i in new], num_threads=1), strict=True):
            out[i] = array("I", ids).tobytes() if segments[i] != b" " else self.blank
        if len(known) + len(missing) > self.remember:
            self.known, self.older = {}, known
        self.known.update((segments[i], out[i]) for i in missing)
        return out

    def encode(self, texts: list[str], raw: bytes, text_sizes: np.ndarray) -> list[np.ndarray]:
        """The ids of each text; ``raw`` has their bytes one after the other, a space before each."""
        if not self.separable or not texts:
            return self.whole(texts)
        space = np.frombuffer(raw, np.uint8) == 32
        start = space.copy()
        start[1:] &= ~space[:-1]
        text_starts = np.cumsum(text_sizes) - text_sizes
        start[text_starts] = True
        starts = np.flatnonzero(start)
        offsets = np.append(starts, len(raw)).astype(np.int64)
        segments = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]
        ).dictionary_encode()
        blobs = self._segments(segments.dictionary.to_pylist())
        which = segments.indices.to_numpy()
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        first = np.cumsum(sizes) - sizes
        size = sizes[which]
        ends = np.cumsum(size)
        at = np.repeat(first[which] - ends + size, size)
        at += np.arange(len(at))
        ids = np.frombuffer(b"".join(blobs), "<u4")[at]
        return np.split(ids, ends[np.searchsorted(starts, text_starts[1:]) - 1])


class Aligner:
    """Texts to windows of ids; ``spec`` is the JSON text of tokenizer A, ``model`` the model file of B."""

    def __init__(self, spec: str, model: bytes, remember: int = 400_000):
        self.a = PieceEncoder(spec, 350_000)
        self.a.tokenizer.encode_special_tokens = True
        self.a.added = re.compile("(?!)")  # what spells an added token is plain text
        self.b = SegmentEncoder(model)
        signs = byte_signs()
        vocab = {n: t for t, n in self.a.tokenizer.get_vocab().items()}
        bytes_a = [bytes(signs.get(s, 63) for s in vocab.get(n, "")) for n in range(max(vocab) + 1)]
        pieces, bytes_b = self.b.pieces, []
        for n in range(pieces.get_piece_size()):
            piece = pieces.id_to_piece(n)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(n) else piece.replace("▁", " ").encode())
        self.spelled = [Spelling(bytes_a), Spelling(bytes_b)]
        self.remember, self.known, self.older = remember, {}, {}

    def ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
        """The ids of texts by A and by B, the bytes of each text with a space before it, and whether both spell it."""
        raws = [b" " + t.encode() for t in texts]
        sizes, raw = np.array(list(map(len, raws)), np.int64), b"".join(raws)
        a = [np.frombuffer(x, self.a.dtype) for x in self.a.encode([" " + t for t in texts])]
        b = self.b.encode(texts, raw, sizes)
        fine = spelled_right(raw, sizes, b, self.spelled[1])
        others = np.flatnonzero(~fine).tolist()
        if others:  # the model writes these texts otherwise, so their segments may be others as well
            for i, ids in zip(others, self.b.whole([texts[i] for i in others]), strict=True):
                b[i] = ids
            fine = spelled_right(raw, sizes, b, self.spelled[1])
        return a, b, sizes, fine & spelled_right(raw, sizes, a, self.spelled[0])

    def aligned(self, windows: list[bytes]) -> list[tuple[str, int, bytes]]:
        """For each window its groups as text, their number, and its links as whole numbers, B's id in the high half."""
        if not windows:
            return []
        data = np.frombuffer(b"".join(windows), "<u4").astype(np.int64)
        total = np.array(list(map(len, windows)), np.int64) // 4
        head = np.cumsum(total) - total
        n_a = data[head]
        n_b = total - n_a - 1
        of_a, of_b = np.repeat(np.arange(len(total)), n_a), np.repeat(np.arange(len(total)), n_b)
        place = np.arange(len(data)) - np.repeat(head, total)
        is_a = (place > 0) & (place <= np.repeat(n_a, total))
        a, b = data[is_a], data[place > np.repeat(n_a, total)]
        # Windows have as many bytes on either side, so ends agree when all windows stand in one row.
        ends_a, ends_b = np.cumsum(self.spelled[0].sizes[a]), np.cumsum(self.spelled[1].sizes[b])
        met = np.zeros(int(ends_a[-1]) + 1, np.uint8)
        met[ends_a] += 1
        met[ends_b] += 2
        ends = np.flatnonzero(met)
        links = (b[np.searchsorted(ends_b, ends)] << 32 | a[np.searchsorted(ends_a, ends)]).tobytes()
        group_ends = np.flatnonzero(met == 3)
        group_a, group_b = np.searchsorted(group_ends, ends_a), np.searchsorted(group_ends, ends_b)
        last = group_ends[group_b] == ends_b
        text, cuts = spelled_groups(a, b, group_a, group_b, last, np.cumsum(n_b) - 1)
        groups = np.bincount(of_b[last], minlength=len(total)).tolist()
        cut = np.cumsum(n_a + n_b - np.array(groups)) * 8
        starts = zip([0, *cuts], cuts, [0, *cut.tolist()], cut.tolist(), strict=False)
        return [(text[i : j - 1], n, links[x:y]) for n, (i, j, x, y) in zip(groups, starts, strict=False)]

    def all_aligned(self, windows: list[bytes]) -> list[tuple[str, int, bytes]]:
        """``aligned`` of distinct windows, remembered in two generations of ``remember`` each."""
        known, older = self.known, self.older
        out = [known.get(w) for w in windows]
        missing = [i for i, x in enumerate(out) if x is None]
        for i in missing:
            out[i] = older.get(windows[i])
        new = [i for i in missing if out[i] is None]
        for i, found in zip(new, self.aligned([windows[i] for i in new]), strict=True):
            out[i] = found
        if len(known) + len(missing) > self.remember:
            self.known, self.older = {}, known
        self.known.update((windows[i], out[i]) for i in missing)
        return out


NUMBERS: dict[int, Spelling] = {}


def spelled_groups(
    a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, last: np.ndarray, ends: np.ndarray
) -> tuple[str, list[int]]:
    """Ids in decimal, group by group, those of A before those of B, a sign behind each: ``,`` or at the end of a
    side ``|`` or ``;``. ``last`` marks the ends of groups among B's ids; of the ids at ``ends`` comes the place behind."""
    order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
    ids = np.concatenate([a, b])[order]
    most = 1 << int(ids.max()).bit_length()
    if most not in NUMBERS:
        NUMBERS[most] = Spelling([b"%d," % n for n in range(most)])
    names = NUMBERS[most]
    raw = names.bytes_of(ids)
    behind = np.cumsum(names.sizes[ids])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    last_a = np.concatenate([group_a[1:] != group_a[:-1], [True]])
    raw[behind[place[: len(a)][last_a]] - 1] = ord("|")
    raw[behind[place[len(a) :][last]] - 1] = ord(";")
    return raw.tobytes().decode(), behind[place[len(a) :][ends]].tolist()


class Spelling:
    """The bytes of each token of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array(list(map(len, tokens)), np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.raw = np.frombuffer(b"".join(tokens), np.uint8)
        self.marked = np.array([t[:1] == b" " for t in tokens])

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        size = self.sizes[ids]
        at = np.repeat(self.first[ids] - np.cumsum(size) + size, size)
        at += np.arange(len(at))
        return self.raw[at]


def byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable ones themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def spelled_right(raw: bytes, text_sizes: np.ndarray, ids: list[np.ndarray], spelling: Spelling) -> np.ndarray:
    """Whether the ids of each text spell it; ``raw`` are the texts one after the other."""
    sizes = np.array([int(spelling.sizes[x].sum()) for x in ids], np.int64)
    right = sizes == text_sizes
    begin = np.cumsum(text_sizes) - text_sizes
    same = [i for i in np.flatnonzero(right).tolist() if len(ids[i])]
    if same:
        given = np.frombuffer(raw, np.uint8)
        own = spelling.bytes_of(np.concatenate([ids[i] for i in same]))
        if len(same) < len(ids):
            given = np.concatenate([given[begin[i] : begin[i] + text_sizes[i]] for i in same])
        if not np.array_equal(own, given):
            ends = np.cumsum(text_sizes[same])
            wrong = np.unique(np.searchsorted(ends, np.flatnonzero(own != given), side="right"))
            right[np.array(same)[wrong]] = False
    return right


def windows_of(a: np.ndarray, b: np.ndarray, ends: np.ndarray, aligner: Aligner) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Windows of texts one after the other, which end at the bytes ``ends``: for each its place among the distinct
    ones, these (the number of A's ids, A's ids, B's ids), and the number of windows of each text."""
    sides = []
    for ids, spelling in zip((a, b), aligner.spelled, strict=True):
        at = np.cumsum(spelling.sizes[ids])
        before_space = np.zeros(len(ids), bool)
        before_space[:-1] = spelling.marked[ids[1:]]
        sides.append((at, before_space))
    cut = np.ones(int(ends[-1]) + 1, bool)
    for at, before_space in sides:
        may = np.zeros(len(cut), bool)
        may[at[before_space]] = True
        may[ends] = True
        cut &= may
    lasts = [np.flatnonzero(cut[at]) for at, _ in sides]
    sizes = [np.diff(last, prepend=-1) for last in lasts]
    total = 1 + sizes[0] + sizes[1]
    offsets = np.concatenate([[0], np.cumsum(total)])
    data = np.empty(offsets[-1], "<u4")
    data[offsets[:-1]] = sizes[0]
    for ids, size, start in ((a, sizes[0], offsets[:-1] + 1), (b, sizes[1], offsets[:-1] + 1 + sizes[0])):
        places = np.repeat(start - np.cumsum(size) + size, size)
        places += np.arange(len(places))
        data[places] = ids
    array = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(total), [None, pa.py_buffer((offsets * 4).astype(np.int64)), pa.py_buffer(data)]
    ).dictionary_encode()
    of_text = np.searchsorted(np.flatnonzero(cut[1:]) + 1, ends, side="right")
    return array.indices.to_numpy(), array.dictionary.to_pylist(), np.diff(of_text, prepend=0)


def chunk_rows(chunk: int, doc_ids: list, texts: list[str], buckets: int, aligner: Aligner) -> list[dict]:
    """A row of the chunk itself, with all that its documents need but counts, and one for each bucket of its links."""
    n = len(texts)
    counts = {c: np.zeros(n, np.int64) for c in COUNTS}
    shas = [""] * n
    row = {"chunk": chunk, "doc_id": doc_ids}
    filled = [i for i in range(n) if texts[i]]
    a, b, sizes, fine = aligner.ids([texts[i] for i in filled])
    good = np.flatnonzero(fine).tolist()
    doc_sizes = np.zeros(n, "<u4")
    found, times, window_sizes, links = (np.zeros(0, "<u4"),) * 4
    keys = np.zeros(0, np.int64)
    if good:
        which, distinct, per_text = windows_of(
            np.concatenate([a[i] for i in good]), np.concatenate([b[i] for i in good]), np.cumsum(sizes[good]), aligner
        )
        known = aligner.all_aligned(distinct)
        names, groups = [k[0] for k in known], np.array([k[1] for k in known], np.int64)
        window_sizes = np.array([len(k[2]) // 8 for k in known], "<u4")
        starts = np.concatenate([[0], np.cumsum(per_text)]).tolist()
        for i, begin, end in zip(good, starts, starts[1:], strict=False):
            at, part = filled[i], which[begin:end]
            counts["n_a"][at], counts["n_b"][at] = len(a[i]), len(b[i])
            counts["n_groups"][at] = groups[part].sum()
            counts["n_links"][at] = counts["n_a"][at] + counts["n_b"][at] - counts["n_groups"][at]
            shas[at] = hashlib.sha256(";".join([names[w] for w in part.tolist()]).encode()).hexdigest()
        owner = np.repeat(np.array([filled[i] for i in good], np.int64), per_text)
        pairs, times = np.unique(owner << 32 | which, return_counts=True)
        found = pairs & 0xFFFFFFFF
        doc_sizes = np.bincount(pairs >> 32, minlength=n)
        flat = np.frombuffer(b"".join([k[2] for k in known]), np.int64)
        often = np.repeat(np.bincount(which, minlength=len(known)), window_sizes)
        keys, n_links, place = chunks.summed(flat, often)
        of = chunks.mixed(keys >> 32, buckets)
        order = np.argsort(of, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        links = rank[place]
    row |= {c: v.tolist() for c, v in counts.items()} | {"groups_sha256": shas}
    blobs = {"doc_sizes": doc_sizes, "windows": found, "times": times, "window_sizes": window_sizes, "links": links}
    rows = [row | {k: chunks.zipped(v.astype("<u4")) for k, v in blobs.items()}]
    if len(keys):
        cuts = np.bincount(of, minlength=buckets).tolist()
        for bucket, (k, m) in enumerate(zip(chunks.split_at(keys[order], cuts), chunks.split_at(n_links[order], cuts), strict=True)):
            if len(k):
                rows.append({"chunk": chunk, "bucket": bucket, "keys": chunks.zipped_keys(k), "n": chunks.zipped(m.astype("<i8"))})
    return rows


ROW = pa.schema(
    [("chunk", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("n", pa.binary()), ("doc_id", pa.list_(pa.int64()))]
    + [(c, pa.list_(pa.int64())) for c in COUNTS]
    + [("groups_sha256", pa.list_(pa.string()))]
    + [(c, pa.binary()) for c in ("doc_sizes", "windows", "times", "window_sizes", "links")]
)
_ALIGNERS: dict[int, Aligner] = {}


def link_counts(rows: pa.Table) -> pa.Table:
    """For each link of a bucket twice its count over all documents, and one more if no other link of B's id has more."""
    rows = rows.to_pylist()
    keys = [chunks.unzipped_keys(r["keys"]) for r in rows]
    distinct, total, at = chunks.summed(np.concatenate(keys), np.concatenate([chunks.unzipped(r["n"], "<i8") for r in rows]))
    own = distinct >> 32
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    most = np.repeat(np.maximum.reduceat(total, first), np.diff(first, append=len(own)))
    said = chunks.split_at((total * 2 + (total == most))[at], list(map(len, keys)))
    return pa.table(
        {
            "chunk": pa.array([r["chunk"] for r in rows], pa.int64()),
            "bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
            "answers": pa.array([chunks.zipped(x.astype("<i8")) for x in said], pa.binary()),
        }
    )


def document_rows(row: dict, answers: list[dict]) -> pa.Table:
    said = np.concatenate([np.zeros(0, np.int64), *(chunks.unzipped(r["answers"], "<i8") for r in answers)])
    blob = {k: chunks.unzipped(row[k]).astype(np.int64) for k in ("doc_sizes", "windows", "times", "window_sizes", "links")}
    values = {"n_best": said & 1, "count_sum": said >> 1}
    for name, value in values.items():
        of_window = chunks.runs(value[blob["links"]], blob["window_sizes"])
        values[name] = chunks.runs(of_window[blob["windows"]] * blob["times"], blob["doc_sizes"])
    columns = {"doc_id": pa.array(row["doc_id"], pa.int64())} | {c: pa.array(row[c], pa.int64()) for c in COUNTS}
    columns |= {c: pa.array(v) for c, v in values.items()} | {"groups_sha256": pa.array(row["groups_sha256"], pa.string())}
    return pa.table(columns)


def aligned_documents(docs: DataFrame, tokenizer_a: str, model_b: str, chars: int = CHUNK_CHARS) -> DataFrame:
    """``RESULT`` for every whole text of ``doc_id, text``; A is a byte-level tokenizer file, B a sentencepiece model."""
    buckets, spec = chunks.bucket_count(docs), broadcast_spec(docs, tokenizer_a)
    with open(model_b, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        name = hash((spec.value, model.value))
        if name not in _ALIGNERS:
            _ALIGNERS.clear()
            _ALIGNERS[name] = Aligner(spec.value, model.value)
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for begin, end in slices(texts, chars):
                yield pa.RecordBatch.from_pylist(chunk_rows(chunk, doc_ids[begin:end], texts[begin:end], buckets, _ALIGNERS[name]), ROW)
                chunk += 1

    rows = stored(texts_of(docs).mapInArrow(task, ENCODED), "aligned")
    own = rows.filter("bucket IS NULL").drop("bucket", "keys", "n")
    parts = rows.filter("bucket IS NOT NULL").select("chunk", "bucket", "keys", "n")
    answers = chunks.ask(parts, link_counts, "chunk BIGINT, bucket INT, answers BINARY")
    return chunks.together(own, answers, document_rows, RESULT)


def op12_cross_tokenizer_alignment(spark, sf_dir):
    import public_tokenizers

    return aligned_documents(
        documents(spark, sf_dir).select("doc_id", F.col("text")),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
