"""Removal of word windows that stand earlier in the corpus, by super-k-mers of words.

Runs of windows of WINDOW words go to the bucket of their minimiser, PART words of smallest hash, as one packed string.
In a bucket, strings of one minimiser are sorted. Of equal strings the earliest place stays and the others are repeats
whole; the windows of strings that differ are sorted themselves, as text, and all but the earliest of equals are
repeats. A task that meets a string again keeps the earliest and reports the others at once, so that copies of one
document reach a bucket once for each task.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents
from .superkmers import applied, covered, dealt, marked, minimisers, mixed, packed, packets, ranked, runs, unpacked
from .tokens import slices

WINDOW, PART = 20, 4
FLUSH_CHARS = 16_000_000  # a task packs its runs each time it has read so much
NULL_ID = np.iinfo(np.int64).min


def word_parts(hashes: np.ndarray) -> np.ndarray:
    """Hashes of all parts, by the hashes of the words."""
    n = max(0, len(hashes) - PART + 1)
    parts = hashes[:n].copy()
    for k in range(1, PART):
        parts = mixed(parts) + hashes[k : k + n]
    return mixed(parts)


def text_parts(text: str) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    words = text.encode().split()
    return word_parts(np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)))


def word_runs(texts: list[str], common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Runs of all texts: text, first window in it, windows, minimiser's hash, and packed string."""
    from xxhash import xxh3_64_intdigest

    split = [t.encode().split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    words = [w for ws in split for w in ws]
    if len(words) < WINDOW:
        return *(np.empty(0, np.int64) for _ in range(3)), np.empty(0, np.uint64), []
    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    joined = b" ".join(words)
    offsets = np.cumsum([0, *(len(w) + 1 for w in words)])
    parts = ranked(word_parts(hashes), common)
    places = minimisers(parts, WINDOW - PART + 1)
    ends = np.cumsum(counts)
    text = np.repeat(np.arange(len(texts)), counts)
    at = np.arange(len(places))
    whole = at + WINDOW <= ends[text[: len(places)]]
    first, last = runs(places, whole)
    strings = [joined[a:b] for a, b in zip(offsets[first].tolist(), (offsets[last + WINDOW] - 1).tolist(), strict=True)]
    of = text[first]
    return of, first - (ends - counts)[of], last - first + 1, parts[places[first]], strings


def _columns(rows: list[tuple]) -> dict[str, np.ndarray]:
    doc, mark, first, last = zip(*rows, strict=True) if rows else ((), (), (), ())
    return {"doc": np.array(doc, np.int64), "mark": np.array(mark, np.int64), "first": np.array(first, np.int32), "last": np.array(last, np.int32)}


def _deal(keys: list[int], common):
    buckets = len(keys)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, tuple] = {}
        repeats: list[tuple] = []
        seen: set[tuple[int, int]] = set()

        def flush() -> pa.RecordBatch:
            rows = [(keys[len(repeats) % buckets], -1, pickle.dumps(_columns(repeats)))] if repeats else []
            strings = list(kept)
            doc, mark, start, windows, part = zip(*kept.values(), strict=True) if kept else ((),) * 5
            part = np.array(part, np.uint64)
            bucket = (part >> np.uint64(28)) % np.uint64(buckets)
            columns = {"doc": np.array(doc, np.int64), "mark": np.array(mark, np.int64), "start": np.array(start, np.int32), "windows": np.array(windows, np.uint16), "part": part.astype(np.uint32)}
            order = np.argsort(bucket, kind="stable")
            ends = np.cumsum(np.bincount(bucket.astype(np.int64), minlength=buckets))
            for b, (a, z) in enumerate(zip([0, *ends.tolist()], ends.tolist(), strict=False)):
                if a < z:
                    own = order[a:z]
                    rows.append((keys[b], b, packed([strings[i] for i in own.tolist()], {k: c[own] for k, c in columns.items()})))
            return packets(rows)

        held = 0
        for batch in batches:
            ids, marks, texts = (batch.column(i).to_pylist() for i in range(3))
            for a, b in slices(texts):
                fresh = []
                for i in range(a, b):  # rows equal in doc_id and text are one document
                    if (ids[i], marks[i]) not in seen:
                        seen.add((ids[i], marks[i]))
                        fresh.append(i)
                of, start, windows, part, strings = word_runs([texts[i] for i in fresh], common.value)
                for i, s, n, p, string in zip(of.tolist(), start.tolist(), windows.tolist(), part.tolist(), strings, strict=True):
                    doc = ids[fresh[i]]
                    new = (NULL_ID if doc is None else doc, marks[fresh[i]], s, n, p)
                    old = kept.setdefault(string, new)
                    if old is not new:
                        later = max(old, new)
                        kept[string] = min(old, new)
                        repeats.append((later[0], later[1], later[2], later[2] + n - 1))
                held += sum(map(len, texts[a:b]))
                if held >= FLUSH_CHARS:
                    yield flush()
                    held, kept, repeats, seen = 0, {}, [], set()
        if kept or repeats:
            yield flush()

    return task


def _solve(data: list[bytes]) -> dict[str, np.ndarray]:
    """Columns of the spans of windows in a bucket that stand earlier."""
    opened = [unpacked(d) for d in data]
    strings = [s for found, _ in opened for s in found]
    c = {k: np.concatenate([columns[k] for _, columns in opened]) for k in opened[0][1]}
    order = np.argsort(c["part"], kind="stable")
    ranked = c["part"][order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    sizes = np.diff(np.append(starts, len(ranked)))
    repeats: list[tuple] = []
    for a, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        own = order[a : a + n].tolist()
        places = sorted((strings[i], int(c["doc"][i]), int(c["mark"][i]), int(c["start"][i]), int(c["windows"][i])) for i in own)
        earliest = []
        for n, place in enumerate(places):
            if n and place == places[n - 1]:
                continue  # a row that repeats is the same document
            if n and place[0] == places[n - 1][0]:
                repeats.append((place[1], place[2], place[3], place[3] + place[4] - 1))
            else:
                earliest.append(place)
        if len(earliest) < 2:
            continue
        windows = []
        for string, doc, mark, start, count in earliest:
            words = string.split(b" ")
            ends = np.cumsum([len(w) + 1 for w in words]).tolist()
            begins = [0, *ends]
            windows += [(string[begins[k] : ends[k + WINDOW - 1] - 1], doc, mark, start + k) for k in range(count)]
        windows.sort()
        repeats += [(w[1], w[2], w[3], w[3]) for n, w in enumerate(windows) if n and w[0] == windows[n - 1][0] and w[1:] != windows[n - 1][1:]]
    return _columns(repeats)


def _cut(text: str, spans: np.ndarray) -> tuple[int, int, str]:
    words = text.encode().split()
    if not len(spans):
        return len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest()
    gone = covered(len(words), spans, WINDOW)
    kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
    return len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of each row.

    Null and empty texts have no words. Rows of one doc_id but different texts come in order of a hash of the text; rows
    that repeat both are one document, and each row gets its result. A null doc_id comes before all others.
    """
    docs = marked(docs)
    return applied(docs, dealt(docs, _deal, _solve, text_parts), _cut, "n_words BIGINT, n_removed BIGINT, kept_sha256 STRING")


def op8_substring_dedup(spark, sf_dir):
    return without_repeats(documents(spark, sf_dir))
