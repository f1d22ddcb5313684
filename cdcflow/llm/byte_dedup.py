"""Removal of byte strings that occur more than once, by sparse suffix arrays sorted deep and shallow.

Suffixes are sorted where windows of WINDOW bytes have their minimiser: any two equal windows have it at the same place,
so these suffixes and what stands before them decide all windows. They travel to buckets with the windows around them. In
a bucket a multikey quicksort orders them to the shallow depth of the minimiser, PART bytes; groups that agree so far
have long common prefixes and are ordered by blind tries, once by what follows and once, backwards, by what precedes.
From the common lengths of neighbours in both orders it follows which windows are equal.
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

WINDOW, PART = 200, 32
FLUSH_CHARS = 24_000_000  # a task packs its runs each time it has read so much
NULL_ID = np.iinfo(np.int64).min
_BASE = 0x9E3779B97F4A7C15
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
SMALL = 4096  # below so many, numpy's sort ends a quicksort


def byte_parts(raw: np.ndarray) -> np.ndarray:
    """Hashes of all parts of some bytes."""
    hashes, reach = _BYTES[raw], 1
    while reach < PART:
        hashes = hashes[:-reach] * np.uint64(pow(_BASE, reach, 1 << 64)) + hashes[reach:]
        reach *= 2
    return mixed(hashes)


def text_parts(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return byte_parts(raw) if len(raw) >= PART else np.empty(0, np.uint64)


def byte_runs(texts: list[bytes], common: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of all texts: text, first window in it, windows, the minimiser's place behind the first window, its hash,
    first and last byte in the joined texts."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    if len(raw) < WINDOW:
        return *(np.empty(0, np.int64) for _ in range(4)), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = ranked(byte_parts(raw), common)
    places = minimisers(hashes, WINDOW - PART + 1)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    whole = np.zeros(len(raw) + 1, np.int8)
    long = sizes >= WINDOW
    whole[(ends - sizes)[long]] += 1
    whole[(ends - WINDOW + 1)[long]] -= 1
    first, last = runs(places, np.cumsum(whole[: len(places)], dtype=np.int8) > 0)
    of = np.searchsorted(ends, first, "right")
    return of, first - (ends - sizes)[of], last - first + 1, places[first] - first, hashes[places[first]], first, last + WINDOW


def _columns(parts: list[tuple]) -> dict[str, np.ndarray]:
    doc, mark, first, last = zip(*parts, strict=True) if parts else ((), (), (), ())
    return {"doc": np.array(doc, np.int64), "mark": np.array(mark, np.int64), "first": np.array(first, np.int32), "last": np.array(last, np.int32)}


def _deal(keys: list[int], common):
    buckets = len(keys)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, tuple] = {}  # string: doc, mark, first window, windows, minimiser's place, its hash
        known: set[bytes] = set()
        repeats: list[tuple] = []
        seen: set[tuple[int, int]] = set()

        def flush() -> pa.RecordBatch:
            repeats.extend((r[0], r[1], r[2], r[2] + r[3] - 1) for r in map(kept.__getitem__, known))
            rows = [(keys[len(repeats) % buckets], -1, pickle.dumps(_columns(repeats)))] if repeats else []
            strings = list(kept)
            doc, mark, start, windows, place, part = zip(*kept.values(), strict=True) if kept else ((),) * 6
            bucket = (np.array(part, np.uint64) >> np.uint64(28)) % np.uint64(buckets)
            columns = {"doc": np.array(doc, np.int64), "mark": np.array(mark, np.int64), "start": np.array(start, np.int32), "windows": np.array(windows, np.uint8), "place": np.array(place, np.uint8)}
            columns["known"] = np.fromiter((s in known for s in strings), bool, len(strings))
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
            for a, b in slices(texts, 400_000):
                fresh = []
                for i in range(a, b):  # rows equal in doc_id and text are one document
                    if (ids[i], marks[i]) not in seen:
                        seen.add((ids[i], marks[i]))
                        fresh.append(i)
                raw = [texts[i].encode() for i in fresh]
                joined = b"".join(raw)
                found = [x.tolist() for x in byte_runs(raw, common.value)]
                for i, start, windows, place, part, x, y in zip(*found, strict=True):
                    string, doc = joined[x:y], ids[fresh[i]]
                    new = (NULL_ID if doc is None else doc, marks[fresh[i]], start, windows, place, part)
                    if kept.setdefault(string, new) is not new:
                        known.add(string)
                        repeats.append((new[0], new[1], start, start + windows - 1))
                held += sum(map(len, texts[a:b]))
                if held >= FLUSH_CHARS:
                    yield flush()
                    held, kept, known, repeats, seen = 0, {}, set(), [], set()
        if kept:
            yield flush()

    return task


def multikey_quicksort(words: np.ndarray, order: np.ndarray, depth: int = 0) -> list[np.ndarray]:
    """The rows ``order`` of ``words`` sorted by their columns from ``depth`` on, as groups of equal rows."""
    done: list[np.ndarray] = []
    waiting = [(order, depth)]
    while waiting:
        own, depth = waiting.pop()
        if len(own) <= 1 or depth == words.shape[1]:
            if len(own):
                done.append(own)
            continue
        if len(own) <= SMALL:
            own = own[np.lexsort(words[own, depth:].T[::-1])]
            rows = words[own, depth:]
            cuts = np.flatnonzero((rows[1:] != rows[:-1]).any(axis=1)) + 1
            done += np.split(own, cuts)
            continue
        column = words[own, depth]
        pivot = np.partition(column[:: max(1, len(own) // 99)], len(column[:: max(1, len(own) // 99)]) // 2)[len(column[:: max(1, len(own) // 99)]) // 2]
        waiting += [(own[column > pivot], depth), (own[column == pivot], depth + 1), (own[column < pivot], depth)]
    return done


def common_length(a: bytes, b: bytes, low: int = 0) -> int:
    """Bytes that ``a`` and ``b`` have in common; ``low`` are known to be."""
    high = min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while low < high:  # a[:low] == b[:low], and they differ before high
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class BlindTrie:
    """Strings ordered by the places where they first differ; inner nodes hold that place, not the text before it."""

    def __init__(self, first: bytes, item: int):
        self.root: list = [len(first), {}, first, [item]]  # place, children by byte, a string below, items that end here

    def add(self, string: bytes, item: int) -> None:
        node, path = self.root, []
        while node[0] < len(string) and node[1]:  # blind: only bytes at branching places are looked at
            path.append(node)
            below = node[1].get(string[node[0]])
            if below is None:
                break
            node = below
        path.append(node)
        same = common_length(string, node[2])
        parent = None
        for node in path:
            if node[0] >= same:
                break
            parent = node
        if node[0] == same == len(string):
            node[3].append(item)
            return
        if node[0] > same:  # the edge above the node splits
            lower = node
            node = [same, {lower[2][same]: lower}, lower[2], []]
            if parent is None:
                self.root = node
            else:
                parent[1][node[2][parent[0]]] = node
        if same == len(string):
            node[2], node[3] = string, [*node[3], item]
        else:
            node[1][string[same]] = [len(string), {}, string, [item]]

    def ordered(self) -> tuple[list[int], list[int]]:
        """Items in order, and what each has in common with the one before (0 for the first)."""
        items, common, waiting = [], [], [(self.root, 0)]
        while waiting:
            (place, below, _, own), shared = waiting.pop()
            for n, item in enumerate(own):
                items.append(item)
                common.append(place if n else shared)
            waiting += [(below[c], place if own or n else shared) for n, c in reversed(list(enumerate(sorted(below))))]
        return items, common


def trie_order(strings: list[bytes], items: list[int]) -> tuple[list[int], list[int]]:
    trie = BlindTrie(strings[0], items[0])
    for string, item in zip(strings[1:], items[1:], strict=True):
        trie.add(string, item)
    return trie.ordered()


def equal_windows(strings: list[bytes], place: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Pairs (string, window in it) of windows that also occur in another of these distinct strings."""
    raw = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    at = np.cumsum(sizes) - sizes + place
    words = raw[at[:, None] + np.arange(PART)].reshape(-1).view(">u8").astype(np.uint64).reshape(len(strings), -1)
    groups = [g.tolist() for g in multikey_quicksort(words, np.arange(len(strings))) if len(g) > 1]
    right, right_common, left, left_common = [], [], [], []
    for group in groups:
        for order, common, side in (
            (right, right_common, [strings[i][place[i] + PART :] for i in group]),
            (left, left_common, [strings[i][: place[i]][::-1] for i in group]),
        ):
            items, lengths = trie_order(side, group)
            order += items
            common += [-1, *lengths[1:]]  # no window is equal across groups
    if not groups:
        return np.empty((0, 2), np.int64)
    members = np.array(right)
    back = np.empty(len(strings), np.int64)
    back[members] = np.arange(len(members))
    left_at = back[np.array(left)]
    # What a neighbour has in common behind the minimiser adds to the minimiser's own bytes.
    r, l = np.array(right_common), np.array(left_common)
    r = np.where(r < 0, -1, r + PART)
    high = place[members]
    low = high - windows[members] + 1
    found = []
    for before in range(WINDOW - PART + 1):  # bytes of the window that stand before the minimiser
        behind = np.cumsum(r < WINDOW - before)
        ahead = np.empty(len(members), np.int64)
        ahead[left_at] = np.cumsum(l < before)
        own = np.flatnonzero((low <= before) & (before <= high))
        name = behind[own] * (len(members) + 1) + ahead[own]
        order = np.argsort(name, kind="stable")
        same = name[order][1:] == name[order][:-1]
        more = np.zeros(len(own), bool)
        more[order[1:][same]] = more[order[:-1][same]] = True
        who = own[more]
        found.append(np.stack([members[who], high[who] - before], axis=1))
    return np.concatenate(found)


def _solve(data: list[bytes]) -> dict[str, np.ndarray]:
    """Columns of the spans of windows in a bucket that occur elsewhere."""
    opened = [unpacked(d) for d in data]
    c = {k: np.concatenate([columns[k] for _, columns in opened]) for k in opened[0][1]}
    places = list(zip(c["doc"].tolist(), c["mark"].tolist(), c["start"].tolist(), strict=True))
    distinct: dict[bytes, list[int]] = {}
    for i, string in enumerate(s for strings, _ in opened for s in strings):
        distinct.setdefault(string, []).append(i)
    repeats: list[tuple] = []
    partly = []
    for n, own in enumerate(distinct.values()):
        if len({places[i] for i in own}) > 1 or c["known"][own].any():
            for i in own:
                if not c["known"][i]:
                    doc, mark, start = places[i]
                    repeats.append((doc, mark, start, start + int(c["windows"][i]) - 1))
        else:
            partly.append(n)
    one = np.array([own[0] for own in distinct.values()])
    pairs = equal_windows(list(distinct), c["place"][one].astype(np.int64), c["windows"][one].astype(np.int64))
    pairs = pairs[np.isin(pairs[:, 0], np.array(partly, np.int64))]
    i = one[pairs[:, 0]]
    first = c["start"][i] + pairs[:, 1]
    out = _columns(repeats)
    more = {"doc": c["doc"][i], "mark": c["mark"][i], "first": first, "last": first}
    return {k: np.concatenate([out[k], more[k].astype(out[k].dtype)]) for k in out}


def _cut(text: str, spans: np.ndarray) -> tuple[int, int, int, str]:
    raw = text.encode()
    if not len(spans):
        return len(raw), 0, 0, hashlib.sha256(raw).hexdigest()
    gone = covered(len(raw), spans, WINDOW)
    begins = np.count_nonzero(gone[1:] & ~gone[:-1]) + bool(gone[0])
    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
    return len(raw), int(gone.sum()), int(begins), hashlib.sha256(kept).hexdigest()


def without_repeated_bytes(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row.

    Null and empty texts have no bytes. Rows that repeat both doc_id and text are one document, and each row gets its
    result; other rows of one doc_id are documents of their own.
    """
    docs = marked(docs)
    schema = "n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING"
    return applied(docs, dealt(docs, _deal, _solve, text_parts), _cut, schema)


def op2_suffix_array_dedup(spark, sf_dir):
    return without_repeated_bytes(documents(spark, sf_dir))
