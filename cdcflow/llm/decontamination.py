"""Benchmark items in documents, up to a share of edited words.

Words are compared by 64-bit hashes of their lower-cased bytes. An item of n words may differ in k words (inserted, left
out or replaced), k the floor of ``EDITS`` * n. The window that starts at each word of a document goes through the CGK random
walk, which turns edit distance into Hamming distance: at each step it writes the word it stands on and moves on or stays
by a random bit of step and word. A walk is the same for windows of any size until a window ends, so items of similar
length (a class) share one table and all classes share the walk. Bit sampling compares a few random steps of the embedding,
in several bands a walk; walks are repeated until simulated items with k edits reach ``RECALL``. An item is entered as it
reads from several of its words on (``ANCHORS``), so edits that crowd at its beginning do not hide it. What collides and
shares enough words with its item is checked by exact edit distance.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import documents, free_name, lean, small_batches
from .tokens import slices

EDITS, RECALL, SAMPLED, BANDS = 0.15, 0.99, 3, 6
ANCHORS = (0.0, 0.25, 0.5)  # where in an item the windows begin under which it is entered
CLASS = 1.6  # longest item of a class by its shortest, which gives the steps that are sampled
MOST_STEPS, MOST_WALKS, SIMULATED = 64, 64, 400
BLOCK = 16_384  # windows embedded at a time; their steps stay in the cache
ITEM_BLOCK = 20_000  # items that one pass over the documents looks for; more take more passes
FOUND = "ARRAY<STRUCT<item_id: BIGINT, start_word: BIGINT, n_words: BIGINT, n_edits: BIGINT>>"
PAD = np.uint64(0)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WEIGHTS = np.array([random.Random(n).getrandbits(64) | 1 for n in range(SAMPLED)], np.uint64)


def word_hashes(text: str | None) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode().lower().split()
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def allowed(n: int) -> int:
    return int(EDITS * n)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def embedded(words: np.ndarray, windows: int, steps: int, walk: int) -> np.ndarray:
    """The first ``steps`` of the CGK embedding of the windows that start at the first ``windows`` words: a row a step."""
    padded = np.concatenate([words, np.full(steps, PAD, np.uint64)])
    at, out = np.arange(windows), np.empty((steps, windows), np.uint64)
    move = np.empty(windows, np.uint64)
    for step in range(steps):
        if step % 64 == 0:
            moves = _mixed(_mixed(padded ^ np.uint64((walk << 32 | step) * 0x2545F4914F6CDD1D & (1 << 64) - 1)))
        padded.take(at, out=out[step], mode="clip")
        moves.take(at, out=move, mode="clip")
        np.right_shift(move, np.uint64(step % 64), out=move)
        np.bitwise_and(move, np.uint64(1), out=move)
        at += move.view(np.int64)
    return out


def classes(lengths: list[int]) -> list[int]:
    """The shortest length of each class of lengths."""
    out: list[int] = []
    for n in sorted(set(lengths)):
        if not out or n > CLASS * out[-1]:
            out.append(n)
    return out


def sampled_steps(walk: int, shortest: int) -> list[list[int]]:
    """The steps that each band of a walk compares, for a class: one out of each part of as many steps as words."""
    rng, steps = random.Random(f"{walk} {shortest}"), min(MOST_STEPS, shortest)
    return [[int((n + rng.random()) * steps / SAMPLED) for n in range(SAMPLED)] for _ in range(BANDS)]


def signature(embedding: np.ndarray, steps: list[int]) -> np.ndarray:
    out = embedding[steps[0]] * _WEIGHTS[0]
    for step, weight in zip(steps[1:], _WEIGHTS[1:], strict=True):
        out += embedding[step] * weight
    return out


def anchors(n: int) -> list[int]:
    return sorted({int(part * n) for part in ANCHORS})


def _edited(words: np.ndarray, edits: int, rng: random.Random) -> np.ndarray:
    """``words`` with random edits, in the middle of other words."""
    out = words.tolist()
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        out[at : at + (kind != 0)] = [rng.getrandbits(64)] * (kind != 2)
    return np.array(out + [rng.getrandbits(64) for _ in words], np.uint64)


def walks_needed(items: list[np.ndarray]) -> int:
    """Walks until so many simulated items with all allowed edits collide as RECALL asks; raises if MOST_WALKS do not."""
    rng, starts = random.Random(1), classes([len(a) for a in items])
    some = [a for a in items if allowed(len(a))]
    if not some:
        return 1
    open_pairs = [(a, _edited(a, allowed(len(a)), rng)) for a in (some[rng.randrange(len(some))] for _ in range(SIMULATED))]
    for walk in range(MOST_WALKS):
        missed = []
        for plain, other in open_pairs:
            shortest, k = max(s for s in starts if s <= len(plain)), allowed(len(plain))
            steps = min(MOST_STEPS, shortest)
            one, two = embedded(plain, len(plain), steps, walk), embedded(other, len(other), steps, walk)
            met = False
            for band in sampled_steps(walk, shortest):
                a, b = signature(one, band), signature(two, band)
                met = met or any((b[max(0, o - k) : o + k + 1] == a[o]).any() for o in anchors(len(plain)))
            if not met:
                missed.append((plain, other))
        open_pairs = missed
        if len(open_pairs) <= (1 - RECALL) * SIMULATED:
            return walk + 1
    raise ValueError(f"{MOST_WALKS} walks miss {len(open_pairs)} of {SIMULATED} simulated items")


def infix_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The least edit distance of ``item`` to any run of ``text``, and the end of the first such run."""
    at = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item.tolist(), 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (text != np.uint64(word)), row[1:] + 1)
        row = np.minimum.accumulate(new - at) + at
    end = int(row.argmin())
    return int(row[end]), end


class Index:
    """Signatures of a block of items, by walk, class and band; it grows with the block only."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], walks: int):
        self.ids, self.items = [i for i, _ in items], [a for _, a in items]
        self.sorted = [np.unique(a) for a in self.items]
        starts = classes([len(a) for a in self.items])
        of_class: dict[int, list[int]] = {}
        for i, words in enumerate(self.items):
            of_class.setdefault(max(s for s in starts if s <= len(words)), []).append(i)
        self.steps = min(MOST_STEPS, max(starts, default=1))
        self.bands: list[list[tuple]] = [[] for _ in range(walks)]
        for walk, bands in enumerate(self.bands):
            for shortest, members in of_class.items():
                places = [(i, o) for i in members for o in anchors(len(self.items[i]))]
                item, anchor = (np.array(x) for x in zip(*places, strict=True))
                whole = [embedded(self.items[i], len(self.items[i]), min(MOST_STEPS, shortest), walk) for i in members]
                windows = np.concatenate([e[:, anchors(e.shape[1])] for e in whole], axis=1)
                for steps in sampled_steps(walk, shortest):
                    hashes = signature(windows, steps)
                    order = hashes.argsort()
                    shift = np.uint64(64 - max(14, len(places).bit_length() + 5))
                    table = np.zeros(1 << 64 - int(shift), bool)
                    table[hashes >> shift] = True
                    bands.append((steps, shift, table, hashes[order], item[order], anchor[order]))

    def collisions(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All windows that share a signature with an item: the item, and where in ``words`` it would start."""
        items, starts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for first in range(0, len(words), BLOCK):
            part = words[first : first + BLOCK + self.steps]
            n = min(BLOCK, len(words) - first)
            for walk, bands in enumerate(self.bands):
                rows = embedded(part, n, self.steps, walk)
                for steps, shift, table, hashes, item, anchor in bands:
                    found = signature(rows, steps)
                    at = np.flatnonzero(table.take((found >> shift).view(np.int64)))
                    low = hashes.searchsorted(found[at])
                    high = hashes.searchsorted(found[at], "right")
                    n_each = high - low
                    if not n_each.any():
                        continue
                    entry = np.repeat(low - np.cumsum(n_each) + n_each, n_each) + np.arange(n_each.sum())
                    items.append(item[entry])
                    starts.append(first + np.repeat(at, n_each) - anchor[entry])
        # A start before a text belongs to a window inside it; the region that is checked is clipped to the text.
        both = np.unique(np.stack([np.concatenate(items), np.concatenate(starts)]), axis=1)
        return both[0], both[1]

    def found(self, texts: list[np.ndarray]) -> list[list[tuple[int | None, int, int, int]]]:
        """For each text, the places of items in it, none overlapping another of its item: id, first word, words, edits."""
        out: list[list] = [[] for _ in texts]
        words = np.concatenate([np.empty(0, np.uint64), *texts])
        ends = np.cumsum([len(t) for t in texts])
        all_items, all_starts = self.collisions(words)
        cuts = np.searchsorted(all_items, np.unique(all_items))
        for starts in np.split(all_starts, cuts[1:]) if len(cuts) else []:
            i = int(all_items[cuts[0]])
            cuts = cuts[1:]
            self._places(i, starts, words, ends, texts, out)
        return out

    def _places(self, i: int, starts: np.ndarray, words: np.ndarray, ends: np.ndarray, texts: list, out: list) -> None:
        item = self.items[i]
        n, k = len(item), allowed(len(item))
        starts = self._with_words(starts, words, item, self.sorted[i])
        # Both texts that a window near a border may belong to are tried.
        done: dict[int, int] = {}
        for start in starts.tolist():
            docs = {int(np.searchsorted(ends, min(max(0, p), len(words) - 1), "right")) for p in (start, start + n // 2, start + n - 1)}
            for d in docs:
                first = int(ends[d]) - len(texts[d])
                low, high = max(0, done.get(d, 0), start - first - k), min(len(texts[d]), start - first + n + 2 * k)
                if high - low < n - k:
                    continue
                edits, a, b = _place(item, texts[d], low, high)
                if edits > k:
                    continue
                while edits:  # what lies beside the place may fit better
                    better = _place(item, texts[d], max(0, done.get(d, 0), a - k), min(len(texts[d]), a + n + 2 * k))
                    if better[0] >= edits:
                        break
                    edits, a, b = better
                out[d].append((self.ids[i], a, b - a, edits))
                done[d] = b

    @staticmethod
    def _with_words(starts: np.ndarray, words: np.ndarray, item: np.ndarray, known: np.ndarray) -> np.ndarray:
        """The starts around which enough words of the item stand for a place with all its edits."""
        n, k = len(item), allowed(len(item))
        kept, around = [np.empty(0, np.int64)], np.arange(-k, n + 2 * k)
        of_word = known.searchsorted(item)
        for at in range(0, len(starts), 4096):
            part = starts[at : at + 4096]
            spots = part[:, None] + around
            near = words.take(spots, mode="clip")
            which = known.searchsorted(near)
            same = known.take(which, mode="clip") == near
            same &= (spots >= 0) & (spots < len(words))
            there = np.zeros((len(part), len(known)), bool)
            row, column = np.nonzero(same)
            there[row, which[row, column]] = True
            # Neither can be fewer than the words that a place leaves as they are.
            kept.append(part[(same.sum(axis=1) >= n - k) & (there[:, of_word].sum(axis=1) >= n - k)])
        return np.concatenate(kept)


def _place(item: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """The least edits of ``item`` to a run of ``text[low:high]``, and the first and the end of one with so many.

    A run that is too far from the item has no extent.
    """
    region = text[low:high]
    edits, end = infix_distance(item, region)
    if edits > allowed(len(item)):
        return edits, low, low
    _, length = infix_distance(item[::-1], region[:end][::-1])
    length = _length(item, region[:end], edits, length)
    return edits, low + end - length, low + end


def _length(item: np.ndarray, text: np.ndarray, edits: int, guess: int) -> int:
    """Words of the shortest run at the end of ``text`` with so many edits."""
    at = np.arange(len(item) + 1)
    row = at.copy()
    if row[-1] == edits:
        return 0
    reverse = item[::-1]
    for n, word in enumerate(text[::-1].tolist(), 1):
        new = np.empty_like(row)
        new[0] = n
        new[1:] = np.minimum(row[:-1] + (reverse != np.uint64(word)), row[1:] + 1)
        row = np.minimum.accumulate(new - at) + at
        if row[-1] == edits:
            return n
    return guess


def with_found(docs: DataFrame, items: DataFrame, name: str = "_found") -> DataFrame:
    """``docs`` with the items found in ``text`` in the array ``name`` (``FOUND``): all places, none overlapping another of its item.

    All other columns pass unchanged. A null or empty text holds nothing; an item without words is nowhere; items that
    repeat are all reported. Empty tables give empty tables; very long texts are embedded in blocks of windows. The items pass through the driver in blocks of ITEM_BLOCK, each a pass over the documents.
    """
    spark = docs.sparkSession
    items = items.selectExpr("CAST(item_id AS BIGINT) AS item_id", "CAST(text AS STRING) AS text")
    kind = spark.createDataFrame([], f"c {FOUND}").schema[0].dataType
    empty = pa.list_(pa.struct([("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("n_edits", pa.int64())]))
    out, part = docs.withColumn(name, F.lit(None).cast(FOUND)), []

    def searched(df: DataFrame, block: list) -> DataFrame:
        walks = walks_needed([a for _, a in block])
        shared = spark.sparkContext.broadcast((block, walks))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(*shared.value)
            for batch in batches:
                texts, before = batch.column(at).to_pylist(), batch.column(last).to_pylist()
                found = []
                for a, b in slices([t or "" for t in texts], 16_000_000):
                    found += index.found([word_hashes(t) for t in texts[a:b]])
                rows = [
                    [*(old or []), *(dict(zip(("item_id", "start_word", "n_words", "n_edits"), f, strict=True)) for f in new)]
                    for old, new in zip(before, found, strict=True)
                ]
                columns = [*batch.columns[:last], pa.array(rows, empty)]
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

        at, last = docs.columns.index("text"), len(docs.columns)
        return small_batches(df).mapInArrow(lean(task), StructType([*docs.schema.fields, StructField(name, kind)]))

    for row in items.orderBy("item_id", "text").toLocalIterator():
        words = word_hashes(row.text)
        if len(words):
            part.append((row.item_id, words))
        if len(part) == ITEM_BLOCK:
            out, part = searched(out, part), []
    return searched(out, part) if part else out


def benchmark(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op5_benchmark_decontamination(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = with_found(docs, benchmark(spark, sf_dir)).drop("text")
    return found.select("doc_id", F.inline("_found"))


def keep_unseen(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, with their own columns."""
    name = free_name(docs, "_found")
    found = with_found(docs, items, name)
    return found.filter(F.coalesce(F.size(name), F.lit(0)) <= 0).select(*docs.columns)
