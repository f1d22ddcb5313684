"""Best-fit packing of documents into sequences of bounded length, after a dominance reduction.

Only lengths matter, and they are whole numbers from 1 to the capacity, so the whole instance is a histogram of at
most ``capacity`` counts, whatever the number of documents. The reduction of Martello and Toth and the best fit run on
that histogram and handle all equal bins at once. Their plan says, for each length, which ranks go to which sequence
at which offset; Spark numbers the pieces of each length and looks their places up.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, lean, stored
from .tokens import batch_ids, broadcast_spec, encoder, forget_encoders, texts_of

PIECE = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids BINARY"
# Ranks are counted in groups of about so many pieces, so that a very common length is no single task.
GROUP = 20_000
CHARS, REMEMBER = 4_000_000, 400_000


def cut(size: int, capacity: int) -> list[tuple[int, int]]:
    """Where the pieces of a document begin and end: whole if it fits, else ``capacity`` ids each behind a first,
    possibly shorter one."""
    ends = list(range((size - 1) % capacity + 1, size + 1, capacity))
    return list(zip([0, *ends], ends, strict=False))


def document_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, chars: int = CHARS, remember: int = REMEMBER, keep: bool = True
) -> DataFrame:
    """``PIECE`` rows of the whole texts, ``end_id`` behind each; ``ids`` are little-endian unsigned 32-bit integers.

    A null or empty text is the end id alone. A worker encodes about ``chars`` characters at once and remembers the ids of
    up to twice ``remember`` pieces of texts; less of both takes less memory and more time. Unless it is to ``keep`` them for
    its next task, it lets them go behind each.
    """
    spec = broadcast_spec(docs, tokenizer)
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(spec.value, remember)
        for batch in batches:
            for doc_ids, ids, ends in batch_ids(batch, own, end_id, chars):
                ids, rows = ids.astype("<u4"), []
                for doc_id, first, end in zip(doc_ids.to_pylist(), [0, *ends.tolist()], ends.tolist(), strict=False):
                    pieces = cut(end - first, capacity)
                    rows += [(doc_id, n, a, b - a, ids[first + a : first + b].tobytes()) for n, (a, b) in enumerate(pieces)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["doc_id", "piece", "start", "length", "ids"],
                )
        if not keep:
            del own
            forget_encoders()

    return texts_of(docs).mapInArrow(lean(task), PIECE)


class _Sizes:
    """A multiset of lengths."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: n for s, n in counts.items() if n > 0}
        self.order = sorted(self.count)

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            del self.order[bisect_left(self.order, size)]

    def put(self, size: int, n: int = 1) -> None:
        if size not in self.count:
            insort(self.order, size)
        self.count[size] = self.count.get(size, 0) + n

    def smallest(self, n: int, above: int = 0, below: int | None = None) -> list[int]:
        """The ``n`` smallest members (or fewer) between two sizes, both left out."""
        found: list[int] = []
        for size in self.order[bisect_right(self.order, above) :]:
            if len(found) >= n or (below is not None and size >= below):
                break
            found += [size] * min(self.count[size], n - len(found))
        return found

    def largest_to(self, room: int) -> int | None:
        at = bisect_right(self.order, room)
        return self.order[at - 1] if at else None

    def best_pair(self, room: int) -> tuple[int, int] | None:
        """The pair with the greatest sum that fits, larger first."""
        best, low, high = None, 0, len(self.order) - 1
        while low <= high:
            a, b = self.order[high], self.order[low]
            if a + b > room or (low == high and self.count[a] < 2):
                high -= 1
                continue
            if best is None or a + b > sum(best):
                best = (a, b)
            low += 1
        return best


def dominating(sizes: _Sizes, j: int, capacity: int) -> tuple[int, ...] | None:
    """A set with ``j`` that dominates every feasible set with ``j``, or None if these rules show none.

    ``sizes`` is without this ``j``. A set dominates another if the other's members can be laid into its places. If
    nothing else fits, ``j`` stands alone. If one more fits at most, or some size fills the bin exactly, the largest
    that fits takes every place the others could. If two fit at most, that size wins if it is no less than the best
    pair; the best pair wins if it holds that size and no pair lies strictly between its two.
    """
    room = capacity - j
    best = sizes.largest_to(room)
    if best is None:
        return (j,)
    low = sizes.smallest(3)
    if len(low) < 2 or low[0] + low[1] > room or best == room:
        return (j, best)
    if len(low) < 3 or sum(low) > room:
        a, b = sizes.best_pair(room)
        if best >= a + b:
            return (j, best)
        between = sizes.smallest(2, b, a)
        if a == best and (len(between) < 2 or sum(between) > room):
            return (j, a, b)
    return None


def reduced(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Bins that the dominance rules fix, as (lengths, how many), and the counts that are left."""
    sizes, fixed, again = _Sizes(counts), [], True
    while again:
        again = False
        for j in reversed(list(sizes.order)):
            while j in sizes.count:
                sizes.take(j, 1)
                found = dominating(sizes, j, capacity)
                sizes.put(j)
                if found is None:
                    break
                # What holds for one bin holds for the next equal one: taking members away weakens no rule.
                times = min(sizes.count[s] // found.count(s) for s in found)
                for s in set(found):
                    sizes.take(s, times * found.count(s))
                fixed.append((found, times))
                again = True
    return fixed, dict(sizes.count)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best fit of the lengths, longest first: groups of equal bins as ([(length, copies)...], how many).

    A bin that best fit has just filled is the fullest one that still has room, so it goes on there: a length fills
    one group of equal bins after the other, with as many copies a bin as fit.
    """
    groups: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    rooms: list[int] = []

    def put(room: int, held: list[tuple[int, int]], n: int) -> None:
        if n:
            if room not in groups:
                insort(rooms, room)
            groups.setdefault(room, []).append((held, n))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                room, held, bins = capacity, [], -(-left // (capacity // size))
            else:
                room = rooms[at]
                held, bins = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            copies = room // size
            full = min(bins, left // copies)
            put(room - copies * size, [*held, (size, copies)], full)
            left -= full * copies
            part = left if full < bins else 0
            if part:
                put(room - part * size, [*held, (size, part)], 1)
                left = 0
            put(room, held, bins - full - bool(part))
    return [group for room in rooms for group in groups[room]]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places as (length, first rank, ranks, copies a sequence, first sequence, offset)."""
    fixed, rest = reduced(counts, capacity)
    bins = [([(s, 1) for s in sizes], n) for sizes, n in fixed] + best_fit(rest, capacity)
    places, used, sequence = [], dict.fromkeys(counts, 0), 0
    for held, n in bins:
        offset = 0
        for size, copies in held:
            places.append((size, used[size], n * copies, copies, sequence, offset))
            used[size] += n * copies
            offset += size * copies
        sequence += n
    return places


def packed(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (``doc_id, piece, length`` and any others) with ``sequence_id`` and ``offset``.

    Every piece gets one place; places in a sequence follow each other without gaps from 0. Lengths must lie from 1 to
    ``capacity``. Rows that repeat are places of their own. No pieces give no rows. What goes through the driver are
    the counts by length, ``capacity`` numbers at most, and the places planned for them.
    """
    spark = pieces.sparkSession
    pieces = stored(pieces, "pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    if any(not 1 <= size <= capacity for size in counts):
        raise ValueError("a length is outside 1 to the capacity")
    groups = 1 + sum(counts.values()) // GROUP
    grouped = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    keys = ["length", "_group"]
    before = (
        grouped.groupBy(*keys).count()
        .withColumn("_before", F.sum("count").over(Window.partitionBy("length").orderBy("_group")) - F.col("count"))
        .drop("count")
    )
    ranked = (
        grouped.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id", "piece")) - 1)
        .join(before, keys)
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
        .drop("_before", "_group")
    )
    places = spark.createDataFrame(
        plan(counts, capacity), "length BIGINT, _first BIGINT, _n BIGINT, _copies BIGINT, _sequence BIGINT, _offset BIGINT"
    )
    nth = F.col("_rank") - F.col("_first")
    return (
        ranked.join(F.broadcast(places), "length")
        .filter((nth >= 0) & (nth < F.col("_n")))
        .withColumn("sequence_id", F.col("_sequence") + F.floor(nth / F.col("_copies")))
        .withColumn("offset", F.col("_offset") + nth % F.col("_copies") * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


CAPACITY, END_ID = 2048, 0


def pack_documents(
    docs: DataFrame, tokenizer: str, chars: int = CHARS, remember: int = REMEMBER, keep: bool = True
) -> DataFrame:
    """Pieces of ``docs`` with their places in sequences of ``CAPACITY`` tokens; of the ids, their CRC-32."""
    pieces = document_pieces(docs, tokenizer, END_ID, CAPACITY, chars, remember, keep)
    return packed(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), CAPACITY)


def op10_best_fit_packing(spark, sf_dir):
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
