"""Jaccard self-join of documents on five-word shingles, exact up to 64-bit hashes.

Sets of shingles are hashed and their hashes dealt to buckets, where sorting finds the ones that more than one set
holds. Only a set with three quarters of its shingles shared can have a partner; shared shingles are also all that two
sets can have in common, so from here on a set is its size and the sorted array of its shared hashes.

Partners share a hash among the rarest quarter of either set (its prefix). Links are found in two rounds: first each
set against one pivot of its prefix hashes, which joins groups of near copies by as many checks as they have members;
then, in tiles of a prefix hash, only sets of different components. A tile holds blocks of sets in order of size. Of
each pair within the size band, in both rounds, bitmaps whose width follows the size bound the overlap from above, and
what passes is checked by intersecting the sorted arrays. Groups of exact copies are one set from the first step on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, lean, small_batches, spread_keys, stored
from .components import components
from .tokens import slices

SHINGLE, SHARE = 5, (3, 4)  # words a shingle; the least similarity as a fraction
FLUSH_CHARS = 16_000_000  # a task deals out its hashes each time it has read so much
BUCKETS = 4  # in a partition; a task holds one at a time
BLOCK_SETS = 4096  # sets in a block of a tile
PACKET = "key BIGINT, flush BIGINT, bucket INT, data BINARY"
SET = "kind INT, doc_id BIGINT, class BINARY, n BIGINT, shared BINARY, level BINARY"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle of all its words."""
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if 0 < len(words) < SHINGLE:
        return np.array([xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(0, len(h) - SHINGLE + 1)
    out = h[:n].copy()
    for k in range(1, SHINGLE):
        out = (out ^ (out >> np.uint64(29))) * _MIX + h[k : k + n]
    return np.unique((out ^ (out >> np.uint64(32))) * _MIX)


def _packets(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "flush", "bucket", "data"]
    )


def _closed(owner: np.ndarray, values: np.ndarray, sets: int) -> bytes:
    """A packet of hashes in order of their owners: the owners' counts, of all sets or of those that have some,
    whichever is shorter, and the hashes."""
    counts = np.bincount(owner, minlength=sets)
    named = np.flatnonzero(counts)
    wide = 1 if counts.max() < 256 else 4
    listed = len(named) * (4 + wide) < sets * wide
    head = np.array([len(named) if listed else sets, wide, listed], "<u4").tobytes()
    owners = named.astype("<u4").tobytes() if listed else b""
    return head + owners + (counts[named] if listed else counts).astype(f"<u{wide}").tobytes() + values.astype("<u8").tobytes()


def _opened(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Owners and hashes of a packet."""
    sets, wide, listed = np.frombuffer(data, "<u4", 3).tolist()
    at = 12 + 4 * sets * listed
    owners = np.frombuffer(data, "<u4", sets, 12) if listed else np.arange(sets, dtype=np.uint32)
    counts = np.frombuffer(data, f"<u{wide}", sets, at)
    return np.repeat(owners, counts), np.frombuffer(data, "<u8", -1, at + wide * sets)


def _deal(keys: list[int]):
    """Texts to packets: a packet for each flush and bucket has the sets' counts there and their hashes; the flush's own
    packet (bucket -1) has documents, set ids and sizes."""
    buckets = BUCKETS * len(keys)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        from pyspark import TaskContext
        from xxhash import xxh3_128_digest

        flush, held = TaskContext.get().partitionId() << 32, 0
        docs: list[tuple] = []
        sets: dict[bytes, int] = {}
        hashes: list[np.ndarray] = []

        def packets() -> list[tuple]:
            sizes = np.array([len(h) for h in hashes], "<u4")
            own = (docs, list(sets), sizes.tobytes())
            own_key = keys[((flush >> 32) + (flush & 0xFFFFFFFF)) % len(keys)]
            rows = [(own_key, flush, -1, pickle.dumps(own))]
            every = np.concatenate([np.empty(0, np.uint64), *hashes])
            owner = np.repeat(np.arange(len(hashes), dtype=np.uint32), sizes)
            bucket = ((every >> np.uint64(40)) % np.uint64(buckets)).astype(np.uint32)
            order = np.argsort(bucket, kind="stable")
            ends = np.cumsum(np.bincount(bucket, minlength=buckets))
            for b, (start, end) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
                if start < end:
                    part = order[start:end]
                    rows.append((keys[b % len(keys)], flush, b, _closed(owner[part], every[part], len(hashes))))
            return rows

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = shingle_hashes(text)
                name = xxh3_128_digest(found.tobytes())
                if len(found) and name not in sets:
                    sets[name] = len(hashes)
                    hashes.append(found)
                docs.append((doc_id, name if len(found) else None, len(found)))
                held += len(text or "")
                if held >= FLUSH_CHARS:
                    yield _packets(packets())
                    flush, held, docs, sets, hashes = flush + 1, 0, [], {}, []
        if docs:
            yield _packets(packets())

    return task


def _share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packets in order of buckets to packets of the hashes that several sets hold, with the level of their number."""

    def bucket(held: list[dict]) -> pa.RecordBatch:
        opened = [_opened(row["data"]) for row in held]
        which = np.repeat(np.arange(len(held), dtype=np.uint32), [len(h) for _, h in opened])
        owner, every = np.concatenate([o for o, _ in opened]), np.concatenate([h for _, h in opened])
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        n = np.diff(np.append(starts, len(ranked)))
        level = np.empty(len(every), np.uint8)
        level[order] = np.repeat(np.minimum(255, 4 * np.log2(n)).astype(np.uint8), n)
        rows = []
        for i in np.unique(which[level > 0]).tolist():
            at = np.flatnonzero((which == i) & (level > 0))
            data = np.array([len(at)], "<u4").tobytes() + owner[at].astype("<u4").tobytes() + level[at].tobytes()
            rows.append((held[i]["flush"], held[i]["flush"], held[i]["bucket"], data + every[at].astype("<u8").tobytes()))
        return _packets(rows)

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] < 0:
                yield _packets([(row["flush"], row["flush"], -1, row["data"])])
                continue
            if held and held[0]["bucket"] != row["bucket"]:
                yield bucket(held)
                held = []
            held.append(row)
    if held:
        yield bucket(held)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packets in order of flushes to ``SET`` rows: kind 0 a document, kind 1 a set that can have partners."""
    import pickle

    names = ["kind", "doc_id", "class", "n", "shared", "level"]
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary())

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def flush(own: tuple, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        docs, sets, sizes = own
        yield table([(0, doc_id, name, n, None, None) for doc_id, name, n in docs])
        n = np.frombuffer(sizes, "<u4").astype(np.int64)
        if not parts:
            return
        owner, level, value = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((value, owner))
        owner, level, value = owner[order], level[order], value[order]
        ends = np.cumsum(np.bincount(owner, minlength=len(n)))
        shared = np.diff(ends, prepend=0)
        able = np.flatnonzero((SHARE[1] * shared >= SHARE[0] * n) & (n > 0)).tolist()
        for at in range(0, len(able), 2000):
            yield table(
                [(1, None, sets[i], int(n[i]), value[ends[i] - shared[i] : ends[i]].tobytes(), level[ends[i] - shared[i] : ends[i]].tobytes())
                 for i in able[at : at + 2000]]
            )

    own, current, parts = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] < 0:
                if own:
                    yield from flush(own, parts)
                own, current, parts = pickle.loads(row["data"]), row["flush"], []
                continue
            assert row["flush"] == current
            raw = np.frombuffer(row["data"], np.uint8)
            k = int(raw[:4].view("<u4")[0])
            value = np.frombuffer(row["data"], "<u8", k, 4 + 5 * k)
            parts.append((np.frombuffer(row["data"], "<u4", k, 4), raw[4 + 4 * k : 4 + 5 * k], value))
    if own:
        yield from flush(own, parts)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``SET`` rows of the documents, stored."""
    spark = docs.sparkSession
    keys = spread_keys(spark)
    dealt = small_batches(docs).selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(lean(_deal(keys)), PACKET)
    by_bucket = dealt.repartition(len(keys), "key").sortWithinPartitions("bucket", "flush")
    by_flush = by_bucket.mapInArrow(lean(_share), PACKET).repartition(len(keys), "key").sortWithinPartitions("flush", "bucket")
    return stored(by_flush.mapInArrow(lean(_gather), SET), "sets")


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets to a row for each shared hash of their prefix: all shingles in order of level and hash, up to the place
    behind which too few are left for a partner that holds none of these. ``rest`` counts the set's shingles from this
    one on; ``centre`` is the mean level, highest for the text that near copies were made from."""
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(4)]
        tokens, of, rests, centres = [], [], [], []
        for i, (n, shared, level) in enumerate(zip(*columns[1:], strict=True)):
            value, level = np.frombuffer(shared, "<u8"), np.frombuffer(level, np.uint8)
            length = n - -(-SHARE[0] * n // SHARE[1]) + 1
            keep = value[np.lexsort((value, level))][: max(0, length - (n - len(value)))]
            tokens.append(keep)
            of.append(np.full(len(keep), i))
            rests.append(len(value) - np.arange(len(keep)))
            centres.append(np.full(len(keep), int(level.sum()) * 1000 // n))
        at, rest, centre = (np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64) for x in (of, rests, centres))
        token = np.concatenate([np.empty(0, np.uint64), *tokens]).astype(np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(token), batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(rest), pa.array(centre)],
            ["token", "class", "n", "rest", "centre"],
        )


def in_band(a, b):
    """Sizes that allow the least similarity."""
    return (SHARE[1] * a >= SHARE[0] * b) & (SHARE[1] * b >= SHARE[0] * a)


def similar(n_a, n_b, overlap):
    """Whether so large an overlap reaches the least similarity."""
    return overlap * (SHARE[0] + SHARE[1]) >= SHARE[0] * (n_a + n_b)


def _verify(bounded: bool):
    """Pairs with both arrays to the pairs that link; bitmaps have to allow it first, unless they did before."""

    def allowed(n_a: int, n_b: int, a: np.ndarray, b: np.ndarray) -> bool:
        x, y = bitmap(a, n_a), bitmap(b, n_b)
        words = min(len(x), len(y))
        differ = int(np.bitwise_count(_folded(x, words) ^ _folded(y, words)).sum(dtype=np.int64))
        return bool(similar(n_a, n_b, min(len(a), len(b), (len(a) + len(b) - differ) // 2)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            rows = zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)
            for n_a, n_b, raw_a, raw_b in rows:
                a, b = np.frombuffer(raw_a, "<u8"), np.frombuffer(raw_b, "<u8")
                may = bounded or allowed(n_a, n_b, a, b)
                keep.append(may and bool(similar(n_a, n_b, len(np.intersect1d(a, b, assume_unique=True)))))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(mask) for i in range(2)], ["a", "b"])

    return task


def verified(pairs: DataFrame, sets: DataFrame, bounded: bool = False) -> DataFrame:
    side = {s: sets.select(*(F.col(c).alias(f"{c}_{s}") for c in ("class", "n", "shared"))) for s in "ab"}
    both = pairs.join(side["a"], pairs.a == F.col("class_a")).join(side["b"], pairs.b == F.col("class_b"))
    return both.select("a", "b", "n_a", "n_b", "shared_a", "shared_b").mapInArrow(lean(_verify(bounded)), "a BINARY, b BINARY")


def _width(n: int) -> int:
    """Bits of the bitmap of a set of ``n``: the band of its size. With eight bits a member few members share one."""
    return max(64, min(1 << 16, 4 << int(n).bit_length()))


def bitmap(values: np.ndarray, n: int) -> np.ndarray:
    bits = np.zeros(_width(n), np.uint8)
    bits[((values * _MIX) >> np.uint64(40)) % np.uint64(len(bits))] = 1
    return np.packbits(bits).view(np.uint64)


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap, or rows of them, as the one of a smaller width."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of tiles, in order, to the pairs that sizes and bitmaps cannot rule out."""

    def tile(held: list[dict]) -> pa.RecordBatch:
        held.sort(key=lambda r: r["n"])
        n = np.array([r["n"] for r in held])
        shared = np.array([r["s"] for r in held])
        rest = np.array([r["rest"] for r in held])
        label = np.unique(np.array([r["label"].hex() for r in held]), return_inverse=True)[1]
        block = np.array([r["block"] for r in held])
        low, high = held[0]["low"], held[0]["high"]
        maps = [np.frombuffer(r["bits"], np.uint64) for r in held]
        width = np.array([len(m) for m in maps])
        by_width = {w: (np.flatnonzero(width == w), np.stack([m for m in maps if len(m) == w])) for w in np.unique(width).tolist()}
        a, b = [], []
        for i in np.flatnonzero(block == low).tolist():
            for w, (at, rows) in by_width.items():
                ok = in_band(n[i], n[at]) & (label[at] != label[i]) & (block[at] == high)
                if low == high:
                    ok &= at > i
                at, rows = at[ok], rows[ok]
                if not len(at):
                    continue
                words = min(w, len(maps[i]))
                differ = np.bitwise_count(_folded(rows, words) ^ _folded(maps[i], words)).sum(axis=1, dtype=np.int64)
                most = np.minimum(np.minimum(shared[at], shared[i]), (shared[at] + shared[i] - differ) // 2)
                # Where this is the first hash that both hold, they share no more than what comes from it on; where it
                # is not, the tile of the first one has the pair.
                most = np.minimum(most, np.minimum(rest[at], rest[i]))
                found = at[similar(n[i], n[at], most)]
                a += [held[i]["class"]] * len(found)
                b += [held[j]["class"] for j in found.tolist()]
        pairs = {(min(x, y), max(x, y)) for x, y in zip(a, b, strict=True)}
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], ["a", "b"])

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(held[0][k] != row[k] for k in ("token", "low", "high")):
                yield tile(held)
                held = []
            held.append(row)
    if held:
        yield tile(held)


def _with_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, shared = batch.column(1).to_pylist(), [np.frombuffer(x, "<u8") for x in batch.column(2).to_pylist()]
        bits = [bitmap(x, k).tobytes() for x, k in zip(shared, n, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(x) for x in shared], pa.int64()), pa.array(bits, pa.binary())], ["class", "s", "bits"]
        )


def links(sets: DataFrame) -> DataFrame:
    """Links (``a, b``) between distinct sets that join all that the least similarity joins."""
    prefixes = sets.select("class", "n", "shared", "level").mapInArrow(lean(_prefixes), "token BIGINT, class BINARY, n BIGINT, rest BIGINT, centre BIGINT")
    prefixes = stored(prefixes, "prefixes")
    pivots = prefixes.groupBy("token").agg(F.max(F.struct("centre", "class", "n")).alias("p"), F.count("*").alias("members"))
    pivots = pivots.filter("members > 1").select("token", F.col("p.class").alias("a"), F.col("p.n").alias("n_a"))
    near = (
        prefixes.join(pivots, "token")
        .filter((F.col("class") != F.col("a")) & in_band(F.col("n"), F.col("n_a")))
        .groupBy("class", "a").count()
        .groupBy("class").agg(F.max(F.struct("count", "a")).alias("best"))
    )
    first = stored(verified(near.select(F.col("best.a").alias("a"), F.col("class").alias("b")), sets), "links")
    found = components(first)
    labelled = (
        prefixes.join(found, F.col("class") == F.col("node"), "left")
        .withColumn("label", F.coalesce("label", "class"))
        .drop("node")
    )
    mixed = (
        labelled.groupBy("token", "label").agg(F.count("*").alias("k"))
        .groupBy("token").agg(F.max(F.struct("k", "label")).alias("major"), F.sum("k").alias("members"), F.count("*").alias("labels"))
        .filter("labels > 1")
        .select("token", F.col("major.label").alias("major"), F.col("major.k").alias("k"), "members")
        .withColumn("minors", F.ceil((F.col("members") - F.col("k")) / BLOCK_SETS))
        .withColumn("blocks", F.col("minors") + F.ceil(F.col("k") / BLOCK_SETS))
    )
    deal = F.xxhash64("class")
    placed = (
        labelled.join(mixed, "token")
        .withColumn("is_major", F.col("label") == F.col("major"))
        .withColumn(
            "block",
            F.when(F.col("is_major"), F.col("minors") + F.pmod(deal, F.col("blocks") - F.col("minors")))
            .otherwise(F.pmod(deal, F.col("minors"))),
        )
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.when(F.col("is_major"), F.col("minors")).otherwise(F.col("blocks")) - 1)))
        .select("token", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "class", "label", "n", "rest")
    )
    maps = sets.select("class", "n", "shared").mapInArrow(lean(_with_bits), "class BINARY, s BIGINT, bits BINARY")
    order = ["token", "low", "high"]
    tiles = placed.join(maps, "class").repartition(*order).sortWithinPartitions(*order, "class")
    second = verified(tiles.mapInArrow(lean(_tiles), "a BINARY, b BINARY").distinct(), sets, bounded=True)
    return first.union(second)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach. A null, empty or blank text has no shingles and no links.
    Rows that repeat are copies of each other. Other columns are left out. A null doc_id links like any other but is no
    one's smallest unless there is none else. No rows give no rows.
    """
    rows = shingle_sets(docs)
    sets = stored(rows.filter("kind = 1").select("class", "n", "shared", "level").dropDuplicates(["class"]), "distinct")
    labels = components(links(sets))
    members = rows.filter("kind = 0").select("doc_id", "class", F.col("n").alias("n_shingles"))
    alone = members.filter("class IS NULL").withColumn("component_id", F.col("doc_id")).drop("class")
    members = members.filter("class IS NOT NULL")
    classes = members.groupBy("class").agg(F.min("doc_id").alias("least"))
    grouped = classes.join(labels, F.col("class") == F.col("node"), "left").withColumn("label", F.coalesce("label", "class"))
    least = grouped.groupBy("label").agg(F.min("least").alias("component_id"))
    whole = members.join(grouped.join(least, "label").select("class", "component_id"), "class")
    return whole.select("doc_id", "n_shingles", "component_id").union(alone.select("doc_id", "n_shingles", "component_id"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document, the one of smallest doc_id, of each group that links join; of rows that repeat doc_id and text,
    one. Rows without a doc_id cannot be told apart and stay."""
    found = near_duplicates(docs).filter("component_id < doc_id").select("doc_id").distinct()
    kept = docs.join(found, "doc_id", "left_anti")
    again = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, "doc_id", "left_anti").unionByName(once)
