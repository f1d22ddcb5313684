"""What the two removals of repeated substrings share: windows travel to buckets by minimiser, spans come back.

A window's minimiser is its part of smallest hash, the leftmost of equals, so equal windows have equal minimisers at
equal places. Windows side by side that share one minimiser (a run) travel as one packed string to the minimiser's
bucket. Spans of removed windows come back by document, and meet its text in one join.

A passage that very many documents hold would send the windows around its ends, different in each document, to a few
buckets. So parts that many documents have rank behind all others: such a window then goes by what stands next to the
passage. Windows wholly inside the passage are equal, and a task sends each once. Which parts are common is estimated
on a sample; it decides where windows meet, never which are found.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, spread_keys, stored

PACKET = "key BIGINT, bucket INT, data BINARY"
SPANS = "doc_id BIGINT, mark BIGINT, spans BINARY"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 28) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


SAMPLE, COMMON = 50_000, 0.01  # documents looked at for common parts, and the share of them that makes a part common


def ranked(hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Hashes that sort the parts in ``common`` (sorted) behind the others."""
    late = np.zeros(len(hashes), bool)
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        late = common[at] == hashes
    return (hashes >> np.uint64(1)) | (late.astype(np.uint64) << np.uint64(63))


def common_parts(docs: DataFrame, parts: Callable[[str], np.ndarray]) -> np.ndarray:
    """The hashes of parts that a share COMMON of the documents has, sorted, by a sample of ``marked`` documents.

    With p parts in the mean document there are at most p / COMMON of them, whatever the number of documents.
    """
    total = docs.count()
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "mark"), F.lit(1 << 20)) < max(1, round((1 << 20) * SAMPLE / max(SAMPLE, total))))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n, held = [], 0, 0

        def counts() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate([np.empty(0, np.uint64), *found]), return_counts=True)
            often = times >= max(2, COMMON * n / 2)
            values, times = np.append(values[often].view(np.int64), 0), np.append(times[often], n)
            whole = np.append(np.zeros(len(values) - 1, bool), True)  # the last row counts the documents
            return pa.RecordBatch.from_arrays([pa.array(values), pa.array(times.astype(np.int64)), pa.array(whole)], ["part", "n", "whole"])

        for batch in batches:
            for text in batch.column(2).to_pylist():
                found.append(np.unique(parts(text)))
                n, held = n + 1, held + len(found[-1])
                if held > 8_000_000:
                    yield counts()
                    found, n, held = [], 0, 0
        if n:
            yield counts()

    rows = sample.mapInArrow(task, "part BIGINT, n BIGINT, whole BOOLEAN").groupBy("part", "whole").agg(F.sum("n").alias("n"))
    rows = stored(rows, "parts")
    looked = rows.filter("whole").agg(F.sum("n")).head()[0] or 0
    often = rows.filter((F.col("n") >= max(20, COMMON * looked)) & ~F.col("whole")).select("part").collect()
    return np.sort(np.array([r.part for r in often], np.int64).view(np.uint64))


def minimisers(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, the place of its smallest, the leftmost of equals (36 bits are compared)."""
    if len(hashes) > int(_PLACE):
        raise ValueError("a batch is too long")
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: reach - width], least[width - reach :])
    return (least & _PLACE).astype(np.int64)


def runs(places: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each run of whole windows with one minimiser."""
    at = np.flatnonzero(whole)
    if not len(at):
        return at, at
    new = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(places[at]) != 0)])
    first = np.flatnonzero(new)
    return at[first], at[np.append(first[1:], len(at)) - 1]


def packed(strings: list[bytes], columns: dict[str, np.ndarray]) -> bytes:
    """One packet of strings with the columns that describe them."""
    import zstandard

    sizes = np.fromiter(map(len, strings), np.uint32, len(strings))
    raw = pickle.dumps((sizes, columns, b"".join(strings)), protocol=5)
    return zstandard.ZstdCompressor(level=5).compress(raw)


def unpacked(data: bytes) -> tuple[list[bytes], dict[str, np.ndarray]]:
    import zstandard

    sizes, columns, raw = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
    ends = np.cumsum(sizes, dtype=np.int64).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], columns


def packets(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.binary()), strict=True)], ["key", "bucket", "data"]
    )


def spans_of(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """``SPANS`` rows from columns ``doc, mark, first, last`` of windows: one row for each document."""
    doc, mark = columns["doc"], columns["mark"]
    order = np.lexsort((columns["first"], mark, doc))
    doc, mark = doc[order], mark[order]
    pairs = np.stack([columns["first"][order], columns["last"][order]], axis=1).astype("<i4")
    cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(mark) != 0)) + 1
    starts, ends = np.append(0, cuts)[: len(doc)], np.append(cuts, len(doc))[: max(1, len(doc))]
    blobs = [pairs[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=False)] if len(doc) else []
    # The least number stands for a null doc_id.
    ids = pa.array(doc[starts], mask=doc[starts] == np.iinfo(np.int64).min)
    return pa.RecordBatch.from_arrays([ids, pa.array(mark[starts], pa.int64()), pa.array(blobs, pa.binary())], ["doc_id", "mark", "spans"])


def marked(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, text``: the mark is 64 bits of hash of the text, so that rows of one doc_id stay apart by text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def dealt(docs: DataFrame, deal: Callable, solve: Callable, parts: Callable[[str], np.ndarray]) -> DataFrame:
    """``SPANS`` of ``marked`` documents, by the buckets of their runs. ``parts`` are the hashes of a text's parts.

    ``deal(keys, common)`` turns batches of documents to ``PACKET`` rows: spans already known (bucket -1, pickled columns) and
    packets of runs. ``solve`` turns all packets of one bucket to columns of spans.
    """
    keys = spread_keys(docs.sparkSession)
    common = docs.sparkSession.sparkContext.broadcast(common_parts(docs, parts))

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] < 0:
                    yield spans_of(pickle.loads(row["data"]))
                    continue
                if held and held[0]["bucket"] != row["bucket"]:
                    yield spans_of(solve([r["data"] for r in held]))
                    held = []
                held.append(row)
        if held:
            yield spans_of(solve([r["data"] for r in held]))

    packed_rows = docs.mapInArrow(deal(keys, common), PACKET).repartition(len(keys), "key").sortWithinPartitions("bucket")
    return packed_rows.mapInArrow(solved, SPANS)


def applied(docs: DataFrame, spans: DataFrame, cut: Callable[[str, np.ndarray], tuple], schema: str) -> DataFrame:
    """``doc_id`` and what ``cut`` makes of each text and its spans (pairs of first and last window)."""
    spans = spans.groupBy("doc_id", "mark").agg(F.collect_list("spans").alias("spans"))
    right = spans.select(F.col("doc_id").alias("_d"), F.col("mark").alias("_m"), "spans").hint("shuffle_hash")
    joined = docs.join(right, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m")), "left")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(1), batch.column(2)
            rows = []
            for text, blobs in zip(texts, lists, strict=True):
                raw = b"".join(blobs.as_py() or ())
                rows.append(cut(text.as_py(), np.frombuffer(raw, "<i4").reshape(-1, 2)))
            columns = list(zip(*rows, strict=True))
            if columns:
                kinds = [pa.string() if isinstance(c[0], str) else pa.int64() for c in columns]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    names = ["doc_id", *(c.split()[0] for c in schema.split(", "))]
    return joined.select("doc_id", "text", "spans").mapInArrow(task, f"doc_id BIGINT, {schema}")


def covered(size: int, spans: np.ndarray, width: int) -> np.ndarray:
    """Which of ``size`` items the windows of the spans cover."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, spans[:, 0], 1)
    np.add.at(change, spans[:, 1] + width, -1)
    return np.cumsum(change[:-1]) > 0
