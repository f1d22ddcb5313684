"""Chunks of documents that ask all documents about what they hold.

A task takes texts in chunks of bounded size and numbers the distinct keys (words, pairs of ids) of each chunk. Keys
are dealt to buckets by hash, one row for each chunk and bucket, so what is shuffled grows with the distinct keys
of chunks, not with tokens, and a key that is very frequent has one entry a chunk. A bucket sees all entries of its keys
and answers each row in its own order; the answers of a chunk, by bucket, are again in the order of its keys.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_BYTES = 8 << 20  # of text for each bucket


def zipped(values: np.ndarray) -> bytes:
    """Numbers with their first bytes, their second bytes and so on together, as the high ones are much alike."""
    values = np.ascontiguousarray(values)
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def unzipped(blob: bytes, dtype: str = "<u4") -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def zipped_keys(keys: np.ndarray) -> bytes:
    """Ascending numbers, as differences."""
    return zipped(np.diff(keys.astype("<i8"), prepend=np.int64(0)))


def unzipped_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(unzipped(blob, "<i8"))


def mixed(keys: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket for each whole number, evenly whatever the numbers are."""
    x = keys.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(buckets)).astype(np.int32)


def bucket_count(docs: DataFrame) -> int:
    """Buckets for the keys of all texts, by their bytes."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(8, -(-size // BUCKET_BYTES))


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in ascending order, the sum of ``n`` for each, and where each key stands among them."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    at = np.empty(len(keys), np.int64)
    at[order] = np.cumsum(first) - 1
    return ordered[first], np.add.reduceat(n[order].astype(np.int64), np.flatnonzero(first)) if len(keys) else n, at


def split_at(values: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    return np.split(values, np.cumsum(sizes)[:-1]) if sizes else []


def runs(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of neighbouring ``values``, ``sizes`` of them each."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def ask(parts: DataFrame, answer: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``answer`` for each bucket of ``parts``, with all its rows."""
    return parts.groupBy("bucket").applyInArrow(answer, schema)


def together(chunks: DataFrame, answers: DataFrame, finish: Callable[[dict, list[dict]], pa.Table], schema: str) -> DataFrame:
    """``finish`` for the row of each chunk and its answers, in the order of their buckets."""

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        (row,) = mine.to_pylist()
        return finish(row, sorted(theirs.to_pylist(), key=lambda r: r["bucket"]))

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)
