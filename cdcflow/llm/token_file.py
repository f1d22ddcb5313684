"""A file of token ids: frequency ranks in byte-aligned variable-length code, with separate control bytes.

Ids are replaced by their rank in the whole corpus, most frequent first, so that most take one byte. Four ranks share
a control byte with two bits for each rank's length; the control bytes and the data bytes of a block stand apart. The
file is a Parquet table of blocks in ascending order of ``doc_id``, so that any store Spark reads can hold it:

    part, block     where the block stands; parts ascend by document, blocks within a part
    part_start      ids in the part before this block
    doc_ids         the documents of the block
    n_tokens        ids of each document, its end id included
    control, data   the code of all their ids, one after the other

Beside it, under the same name with ``.ranks`` behind, stands a table of one row: the ids by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.session import scratch_dir

from .common import documents, stored
from .tokens import batch_ids, broadcast_spec, encoder, id_type, texts_of

BLOCK = "part INT, block BIGINT, part_start BIGINT, doc_ids ARRAY<BIGINT>, n_tokens ARRAY<BIGINT>, control BINARY, data BINARY"
BLOCK_IDS = 1 << 18  # a block ends with the document that reaches so many ids
# For each control byte, the lengths of its four numbers.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def coded(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    values = np.ascontiguousarray(values, "<u4")
    most = int(values.max(initial=0))
    extra = (values >= 1 << 8).astype(np.uint8)
    for bits in (16, 24):
        if most >> bits:
            extra += values >= 1 << bits
    quads = np.zeros((-(-len(values) // 4), 4), np.uint8)
    quads.reshape(-1)[: len(values)] = extra
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    wide = 2 if most < 1 << 16 else 4
    raw = values.astype(f"<u{wide}").view(np.uint8).reshape(-1, wide)
    data = raw[np.arange(wide, dtype=np.uint8) <= extra[:, None]]
    return control.tobytes(), data.tobytes()


def decoded(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``coded``."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(lengths, dtype=np.int64)
    at -= lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    values = raw[at].astype(np.uint32)
    for byte in range(1, int(lengths.max(initial=1))):
        at += 1
        values |= (raw[at] * (lengths > byte)).astype(np.uint32) << np.uint32(8 * byte)
    return values


def id_counts(rows: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs, by the counts that ``counted_ids`` left; the vocabulary bounds what comes to the driver."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for row in batch.column(0).to_pylist():
                counts += np.frombuffer(row, "<i8")
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], ["id", "n"])

    total = np.zeros(vocabulary, np.int64)
    tasks = rows.filter("counts IS NOT NULL").select("counts")
    for row in tasks.mapInArrow(summed, "id BIGINT, n BIGINT").groupBy("id").agg(F.sum("n").alias("n")).collect():
        total[row.id] = row.n
    return total


def counted_ids(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int) -> DataFrame:
    """``doc_id, ids, counts``: the ids of each document, and a row a task with how often it met each id."""
    spec = broadcast_spec(docs, tokenizer)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = encoder(spec.value, 600_000), np.zeros(vocabulary, np.int64)
        for batch in batches:
            for doc_ids, ids, ends in batch_ids(batch, own, end_id):
                counts += np.bincount(ids, minlength=vocabulary)
                offsets = (np.append(0, ends) * ids.itemsize).astype(np.int32)
                blobs = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([doc_ids, blobs, pa.nulls(len(ends), pa.binary())], ["doc_id", "ids", "counts"])
        row = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([counts.tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(row, ["doc_id", "ids", "counts"])

    return texts_of(docs).mapInArrow(task, "doc_id BIGINT, ids BINARY, counts BINARY")


def write_token_file(docs: DataFrame, tokenizer: str, end_id: int, path: str) -> np.ndarray:
    """Encode every whole text, append ``end_id``, write the blocks and the ranks to ``path``; returns the ids by rank.

    An empty table gives a file without blocks. A null text is empty. Null doc_ids come first. Rows that repeat are all written, next to each other.
    """
    from tokenizers import Tokenizer

    vocabulary = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    dtype = id_type(Tokenizer.from_file(tokenizer).get_vocab_size())
    rows = stored(counted_ids(docs, tokenizer, end_id, vocabulary), "ids")
    by_rank = np.argsort(-id_counts(rows, vocabulary), kind="stable").astype("<u4")
    ranks = np.empty(vocabulary, "<u4")
    ranks[by_rank] = np.arange(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, before = TaskContext.get().partitionId(), 0, 0
        doc_ids, texts, held = [], [], 0

        def flush() -> pa.RecordBatch:
            lengths = [len(t) // np.dtype(dtype).itemsize for t in texts]
            control, data = coded(shared.value[np.frombuffer(b"".join(texts), dtype)])
            row = {"part": part, "block": block, "part_start": before, "doc_ids": doc_ids, "n_tokens": lengths}
            row |= {"control": control, "data": data}
            return pa.RecordBatch.from_pylist([row], schema)

        schema = pa.schema(
            [("part", pa.int32()), ("block", pa.int64()), ("part_start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
             ("n_tokens", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())]
        )
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc_ids.append(doc_id)
                texts.append(text)
                held += len(text) // np.dtype(dtype).itemsize
                if held >= BLOCK_IDS:
                    yield flush()
                    block, before = block + 1, before + held
                    doc_ids, texts, held = [], [], 0
        if texts:
            yield flush()

    ids = rows.filter("ids IS NOT NULL").select("doc_id", "ids")
    # Only rows of one doc_id are ordered by their ids, by a number of them, so that a repeated task writes the same.
    ordered = ids.repartitionByRange("doc_id").withColumn("tie", F.xxhash64("ids")).sortWithinPartitions("doc_id", "tie").drop("tie")
    ordered.mapInArrow(blocks, BLOCK).write.option("compression", "none").parquet(path)
    docs.sparkSession.createDataFrame([(bytearray(by_rank.tobytes()),)], "by_rank BINARY").coalesce(1).write.parquet(f"{path}.ranks")
    return by_rank


def read_token_file(spark: SparkSession, path: str, by_rank: np.ndarray | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of a file: ``ids`` as little-endian unsigned 32-bit integers, ``start`` the
    number of ids of all documents before. Only sums by part, as many as the writing tasks, go through the driver."""
    if by_rank is None:
        by_rank = np.frombuffer(spark.read.parquet(f"{path}.ranks").first().by_rank, "<u4")
    blocks = spark.read.schema(BLOCK).parquet(path)
    sizes = blocks.groupBy("part").agg(
        F.sum(F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, n: a + n)).alias("n")
    )
    starts, total = {}, 0
    for part, n in sorted(map(tuple, sizes.collect())):
        starts[part], total = total, total + n
    shared = spark.sparkContext.broadcast((starts, by_rank))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, ids_of = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                n = np.array(row["n_tokens"], np.int64)
                ids = ids_of[decoded(row["control"], row["data"], int(n.sum()))]
                ends = np.cumsum(n)
                begin = first[row["part"]] + row["part_start"] + ends - n
                texts = [ids[b - k : b].tobytes() for k, b in zip(n.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(begin), pa.array(n), pa.array(texts, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.mapInArrow(task, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids BINARY")


END_ID = 1


def op1_token_file(spark, sf_dir):
    import public_tokenizers

    path = scratch_dir(spark, "token-file")
    write_token_file(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), END_ID, path)
    read = read_token_file(spark, path)
    return read.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
