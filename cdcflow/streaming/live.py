"""Live tables: each micro-batch adds a layer, and layers are merged while the stream runs.

A keyed table is a folder of layers. ``batch/batch_id=N`` has the rows of one micro-batch; ``merged/upto=N`` has one row
per key out of all batches up to N, deleted keys included, and ``done/upto=N`` says that it is whole. A reader takes the
newest whole merge and the batches behind it, so it reads the state and at most ``every`` batches, whatever the history.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from cdcflow.streaming.feed import barrier, rocksdb_state
from cdcflow.streaming.keyed import KeyedTable, is_logged

EVERY = 16  # micro-batches between two merges
Merge = Callable[[DataFrame], DataFrame]


def batch_writer(path: str, *derive: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that can be replayed: a batch always overwrites its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for step in derive:
            batch = step(batch)
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def rebalanced(batch: DataFrame) -> DataFrame:
    """Even out what partitions hold, so that a micro-batch leaves few and similar files."""
    return batch.hint("rebalance")


def newest_rows(keys: list[str], order: str = "kafka_offset") -> Merge:
    """A merge that keeps the whole newest row of each key."""

    def merge(rows: DataFrame) -> DataFrame:
        payload = [c for c in rows.columns if c not in keys]
        newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*payload), F.struct(order, "batch_id")).alias("_row"))
        return newest.select(*keys, "_row.*")

    return merge


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the layers under ``path``; nothing is there before the first one is written."""
    try:
        files = spark.read.parquet(path).inputFiles()
    except Exception as error:  # Spark has no way to ask whether a folder exists
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return []
        raise
    return sorted({int(n) for f in files for n in re.findall(rf"/{name}=(\d+)/", f)})


def layers(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    """The rows of the newest whole merge and of the batches behind it, with ``batch_id``; None if there is nothing.

    ``below`` leaves out that batch and all after it.
    """
    merged = [n for n in _numbers(spark, f"{path}/done", "upto") if below is None or n < below]
    upto = merged[-1] if merged else -1
    batches = [n for n in _numbers(spark, f"{path}/batch", "batch_id") if n > upto and (below is None or n < below)]
    parts = [spark.read.parquet(f"{path}/merged/upto={upto}")] if merged else []
    if batches:
        folders = [f"{path}/batch/batch_id={n}" for n in batches]
        rows = spark.read.option("basePath", f"{path}/batch").parquet(*folders)
        parts.append(rows.withColumn("batch_id", F.col("batch_id").cast("bigint")))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def merge_layers(spark: SparkSession, path: str, merge: Merge, batch_id: int, forget_after: int | None = None) -> None:
    """Write the merge up to ``batch_id``. Deleted keys keep a row, so that an older change that is read later cannot
    bring them back; ``forget_after`` drops those that no batch has touched for so many batches."""
    rows = layers(spark, path, batch_id + 1)
    if rows is None:
        return
    rows = merge(rows)
    if forget_after is not None and "deleted" in rows.columns:
        rows = rows.filter(~F.col("deleted") | (F.col("batch_id") > batch_id - forget_after))
    rows.write.mode("overwrite").parquet(f"{path}/merged/upto={batch_id}")
    spark.range(1).write.mode("overwrite").parquet(f"{path}/done/upto={batch_id}")


def covered_layers(spark: SparkSession, path: str) -> list[str]:
    """Folders that no new reader opens: batches in the newest merge, and older merges. Delete them at leisure."""
    merged = _numbers(spark, f"{path}/done", "upto")
    if not merged:
        return []
    batches = [n for n in _numbers(spark, f"{path}/batch", "batch_id") if n <= merged[-1]]
    return [f"{path}/batch/batch_id={n}" for n in batches] + [f"{path}/merged/upto={n}" for n in merged[:-1]]


def keyed_writer(
    path: str, merge: Merge, *derive: Callable[[DataFrame], DataFrame], every: int = EVERY, forget_after: int | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds a layer and merges after every so many batches."""
    add = batch_writer(f"{path}/batch", *derive, rebalanced)

    def write(batch: DataFrame, batch_id: int) -> None:
        add(batch, batch_id)
        if (batch_id + 1) % every == 0:
            merge_layers(batch.sparkSession, path, merge, batch_id, forget_after)

    return write


def read_keyed(spark: SparkSession, path: str, merge: Merge, deleted: bool = False, below: int | None = None) -> DataFrame | None:
    """One row per key of a keyed table, without deleted keys unless asked for; None before the first batch.

    Tables with a log (``keyed.KeyedTable``) are read by it.
    """
    if is_logged(spark, path):
        return KeyedTable(spark, path, [], merge).read(deleted, below=below)
    rows = layers(spark, path, below)
    if rows is None:
        return None
    rows = merge(rows)
    return rows if deleted or "deleted" not in rows.columns else rows.filter(~F.col("deleted"))


def materialize(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str] | None = None, seconds: float | None = 1.0, every: int = EVERY
) -> StreamingQuery:
    """Keep a query precomputed in ``path``: by key (update mode), or append-only without ``keys``.

    ``seconds=None`` processes what there is and stops.
    """
    write = batch_writer(path) if keys is None else keyed_writer(path, newest_rows(keys), every=every)
    with rocksdb_state(stream.sparkSession):
        return (
            stream.writeStream.outputMode("append" if keys is None else "update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(write)
            .trigger(**barrier(seconds))
            .start()
        )


def read_live(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest row per key of a materialised table, without deleted keys."""
    rows = read_keyed(spark, path, newest_rows(keys))
    if rows is None:
        raise ValueError(f"no batch has been written to {path}")
    return rows.drop("deleted", "batch_id")
