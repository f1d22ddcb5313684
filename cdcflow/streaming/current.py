"""Live current state and its live flattening.

Two ways to keep the state. ``upsert_stream`` has no state store: each micro-batch adds its newest image per key to
a keyed table. It is the one for large states. ``current_state_stream`` keeps the images in the state store and reports
each changed key, for consumers that follow the stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from cdcflow.functions.records import has_tags
from cdcflow.operators.flatten import flatten_events, flatten_wide
from cdcflow.operators.state import latest_images, newest_images
from cdcflow.streaming.feed import barrier
from cdcflow.streaming.live import EVERY, batch_writer, keyed_writer, newest_rows, read_keyed

# A lookup, or a function that reads it anew, so that names added meanwhile reach a running stream.
Lookup = DataFrame | Callable[[SparkSession], DataFrame]


def lookup_now(spark: SparkSession, lookup: Lookup) -> DataFrame:
    return lookup(spark) if callable(lookup) else lookup


def current_state_stream(changes: DataFrame) -> DataFrame:
    """``recid, xmlrecord, kafka_offset, deleted`` for each key a micro-batch touched (update mode).

    The aggregation of the batch form, kept as state: it combines before the shuffle, so a key with very many
    changes in one micro-batch costs one row per task. A deleted key keeps a payload-free entry, which lets
    a delete win over older changes that are read later.
    """
    return latest_images(changes).drop("known")


def _each_batch(changes: DataFrame, write: Callable, checkpoint: str, seconds: float | None) -> StreamingQuery:
    stream = changes.writeStream.option("checkpointLocation", checkpoint)
    return stream.foreachBatch(write).trigger(**barrier(seconds)).start()


def upsert_stream(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    seconds: float | None = 1.0,
    every: int = EVERY,
    forget_after: int | None = None,
) -> StreamingQuery:
    """Keep the current state as a keyed table of images; read it with ``read_state``."""
    write = keyed_writer(path, newest_images, latest_images, every=every, forget_after=forget_after)
    return _each_batch(changes, write, checkpoint, seconds)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The current state out of an upsert table: ``recid, xmlrecord, kafka_offset``."""
    rows = read_keyed(spark, path, newest_images)
    if rows is None:
        raise ValueError(f"no batch has been written to {path}")
    return rows.select("recid", "xmlrecord", "kafka_offset")


def flatten_stream(
    changes: DataFrame,
    lookup: Lookup,
    columns: Sequence[str],
    path: str,
    checkpoint: str,
    seconds: float | None = 1.0,
    every: int = EVERY,
) -> StreamingQuery:
    """Keep the wide rows of the live state as a keyed table; read it with ``read_wide``.

    A row is flattened from the newest payload alone, so values of an older version never stay. Deletes are
    passed on, and so are records that lost all their elements: both take the wide row away. A key whose changes all
    left the payload as it was keeps its row. The lookup is joined in each micro-batch, whatever its size.
    """

    def widen(batch: DataFrame) -> DataFrame:
        images = latest_images(batch).filter(F.col("known"))
        state = images.select("recid", "kafka_offset", "xmlrecord", (F.col("deleted") | ~has_tags(F.col("xmlrecord"))).alias("deleted"))
        wide = flatten_wide(state, lookup_now(batch.sparkSession, lookup), columns, ["recid", "kafka_offset", "deleted"])
        gone = state.filter(F.col("deleted")).select("recid", "kafka_offset", "deleted")
        return wide.filter(~F.col("deleted")).unionByName(gone, allowMissingColumns=True)

    return _each_batch(changes, keyed_writer(path, newest_rows(["recid"]), widen, every=every), checkpoint, seconds)


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    """The live wide rows: ``recid, kafka_offset`` and the columns."""
    rows = read_keyed(spark, path, newest_rows(["recid"]))
    if rows is None:
        raise ValueError(f"no batch has been written to {path}")
    return rows.drop("deleted", "batch_id")


def flatten_events_stream(
    changes: DataFrame, lookup: Lookup, path: str, checkpoint: str, seconds: float | None = 1.0
) -> StreamingQuery:
    """Append ``columns_parsed`` of each change to a table."""

    def counted(batch: DataFrame) -> DataFrame:
        return flatten_events(batch, lookup_now(batch.sparkSession, lookup))

    return _each_batch(changes, batch_writer(path, counted), checkpoint, seconds)
