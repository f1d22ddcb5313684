"""Change log topics as streams, triggers and draining."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from cdcflow.schema import MESSAGE


def starting_offsets(start: str | dict) -> str:
    """``earliest``, ``latest`` or ``{topic: {partition: offset}}`` as the source expects it."""
    if isinstance(start, dict):
        return json.dumps({t: {str(p): o for p, o in parts.items()} for t, parts in start.items()})
    if start not in ("earliest", "latest"):
        raise ValueError(f"unknown start position {start!r}")
    return start


def kafka_options(servers: str, topic: str, start: str | dict = "earliest", per_batch: int = 1_000_000) -> dict:
    """Options of a topic source; ``per_batch`` bounds the rows of one micro-batch."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets(start),
        "maxOffsetsPerTrigger": str(per_batch),
    }


def change_stream(
    spark: SparkSession, options: dict[str, str], fmt: str = "kafka", path: str | None = None, schema: str = MESSAGE
) -> DataFrame:
    """A stream of messages, from a topic or from files that hold one message per row.

    The topic source needs its connector on the class path. Files are taken in the order of their
    modification time, so a writer has to add them in log order.
    """
    if fmt == "kafka":
        rows = spark.readStream.format("kafka").options(**options).load()
        return rows.select(
            F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset", "timestamp"
        )
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def barrier(seconds: float | None = 1.0) -> dict:
    """Trigger arguments: a visibility interval, or everything available and then stop (None)."""
    if seconds is None:
        return {"availableNow": True}
    return {"processingTime": f"{int(seconds * 1000)} milliseconds"}


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, so it may outgrow the memory of an executor."""
    previous = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)  # read once, when a query starts
    try:
        yield
    finally:
        if previous is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, previous)


def drain(query: StreamingQuery) -> None:
    """Wait until everything that has arrived is visible."""
    query.processAllAvailable()


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query; failures are raised here."""
    query.awaitTermination()
