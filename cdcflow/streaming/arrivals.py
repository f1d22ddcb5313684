"""Arrival stamps: when each stage of each change became readable."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from cdcflow.operators.flatten import flatten_events
from cdcflow.schema import EVENT_KEY
from cdcflow.streaming.current import Lookup, lookup_now
from cdcflow.streaming.feed import barrier
from cdcflow.streaming.live import batch_writer


def now_ms() -> int:
    return time.time_ns() // 1_000_000


def stamp_arrivals(rows: DataFrame, stage: str, seen_ms: int) -> DataFrame:
    """One observation per change, for a stage that became readable at ``seen_ms``."""
    return rows.select(*EVENT_KEY, F.lit(stage).alias("stage"), F.lit(seen_ms).cast("bigint").alias("seen_ms"))


def traced_stream(
    changes: DataFrame, lookup: Lookup, folder: str, checkpoint: str, seconds: float | None = 1.0
) -> StreamingQuery:
    """Land each micro-batch raw, then parsed, and stamp each stage after its commit.

    Writes ``events``, ``parsed`` and ``observations`` under ``folder``. A stamp belongs to a micro-batch: its
    changes become readable together.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch_writer(f"{folder}/events")(batch, batch_id)
        raw_ms = now_ms()
        events = spark.read.parquet(f"{folder}/events/batch_id={batch_id}")
        batch_writer(f"{folder}/parsed")(flatten_events(events, lookup_now(spark, lookup)), batch_id)
        parsed_ms = now_ms()
        parsed = spark.read.parquet(f"{folder}/parsed/batch_id={batch_id}")
        seen = stamp_arrivals(events, "raw", raw_ms).unionByName(stamp_arrivals(parsed, "parsed", parsed_ms))
        batch_writer(f"{folder}/observations")(seen, batch_id)

    return (
        changes.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(land)
        .trigger(**barrier(seconds))
        .start()
    )


def read_landed(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}").drop("batch_id")

