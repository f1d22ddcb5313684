"""Latency trace: one row per change with its time at each stage and the time between stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.functions.records import has_marker, marker_ms
from cdcflow.schema import CLIENT_MARKER, DATABASE_MARKER, EVENT_KEY, TRACE_COLUMNS
from cdcflow.sources.envelope import decode_op, drop_tombstones, from_offsets, image


def source_ms(changes: DataFrame) -> Column:
    """Time of the change in the source log, from a parsed or a textual ``source``."""
    if changes.schema["source"].dataType.typeName() == "string":
        return F.get_json_object("source", "$.ts_ms").try_cast("bigint")
    return F.col("source.ts_ms").cast("bigint")


def markers(changes: DataFrame) -> DataFrame:
    """The three times a change carries: client stamp, database time with its precision, log time."""
    xml = F.col("_xml")
    live = drop_tombstones(changes).withColumn("_xml", image("XMLRECORD"))
    exact = has_marker(xml, DATABASE_MARKER)
    return live.select(
        *EVENT_KEY,
        image("RECID").alias("recid"),
        decode_op(F.col("op")).alias("op"),
        marker_ms(xml, CLIENT_MARKER).alias("t1_ms"),
        F.when(exact, marker_ms(xml, DATABASE_MARKER)).otherwise(source_ms(changes)).alias("t2_ms"),
        F.when(exact, "exact").otherwise("second").alias("t2_precision"),
        F.unix_millis("kafka_ts").alias("t3_ms"),
    )


def trace(changes: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Join each change with its arrival; a change that was never polled stays, without times.

    Total time runs to the parsed stage, or to the raw stage for changes that are never parsed, and starts at
    the client stamp, or at the database time without one.
    """
    return timed(markers(changes).join(arrivals.select(*EVENT_KEY, "t4_ms", "t5_ms"), EVENT_KEY, "left"))


def timed(stamps: DataFrame) -> DataFrame:
    """The trace of changes whose five times, ``t1_ms`` to ``t5_ms``, stand in one row."""
    t1, t2, t3, t4, t5 = (F.col(f"t{k}_ms") for k in range(1, 6))
    return stamps.select(
        "recid",
        "op",
        *EVENT_KEY,
        F.timestamp_millis(t1).alias("t1_generated"),
        F.timestamp_millis(t2).alias("t2_oracle"),
        F.timestamp_millis(t3).alias("t3_kafka"),
        F.timestamp_millis(t4).alias("t4_risingwave"),
        F.timestamp_millis(t5).alias("t5_parsed"),
        (t2 - t1).alias("gen_to_oracle_ms"),
        (t3 - t2).alias("oracle_to_kafka_ms"),
        (t4 - t3).alias("kafka_to_rw_ms"),
        (t5 - t4).alias("rw_to_parsed_ms"),
        (F.coalesce(t5, t4) - F.coalesce(t1, t2)).alias("total_ms"),
        "t2_precision",
    ).select(*TRACE_COLUMNS)


def run_scope(traced: DataFrame, start: dict[int, int]) -> DataFrame:
    """The changes of one run, by the first offset of each partition."""
    return traced.filter(from_offsets(start))


def untimed(traced: DataFrame) -> DataFrame:
    """Changes that nobody observed."""
    return traced.filter(F.col("total_ms").isNull())


def trace_listing(traced: DataFrame) -> DataFrame:
    """Every traced change in log order under the short report names."""
    return traced.orderBy("kafka_offset", "kafka_partition").select(
        "recid",
        "op",
        F.col("kafka_offset").alias("offset"),
        "t1_generated",
        "t2_oracle",
        "t3_kafka",
        "t4_risingwave",
        "t5_parsed",
        F.col("gen_to_oracle_ms").alias("gen2ora"),
        F.col("oracle_to_kafka_ms").alias("ora2kafka"),
        F.col("kafka_to_rw_ms").alias("kafka2rw"),
        F.col("rw_to_parsed_ms").alias("rw2parsed"),
        "total_ms",
        F.col("t2_precision").alias("prec"),
    )
