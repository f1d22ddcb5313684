"""Reports over the latency trace. All are map-side combined aggregates to a handful of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.functions.numbers import round_ratio
from cdcflow.operators.trace import run_scope

# Leg of the trace and its short report name.
LEGS = {
    "gen_to_oracle_ms": "gen2ora",
    "oracle_to_kafka_ms": "ora2kafka",
    "kafka_to_rw_ms": "kafka2rw",
    "rw_to_parsed_ms": "rw2parsed",
}


def _sum(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(20,0)"))


def _mean(column: str) -> Column:
    """Average of the non-NULL values to whole milliseconds, exact."""
    return round_ratio(_sum(column), F.count(column), 0)


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("changes"),
        F.count("total_ms").alias("timed"),
        (F.count(F.lit(1)) - F.count("total_ms")).alias("untimed"),
    ]


def report_totals(traced: DataFrame) -> DataFrame:
    return traced.agg(
        *_counts(),
        F.count("t1_generated").alias("with_client_stamp"),
        F.min("t2_oracle").alias("first_change"),
        F.max("t2_oracle").alias("last_change"),
        F.min("kafka_offset").alias("first_offset"),
        F.max("kafka_offset").alias("last_offset"),
    )


def report_by_op(traced: DataFrame) -> DataFrame:
    return (
        traced.groupBy("op")
        .agg(
            *_counts(),
            _mean("total_ms").alias("total_avg"),
            F.min("total_ms").alias("total_min"),
            F.max("total_ms").alias("total_max"),
        )
        .orderBy("op")
    )


def report_by_workload(traced: DataFrame) -> DataFrame:
    """Mean legs by key prefix and operation, timed changes only."""
    timed = traced.filter(F.col("total_ms").isNotNull())
    return (
        timed.groupBy(F.split_part("recid", F.lit("-"), F.lit(1)).alias("workload"), "op")
        .agg(
            F.count(F.lit(1)).alias("changes"),
            *[_mean(leg).alias(short) for leg, short in LEGS.items()],
            _mean("total_ms").alias("total_avg"),
        )
        .orderBy("workload", "op")
    )


def report_leg_share(traced: DataFrame) -> DataFrame:
    """Share of each leg in the mean total, in percent, over timed changes with a client stamp."""
    scope = traced.filter(F.col("total_ms").isNotNull() & F.col("gen_to_oracle_ms").isNotNull())
    sums = scope.agg(
        _sum("total_ms").alias("total_sum"),
        F.count("total_ms").alias("total_n"),
        *[_sum(leg).alias(f"{short}_sum") for leg, short in LEGS.items()],
        *[F.count(leg).alias(f"{short}_n") for leg, short in LEGS.items()],
    )

    def share(short: str) -> Column:
        # mean(leg) / mean(total) as one fraction of whole numbers
        part = F.col(f"{short}_sum") * F.col("total_n").cast("decimal(18,0)") * 100
        whole = F.col("total_sum") * F.col(f"{short}_n").cast("decimal(18,0)")
        return round_ratio(part, whole, 1).alias(f"{short}_pct")

    return sums.select(*[share(short) for short in LEGS.values()])


def report_run(traced: DataFrame, start: dict[int, int]) -> DataFrame:
    """By operation over the timed changes of one run."""
    scope = run_scope(traced, start).filter(F.col("total_ms").isNotNull())
    return (
        scope.groupBy("op")
        .agg(
            F.count(F.lit(1)).alias("changes"),
            *[_mean(leg).alias(short) for leg, short in LEGS.items()],
            _mean("total_ms").alias("total_avg"),
            F.min("total_ms").alias("total_min"),
            F.max("total_ms").alias("total_max"),
        )
        .orderBy("op")
    )
