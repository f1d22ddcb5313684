"""When each change became visible, from repeated observations of the stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.schema import EVENT_KEY


def stage_union(raw: DataFrame, parsed: DataFrame, *columns: str) -> DataFrame:
    """What both stages hold, read by one job: ``stage`` plus the identity of the change."""
    wanted = [*EVENT_KEY, *columns]
    return raw.select(F.lit("raw").alias("stage"), *wanted).unionByName(
        parsed.select(F.lit("parsed").alias("stage"), *wanted)
    )


def first_visibility(observations: DataFrame, seed: DataFrame, recorded: DataFrame) -> DataFrame:
    """First time each change was seen raw (``t4_ms``) and parsed (``t5_ms``).

    ``seed`` holds what was visible before the observation began: a seeded raw stage takes the change out, a
    seeded parsed stage only leaves ``t5_ms`` NULL. Changes in ``recorded`` have been measured before. A
    change never seen raw is not reported.

    The two exclusions travel as marks through the same aggregation as the observations. That is one shuffle
    in place of an aggregation and two joins, and its map-side combine shrinks a change that was polled very
    often to one row per task.
    """
    raw, parsed = F.col("stage") == "raw", F.col("stage") == "parsed"
    no_time = F.lit(None).cast("bigint")
    seen = observations.select(*EVENT_KEY, "stage", "seen_ms", F.lit(False).alias("seeded"), F.lit(False).alias("done"))
    seeds = seed.select(
        *EVENT_KEY, "stage", no_time.alias("seen_ms"), F.lit(True).alias("seeded"), F.lit(False).alias("done")
    )
    done = recorded.select(
        *EVENT_KEY,
        F.lit("raw").alias("stage"),
        no_time.alias("seen_ms"),
        F.lit(False).alias("seeded"),
        F.lit(True).alias("done"),
    )
    per_change = (
        seen.unionByName(seeds)
        .unionByName(done)
        .groupBy(*EVENT_KEY)
        .agg(
            F.min(F.when(raw, F.col("seen_ms"))).alias("t4_ms"),
            F.min(F.when(parsed, F.col("seen_ms"))).alias("t5_ms"),
            F.max(F.col("seeded") & raw).alias("raw_seeded"),
            F.max(F.col("seeded") & parsed).alias("parsed_seeded"),
            F.max("done").alias("done"),
        )
    )
    fresh = per_change.filter(F.col("t4_ms").isNotNull() & ~F.col("raw_seeded") & ~F.col("done"))
    return fresh.select(*EVENT_KEY, "t4_ms", F.when(~F.col("parsed_seeded"), F.col("t5_ms")).alias("t5_ms"))
