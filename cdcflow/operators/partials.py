"""Reports as sums that can be merged and taken back.

A partial row has, for one workload, operation, total time and kind of stamp, the number of changes and the sums and
counts of their legs. Rows of one key add up, and a change that gets other times is taken out by adding its old row with
the sign turned. Least and greatest times come from the keys that still count changes, so they can be taken back as well.
There are as many keys as there are different total times, however many changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.functions.numbers import round_ratio
from cdcflow.operators.reports import LEGS

KEYS = ["workload", "op", "total_ms", "stamped", "leg_known"]
_WIDE = "decimal(38,0)"
# Of a change these never differ, so they need not be taken back.
BOUNDS = {
    "first_change": F.min, "last_change": F.max, "first_offset": F.min, "last_offset": F.max,
}
SUMS = ["changes", *[f"{short}_{part}" for short in LEGS.values() for part in ("n", "sum")]]


def partials(traced: DataFrame, sign: int = 1) -> DataFrame:
    """Partial rows of a trace, one for each change; ``merged`` adds them up."""
    one = F.lit(sign).cast("bigint")
    legs = []
    for leg, short in LEGS.items():
        legs.append(F.when(F.col(leg).isNotNull(), one).otherwise(F.lit(0).cast("bigint")).alias(f"{short}_n"))
        legs.append((F.coalesce(F.col(leg), F.lit(0)) * sign).cast(_WIDE).alias(f"{short}_sum"))
    return traced.select(
        F.split_part("recid", F.lit("-"), F.lit(1)).alias("workload"),
        "op",
        "total_ms",
        F.col("t1_generated").isNotNull().alias("stamped"),
        F.col("gen_to_oracle_ms").isNotNull().alias("leg_known"),
        one.alias("changes"),
        *legs,
        F.col("t2_oracle").alias("first_change"),
        F.col("t2_oracle").alias("last_change"),
        F.col("kafka_offset").alias("first_offset"),
        F.col("kafka_offset").alias("last_offset"),
    )


def merged(rows: DataFrame) -> DataFrame:
    """One row per key. Keys that count no change any more stay, for the bounds of the changes that went elsewhere."""
    more = [F.max("batch_id").alias("batch_id")] if "batch_id" in rows.columns else []
    return rows.groupBy(*KEYS).agg(
        *[F.sum(c).cast(_WIDE if c.endswith("_sum") else "bigint").alias(c) for c in SUMS],
        *[bound(c).alias(c) for c, bound in BOUNDS.items()],
        *more,
    )


def _timed(*of: Column) -> Column:
    at = F.col("total_ms").isNotNull()
    for condition in of:
        at = at & condition
    return at


def _counts() -> list[Column]:
    timed = F.coalesce(F.sum(F.when(_timed(), F.col("changes"))), F.lit(0).cast("bigint"))
    changes = F.coalesce(F.sum("changes"), F.lit(0).cast("bigint"))
    return [changes.alias("changes"), timed.alias("timed"), (changes - timed).alias("untimed")]


def _total() -> Column:
    return F.sum(F.col("total_ms").cast(_WIDE) * F.col("changes"))


def _mean_total() -> Column:
    return round_ratio(_total(), F.sum(F.when(_timed(), F.col("changes"))), 0).alias("total_avg")


def _bounds() -> list[Column]:
    held = F.when(F.col("changes") > 0, F.col("total_ms"))
    return [F.min(held).alias("total_min"), F.max(held).alias("total_max")]


def _means() -> list[Column]:
    return [round_ratio(F.sum(f"{short}_sum"), F.sum(f"{short}_n"), 0).alias(short) for short in LEGS.values()]


def report_totals(rows: DataFrame) -> DataFrame:
    """As ``reports.report_totals``, of merged partial rows; so are the others."""
    stamped = F.coalesce(F.sum(F.when(F.col("stamped"), F.col("changes"))), F.lit(0).cast("bigint"))
    return rows.agg(*_counts(), stamped.alias("with_client_stamp"), *[bound(c).alias(c) for c, bound in BOUNDS.items()])


def report_by_op(rows: DataFrame) -> DataFrame:
    by_op = rows.groupBy("op").agg(*_counts(), _mean_total(), *_bounds())
    return by_op.filter("changes > 0").orderBy("op")


def report_by_workload(rows: DataFrame) -> DataFrame:
    groups = rows.filter(_timed()).groupBy("workload", "op")
    return groups.agg(F.sum("changes").alias("changes"), *_means(), _mean_total()).filter("changes > 0").orderBy("workload", "op")


def report_leg_share(rows: DataFrame) -> DataFrame:
    scope = rows.filter(_timed(F.col("leg_known")))
    sums = scope.agg(
        _total().alias("total_sum"),
        F.sum("changes").alias("total_n"),
        *[F.sum(f"{short}_{part}").alias(f"{short}_{part}") for short in LEGS.values() for part in ("sum", "n")],
    )
    share = [
        round_ratio(F.col(f"{short}_sum") * F.col("total_n").cast("decimal(18,0)") * 100, F.col("total_sum") * F.col(f"{short}_n").cast("decimal(18,0)"), 1)
        for short in LEGS.values()
    ]
    return sums.select(*[c.alias(f"{short}_pct") for c, short in zip(share, LEGS.values(), strict=True)])
