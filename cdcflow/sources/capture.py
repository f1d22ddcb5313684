"""Changes out of tables: the initial snapshot, and the difference of two states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcflow.schema import UNAVAILABLE
from cdcflow.session import stored

CAPTURED = ("recid", "xmlrecord")


def _image(recid, xml):
    return F.struct(recid.alias("RECID"), xml.alias("XMLRECORD"))


def snapshot(records: DataFrame, columns: Sequence[str] = CAPTURED) -> DataFrame:
    """One ``r`` change per record; ``columns`` are the two that are captured, key and payload, and no others are read."""
    key, payload = columns
    return records.select(
        F.lit("r").alias("op"),
        _no_image().alias("before"),
        _image(F.col(key), F.col(payload)).alias("after"),
    )


def snapshot_diff(old: DataFrame, new: DataFrame, key: str = "recid", payload: str = "xmlrecord") -> DataFrame:
    """The changes that lead from one state of a table to the next.

    One full outer join on the primary key; unchanged rows (NULL equal to NULL) give nothing. As in the
    log, the before-image of an update or delete names the key but not the payload.
    """
    left = old.select(F.col(key).alias("_k"), F.col(payload).alias("_old"), F.lit(True).alias("_had"))
    right = new.select(F.col(key).alias("_k"), F.col(payload).alias("_new"), F.lit(True).alias("_has"))
    both = left.join(right, "_k", "full_outer")
    op = (
        F.when(F.col("_had").isNull(), "c")
        .when(F.col("_has").isNull(), "d")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "u")
    )
    changed = both.withColumn("op", op).filter(F.col("op").isNotNull())
    return changed.select(
        "op",
        F.when(F.col("op") != "c", _image(F.col("_k"), F.lit(UNAVAILABLE))).alias("before"),
        F.when(F.col("op") != "d", _image(F.col("_k"), F.col("_new"))).alias("after"),
    )


def _digests(rows: DataFrame, level: Column) -> DataFrame:
    """Count, sum and exclusive or of row hashes for each range; tasks combine before the shuffle."""
    return rows.groupBy(level.alias("_range")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("_h1").cast("decimal(38,0)")).alias("_s"), F.bit_xor("_h2").alias("_x")
    )


def _unequal(left: DataFrame, right: DataFrame, level: Column) -> DataFrame:
    """The ranges that do not hold the same rows on both sides."""
    columns = ["_n", "_s", "_x"]
    one, two = (_digests(rows, level) for rows in (left, right))
    both = one.withColumn("_a", F.struct(*columns)).select("_range", "_a").join(
        two.withColumn("_b", F.struct(*columns)).select("_range", "_b"), "_range", "full_outer"
    )
    return both.filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("_range")


def snapshot_diff_ranges(
    old: DataFrame, new: DataFrame, key: str = "recid", payload: str = "xmlrecord", levels: Sequence[int] = (1 << 10, 1 << 20)
) -> DataFrame:
    """What ``snapshot_diff`` returns, for two large states that are mostly equal.

    Ranges of the key's hash are compared by digests, from few ranges to many, and each level looks into the unequal
    ranges of the one before only. Rows of the ranges left are compared by key and hash; payloads travel for changed keys alone.
    So what is shuffled grows with the change and with ``levels`` (numbers of ranges, each a multiple of the one before,
    and a bound on what a digest table holds), not with the states, which are read some times over. Rows are told apart by
    two 64-bit hashes; keys have to be unique in each state, and a NULL key never has a partner, as in the join.
    """
    if any(b % a for a, b in zip(levels, levels[1:], strict=False)):
        raise ValueError("each level has to be a multiple of the one before")
    place, narrow = F.xxhash64("_k"), []
    for side in (old, new):
        rows = side.filter(F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.col(payload).alias("_v"))
        # A NULL and an empty text hash alike without the mark.
        hashes = [F.xxhash64("_k", "_v", F.col("_v").isNull(), F.lit(seed)).alias(f"_h{seed}") for seed in (1, 2)]
        narrow.append(rows.select("_k", place.alias("_at"), *hashes))
    left, right = narrow
    for n in levels:
        level = F.pmod("_at", F.lit(n))
        ranges = stored(_unequal(left, right, level), "ranges")
        left, right = (rows.join(ranges, level == F.col("_range"), "left_semi") for rows in (left, right))
    hashes = F.struct("_h1", "_h2")
    both = left.select("_k", hashes.alias("_a")).join(right.select("_k", hashes.alias("_b")), "_k", "full_outer")
    op = F.when(F.col("_a").isNull(), "c").when(F.col("_b").isNull(), "d").when(F.col("_a") != F.col("_b"), "u")
    changed = stored(both.select("_k", op.alias("op")).filter(F.col("op").isNotNull()), "changed")
    nameless = F.col("_k").isNull()
    gone = changed.filter("op = 'd'").select("_k").unionByName(old.select(F.col(key).alias("_k")).filter(nameless))
    gone = gone.select(F.lit("d").alias("op"), _image(F.col("_k"), F.lit(UNAVAILABLE)).alias("before"), _no_image().alias("after"))
    images = new.select(F.col(key).alias("_k"), F.col(payload).alias("_v"))
    there = images.join(changed.filter("op <> 'd'"), "_k").unionByName(
        images.filter(nameless).withColumn("op", F.lit("c"))
    )
    before = F.when(F.col("op") == "u", _image(F.col("_k"), F.lit(UNAVAILABLE)))
    return gone.unionByName(there.select("op", before.alias("before"), _image(F.col("_k"), F.col("_v")).alias("after")))


def _no_image() -> Column:
    return F.lit(None).cast("struct<RECID: string, XMLRECORD: string>")


def as_log(
    changes: DataFrame, at_ms: int, partitions: int, start: dict[int, int] | None = None, partition: Column | None = None
) -> DataFrame:
    """Captured changes with times and places in a log, ready for ``current_state``, ``audit`` and ``trace``.

    ``at_ms`` is the time of the capture: the source log keeps whole seconds of it. Changes go to ``partitions`` by
    their key (or by the number ``partition``) and are numbered by key in each, from ``start`` (0 by default).

    A task numbers a range of (partition, key), so one partition may take any number of tasks: the changes are written
    in that order to the shared folder, each with its place in its range, and counts of ranges say where a range begins.
    """
    key = F.coalesce("after.RECID", "before.RECID")
    dealt = changes.withColumn("kafka_partition", F.pmod(partition if partition is not None else F.xxhash64(key), F.lit(partitions)).cast("int"))
    order = ["kafka_partition", key, "op", F.xxhash64("before", "after")]
    ranked = dealt.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = stored(ranked, "log").withColumn("_range", F.shiftright("_at", 33))
    ranges = placed.groupBy("kafka_partition", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("kafka_partition").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    # As many rows as there are tasks and partitions of the log, whatever the capture holds.
    numbered = placed.join(F.broadcast(ranges), ["kafka_partition", "_range"])
    nth = F.col("_before") + F.col("_at") - F.col("_first")
    first = F.create_map(*(F.lit(x) for item in (start or {-1: 0}).items() for x in item))
    offset = (F.coalesce(F.try_element_at(first, F.col("kafka_partition")), F.lit(0)) + nth).cast("bigint")
    at = F.lit(at_ms).cast("bigint")
    return numbered.select(
        "op", "before", "after", F.struct((at - at % 1000).alias("ts_ms")).alias("source"), at.alias("ts_ms"),
        "kafka_partition", offset.alias("kafka_offset"), F.timestamp_millis(at).alias("kafka_ts"),
    )
