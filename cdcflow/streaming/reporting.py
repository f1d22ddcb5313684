"""Reports kept up to date while changes and sightings of them arrive, in any order.

What is known of a change travels as fragments: its own times out of the log, or a sighting. Two keyed tables hold the
result: ``known`` merges the fragments of a change, ``groups`` has the partial rows of the reports. A batch asks ``known``
for its own changes only; what they counted before goes out of ``groups`` and what they count now is added. So a late or
earlier sighting corrects the reports, and a batch costs what it brings, not the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from cdcflow.operators.partials import KEYS, merged, partials
from cdcflow.operators.trace import markers, timed
from cdcflow.schema import EVENT_KEY
from cdcflow.streaming.feed import barrier
from cdcflow.streaming.keyed import EVERY, KeyedTable

CHANGE = "STRUCT<recid: STRING, op: STRING, t1_ms: BIGINT, t2_ms: BIGINT, t2_precision: STRING, t3_ms: BIGINT>"
MARKS = ["raw_seeded", "parsed_seeded", "recorded"]


def _fragment(rows: DataFrame, change=None, raw_ms=None, parsed_ms=None, **marks) -> DataFrame:
    no_time = F.lit(None).cast("bigint")
    return rows.select(
        *EVENT_KEY,
        (F.lit(None) if change is None else change).cast(CHANGE).alias("change"),
        (no_time if raw_ms is None else raw_ms).alias("raw_ms"),
        (no_time if parsed_ms is None else parsed_ms).alias("parsed_ms"),
        *[marks.get(m, F.lit(False)).alias(m) for m in MARKS],
    )


def of_changes(changes: DataFrame) -> DataFrame:
    """Fragments of the changes of a log, a table or a stream."""
    return _fragment(markers(changes), F.struct("recid", "op", "t1_ms", "t2_ms", "t2_precision", "t3_ms"))


def of_observations(observations: DataFrame) -> DataFrame:
    """Fragments of sightings: ``stage`` (raw or parsed) and ``seen_ms``."""
    raw, parsed = (F.when(F.col("stage") == stage, F.col("seen_ms")) for stage in ("raw", "parsed"))
    return _fragment(observations, raw_ms=raw, parsed_ms=parsed)


def of_seed(seed: DataFrame) -> DataFrame:
    """Fragments of what was visible before the observation began; see ``visibility.first_visibility``."""
    raw, parsed = (F.coalesce(F.col("stage") == stage, F.lit(False)) for stage in ("raw", "parsed"))
    return _fragment(seed, raw_seeded=raw, parsed_seeded=parsed)


def of_recorded(recorded: DataFrame) -> DataFrame:
    """Fragments of changes that have been measured before."""
    return _fragment(recorded, recorded=F.lit(True))


def known(rows: DataFrame) -> DataFrame:
    """What all fragments of a change say together."""
    more = [F.max("batch_id").alias("batch_id")] if "batch_id" in rows.columns else []
    return rows.groupBy(*EVENT_KEY).agg(
        F.max("change").alias("change"),
        F.min("raw_ms").alias("raw_ms"),
        F.min("parsed_ms").alias("parsed_ms"),
        *[F.max(m).alias(m) for m in MARKS],
        *more,
    )


def traced(rows: DataFrame) -> DataFrame:
    """The trace of the changes that are known; sightings of a change that the log has not shown yet wait."""
    t4 = F.when(~F.col("raw_seeded") & ~F.col("recorded"), F.col("raw_ms"))
    t5 = F.when(t4.isNotNull() & ~F.col("parsed_seeded"), F.col("parsed_ms"))
    held = rows.filter(F.col("change").isNotNull())
    return timed(held.select(*EVENT_KEY, "change.*", t4.alias("t4_ms"), t5.alias("t5_ms")))


def known_table(spark: SparkSession, folder: str, every: int = EVERY) -> KeyedTable:
    return KeyedTable(spark, f"{folder}/known", EVENT_KEY, known, every=every)


def groups_table(spark: SparkSession, folder: str, every: int = EVERY) -> KeyedTable:
    # A few MB whatever the history: one bucket.
    return KeyedTable(spark, f"{folder}/groups", KEYS, merged, buckets=1, every=every)


def _apply(spark: SparkSession, folder: str, fragments: DataFrame, every: int, keep: int | None, batch_id: int) -> None:
    facts, groups = known_table(spark, folder, every), groups_table(spark, folder, every)
    fragments = known(fragments)
    fragments.write.mode("overwrite").parquet(f"{folder}/work")
    fragments = spark.read.schema(fragments.schema).parquet(f"{folder}/work")
    # A batch that is repeated sees what it saw the first time, whatever it has committed since.
    before = facts.read(below=batch_id, keys=fragments)
    change = partials(traced(fragments))
    if before is not None:
        before = before.drop("batch_id")
        now = known(before.unionByName(fragments))
        change = partials(traced(now)).unionByName(partials(traced(before), -1))
    facts.add(fragments, batch_id)
    groups.add(merged(change), batch_id)
    if keep:
        facts.vacuum(keep)
        groups.vacuum(keep)


def reports_stream(
    fragments: DataFrame, folder: str, seconds: float | None = 1.0, every: int = EVERY, keep: int | None = None
) -> StreamingQuery:
    """Keep the reports over a stream of fragments, of one source or the union of several; ``read_groups`` reads them.

    ``keep`` removes all but so many versions of both tables after each batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _apply(batch.sparkSession, folder, batch, every, keep, batch_id)

    stream = fragments.writeStream.option("checkpointLocation", f"{folder}/checkpoint")
    return stream.foreachBatch(write).trigger(**barrier(seconds)).start()


def begin(spark: SparkSession, folder: str, fragments: DataFrame) -> None:
    """Fragments known before the stream starts, such as a seed. They count no change by themselves."""
    if fragments.filter(F.col("change").isNotNull()).limit(1).count():
        raise ValueError("changes belong into the stream")
    known_table(spark, folder).add(known(fragments), None)


def read_groups(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The merged partial rows, for the reports of ``operators.partials``."""
    rows = groups_table(spark, folder).read(version=version)
    if rows is None:
        raise ValueError(f"no batch has been written to {folder}")
    return rows


def read_trace(spark: SparkSession, folder: str) -> DataFrame:
    """The trace of all changes so far, with the columns of ``trace``."""
    rows = known_table(spark, folder).read()
    if rows is None:
        raise ValueError(f"no batch has been written to {folder}")
    return traced(rows)
