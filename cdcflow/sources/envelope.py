"""Change log messages to changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.schema import ENVELOPE, OP_WORDS


def parse_envelope(
    messages: DataFrame, value_col: str = "value", envelope: str = ENVELOPE, on_bad: str = "fail"
) -> DataFrame:
    """Parse the JSON text of each message into ``op, before, after, source, ts_ms``.

    Every message stays a row; a NULL value (tombstone) gives NULL columns. Pass another ``envelope``
    DDL to keep more of ``source``. Other columns of the input are kept behind the parsed ones.

    A value that is no whole JSON text, or names no operation, fails the job once its ``op`` is read. With
    ``on_bad="keep"`` its text stays in one more column, ``bad_value``, for ``bad_messages``; its ``op`` is NULL.
    """
    if on_bad not in ("fail", "keep"):
        raise ValueError(f"unknown treatment {on_bad!r}")
    rest = [c for c in messages.columns if c != value_col]
    # inline instead of a struct column: later filters on op stay above it, so the JSON is parsed once.
    options = {"columnNameOfCorruptRecord": "_damaged"}
    struct = F.from_json(F.col(value_col), f"{envelope}, _damaged STRING", options)
    parsed = messages.select(F.inline(F.array(struct)), F.col(value_col).alias("_value"), *rest)
    bad = F.col("_value").isNotNull() & (F.col("op").isNull() | F.col("_damaged").isNotNull())
    if on_bad == "keep":
        parsed = parsed.withColumns({"bad_value": F.when(bad, F.col("_value")), "op": F.when(~bad, F.col("op"))})
    else:
        where = F.concat(F.lit("damaged message: "), F.substr("_value", F.lit(1), F.lit(200)))
        parsed = parsed.withColumn("op", F.when(bad, F.raise_error(where)).otherwise(F.col("op")))
    return with_metadata(parsed.drop("_damaged", "_value"))


def bad_messages(parsed: DataFrame) -> DataFrame:
    """The messages that could not be parsed, out of ``parse_envelope(..., on_bad="keep")``."""
    return parsed.filter(F.col("bad_value").isNotNull())


def to_messages(changes: DataFrame, *rest: str) -> DataFrame:
    """The messages that publish changes: ``key, value, is_tombstone``, and the columns named in ``rest``.

    The value is JSON without an embedded schema. Each delete is followed by a message of the same key without value,
    which lets a compacted log forget the key.
    """
    columns = [c for c in ("op", "before", "after", "source", "ts_ms") if c in changes.columns]
    value = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    no_value = F.lit(None).cast("string")
    values = F.when(F.col("op") == "d", F.array(value, no_value)).otherwise(F.array(value))
    exploded = changes.select(image("RECID").alias("key"), F.posexplode(values).alias("_pos", "value"), *rest)
    return exploded.select("key", "value", (F.col("_pos") == 1).alias("is_tombstone"), *rest)


def with_metadata(messages: DataFrame) -> DataFrame:
    """Name the log metadata of a message ``kafka_partition, kafka_offset, kafka_ts``."""
    names = {"partition": "kafka_partition", "offset": "kafka_offset", "timestamp": "kafka_ts"}
    return messages.withColumnsRenamed({k: v for k, v in names.items() if k in messages.columns})


def drop_tombstones(changes: DataFrame) -> DataFrame:
    """Leave out the payload-free message that follows each delete."""
    return changes.filter(F.col("op").isNotNull())


def image(name: str) -> Column:
    """A column of the image of a change: ``after`` when present, else ``before``."""
    return F.coalesce(F.col(f"after.{name}"), F.col(f"before.{name}"))


def decode_op(op: Column) -> Column:
    """The word for an operation code; an unknown code passes through."""
    word = F.lit(None).cast("string")
    for code, name in OP_WORDS.items():
        word = F.when(op == code, F.lit(name)).otherwise(word)
    return F.coalesce(word, op)


def from_offsets(start: dict[int, int]) -> Column:
    """True from the start offset of each partition on. Offsets of different partitions say nothing about each other,
    so each has its own; a partition that is not named is taken whole."""
    starts = F.lit(None).cast("map<int,bigint>")
    if start:
        starts = F.create_map(*(F.lit(x).cast(t) for p, o in start.items() for x, t in ((p, "int"), (o, "bigint"))))
    return F.coalesce(F.col("kafka_offset") >= F.try_element_at(starts, F.col("kafka_partition").cast("int")), F.lit(True))


def since_offset(changes: DataFrame, start: dict[int, int]) -> DataFrame:
    """Changes from one offset of each partition on: the scope of one run, and the table form of a start position."""
    return changes.filter(from_offsets(start))


def flat_changes(changes: DataFrame, *extra: str) -> DataFrame:
    """Tombstone-free changes as ``recid, op, xmlrecord`` (the after-image) with their identity."""
    return drop_tombstones(changes).select(
        image("RECID").alias("recid"),
        "op",
        F.col("after.XMLRECORD").alias("xmlrecord"),
        "kafka_partition",
        "kafka_offset",
        *extra,
    )
