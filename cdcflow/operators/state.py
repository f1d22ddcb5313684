"""Current state of each record, by replaying its changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.schema import UNAVAILABLE
from cdcflow.sources.envelope import flat_changes


def payload_known(op: str = "op", payload: str = "xmlrecord") -> Column:
    """False for a change that only says "payload unchanged"; such a change must not overwrite state."""
    return (F.col(op) == "d") | F.coalesce(F.col(payload) != UNAVAILABLE, F.lit(True))


def latest_images(changes: DataFrame) -> DataFrame:
    """The newest image per key, deleted keys included: ``recid, xmlrecord, known, kafka_offset, deleted``.

    Not ``known``: every change of the key left its payload unchanged, so the image stands in an earlier batch.
    Aggregates combine before the shuffle, so a key with very many changes sends one row per map task.
    Used as it is on a stream (update mode), where a deleted key has to be reported.
    """
    return images_of(flat_changes(changes))


def images_of(flat: DataFrame) -> DataFrame:
    """``latest_images`` of changes that are flat already."""
    order = F.col("kafka_offset")
    # A struct, so that a NULL payload of the newest change is kept.
    image = F.max_by(F.struct("xmlrecord"), F.when(payload_known(), order))
    latest = flat.groupBy("recid").agg(
        image.alias("image"), F.max_by("op", order).alias("last_op"), F.max(order).alias("kafka_offset")
    )
    return latest.select(
        "recid",
        F.col("image.xmlrecord").alias("xmlrecord"),
        F.col("image").isNotNull().alias("known"),
        "kafka_offset",
        (F.col("last_op") == "d").alias("deleted"),
    )


def newest_images(images: DataFrame) -> DataFrame:
    """One row per key out of the ``latest_images`` of many batches, with their columns and ``batch_id``."""
    order = F.col("kafka_offset")
    newest = images.groupBy("recid").agg(
        F.max_by(F.struct("xmlrecord"), F.when(F.col("known"), order)).alias("image"),
        F.max_by("deleted", order).alias("deleted"),
        F.max(order).alias("kafka_offset"),
        F.max("batch_id").alias("batch_id"),
    )
    return newest.select(
        "recid",
        F.col("image.xmlrecord").alias("xmlrecord"),
        F.col("image").isNotNull().alias("known"),
        "kafka_offset",
        "deleted",
        "batch_id",
    )


def current_state(changes: DataFrame) -> DataFrame:
    """One row per live key: inserts, updates and snapshot reads replace it, a delete removes it."""
    return latest_images(changes).filter(~F.col("deleted")).drop("deleted", "known")


def latest_match(df: DataFrame, condition: Column, order: str) -> DataFrame:
    """The one row with the highest ``order`` among those that match."""
    return df.filter(condition).orderBy(F.col(order).desc()).limit(1)


def count_where(df: DataFrame, condition: Column) -> DataFrame:
    """``matching`` and ``total`` row counts in one pass."""
    return df.agg(F.count_if(condition).alias("matching"), F.count(F.lit(1)).alias("total"))
