"""Live wide rows that follow their lookup.

A name that is added, changed or taken away concerns the rows written before as well. Three keyed tables make that cheap:
the state has the newest payload of each key, ``fields`` says which keys hold a field, and the wide rows are the result.
When the lookup of a batch differs from that of the batch before, the keys that hold a field with a changed entry are
looked up in ``fields`` and flattened again, together with the keys of the batch. All other rows stay as they are.

``fields`` keeps a key under a field that its newest payload has lost; such a key is flattened once more than need be.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from cdcflow.functions.records import has_tags
from cdcflow.operators.flatten import flatten_wide, unpivot_tags
from cdcflow.operators.state import latest_images, newest_images
from cdcflow.sources import files
from cdcflow.streaming.current import Lookup, lookup_now
from cdcflow.streaming.feed import barrier
from cdcflow.streaming.keyed import EVERY, KeyedTable
from cdcflow.streaming.live import newest_rows

NAMES = ["field_index", "m_index", "resolved_name_en", "is_multivalue"]


def newest_pairs(rows: DataFrame) -> DataFrame:
    return rows.groupBy("field", "recid").agg(F.max("batch_id").alias("batch_id"))


def state_table(spark: SparkSession, folder: str, every: int = EVERY) -> KeyedTable:
    return KeyedTable(spark, f"{folder}/state", ["recid"], newest_images, every=every)


def wide_table(spark: SparkSession, folder: str, every: int = EVERY) -> KeyedTable:
    return KeyedTable(spark, f"{folder}/wide", ["recid"], newest_rows(["recid"]), every=every)


def fields_table(spark: SparkSession, folder: str, every: int = EVERY) -> KeyedTable:
    return KeyedTable(spark, f"{folder}/fields", ["field"], newest_pairs, every=every)


def kept_names(spark: SparkSession, folder: str, upto: str) -> DataFrame | None:
    """The newest lookup kept under a number that is not above ``upto``."""
    whole = [n for n in files.names(spark, f"{folder}/names") if n <= upto and "_SUCCESS" in files.names(spark, f"{folder}/names/{n}")]
    return spark.read.parquet(f"{folder}/names/{whole[-1]}") if whole else None


def changed_fields(old: DataFrame, new: DataFrame) -> DataFrame:
    """``field`` of all entries that only one of two lookups has."""
    old, new = old.select(*NAMES), new.select(*NAMES)
    return old.exceptAll(new).unionByName(new.exceptAll(old)).select(F.col("field_index").alias("field")).distinct()


def widened(state: DataFrame, lookup: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Wide rows of images; deletes and records without elements take the wide row away."""
    gone = F.col("deleted") | ~has_tags(F.col("xmlrecord"))
    state = state.filter("known").select("recid", "kafka_offset", "xmlrecord", gone.alias("deleted"))
    wide = flatten_wide(state.filter("NOT deleted"), lookup, columns, ["recid", "kafka_offset", "deleted"])
    return wide.unionByName(state.filter("deleted").select("recid", "kafka_offset", "deleted"), allowMissingColumns=True)


def _apply(
    spark: SparkSession, folder: str, images: DataFrame | None, lookup: Lookup, columns: Sequence[str], every: int, batch_id: int | None
) -> None:
    """One step: the images of a batch (none: only what the lookup changed) and the wide rows they lead to.

    The lookup is kept first, so a batch that is repeated sees the same one and the same changes of it.
    """
    state, wide, fields = (t(spark, folder, every) for t in (state_table, wide_table, fields_table))
    last = wide.version()
    # What the lookup was in a batch, or in the next refresh behind the last one.
    number = f"{batch_id:012d}-" if batch_id is not None else f"{max(last.batch_id, 0):012d}-~"
    old = kept_names(spark, folder, number)
    number = f"{number[:13]}{0 if batch_id is not None else len(files.names(spark, f'{folder}/names')):06d}"
    new = lookup_now(spark, lookup).select(*NAMES)
    changed = None
    if number in files.names(spark, f"{folder}/names"):
        new = kept_names(spark, folder, number)
    if old is not None:
        changed = changed_fields(old, new)
    if old is None or not changed.isEmpty():
        new.write.mode("overwrite").parquet(f"{folder}/names/{number}")
        new = spark.read.schema(new.schema).parquet(f"{folder}/names/{number}")
    else:
        changed = None
    keys = None
    if images is not None:
        images.write.mode("overwrite").parquet(f"{folder}/work")
        images = spark.read.schema(images.schema).parquet(f"{folder}/work")
        state.add(images, batch_id)
        held = unpivot_tags(images.filter("known AND NOT deleted"), ["recid"]).select("field", "recid").distinct()
        fields.add(held, batch_id)
        keys = images.filter("known").select("recid")
    if changed is not None:
        concerned = fields.read(keys=changed)
        if concerned is not None:
            concerned = concerned.select("recid")
            keys = concerned if keys is None else keys.unionByName(concerned).distinct()
    if keys is not None:
        now = state.read(deleted=True, keys=keys)
        wide.add(widened(now, new, columns), batch_id)


def wide_stream(
    changes: DataFrame,
    lookup: Lookup,
    columns: Sequence[str],
    folder: str,
    seconds: float | None = 1.0,
    every: int = EVERY,
    follow: str | None = None,
) -> StreamingQuery:
    """Keep the wide rows of the live state under ``folder``, also as its lookup changes; read them with ``read_wide``.

    A lookup given as a function is read anew in each batch. ``follow`` names a global temporary view that shows the
    newest rows after each batch. Between batches ``refresh`` brings in a changed lookup.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _apply(spark, folder, latest_images(batch), lookup, columns, every, batch_id)
        if follow:
            wide_table(spark, folder).follow(follow, _shown)

    stream = changes.writeStream.option("checkpointLocation", f"{folder}/checkpoint")
    return stream.foreachBatch(write).trigger(**barrier(seconds)).start()


def refresh(spark: SparkSession, folder: str, lookup: Lookup, columns: Sequence[str], every: int = EVERY) -> None:
    """Bring a changed lookup to all rows it concerns, without a batch. Not while the stream of ``folder`` runs."""
    _apply(spark, folder, None, lookup, columns, every, None)


def _shown(rows: DataFrame) -> DataFrame:
    return rows.drop("deleted", "batch_id")


def read_wide(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The wide rows: ``recid, kafka_offset`` and the columns."""
    rows = wide_table(spark, folder).read(version=version)
    if rows is None:
        raise ValueError(f"no batch has been written to {folder}")
    return _shown(rows)


def state_stream(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    seconds: float | None = 1.0,
    every: int = EVERY,
    forget_after: int | None = None,
    follow: str | None = None,
    keep: int | None = None,
) -> StreamingQuery:
    """Keep the current state as a table with versions; ``read_state`` reads any of them. ``follow`` as in
    ``wide_stream``; ``keep`` removes all but so many versions after each batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table = KeyedTable(batch.sparkSession, path, ["recid"], newest_images, every=every, forget_after=forget_after)
        table.add(latest_images(batch), batch_id)
        if follow:
            table.follow(follow, lambda rows: rows.select("recid", "xmlrecord", "kafka_offset"))
        if keep:
            table.vacuum(keep)

    stream = changes.writeStream.option("checkpointLocation", checkpoint)
    return stream.foreachBatch(write).trigger(**barrier(seconds)).start()


def read_state(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The state of a version, the newest by default: ``recid, xmlrecord, kafka_offset``."""
    rows = KeyedTable(spark, path, ["recid"], newest_images).read(version=version)
    if rows is None:
        raise ValueError(f"no batch has been written to {path}")
    return rows.select("recid", "xmlrecord", "kafka_offset")
