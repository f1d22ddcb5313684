"""Live history with before-images, in one streaming query without a state store.

Each micro-batch is read once, into a work folder. Inside it, changes are linked to the image before them. The first
change of a key in a batch takes the newest image that earlier batches left, from a keyed table of images, which is
asked for the keys of the batch alone: a batch opens their buckets, not the state. Only then the batch is published, so
a reader never sees a change whose before-image is still to come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from cdcflow.operators.audit import HOT_ROWS, SPAN, history_rows, prior_images
from cdcflow.operators.state import images_of, newest_images
from cdcflow.sources.envelope import flat_changes
from cdcflow.streaming.feed import barrier
from cdcflow.streaming.keyed import EVERY, KeyedTable
from cdcflow.streaming.live import batch_writer


def images_table(spark: SparkSession, folder: str, every: int = EVERY) -> KeyedTable:
    """The newest image of each key in the history under ``folder``."""
    return KeyedTable(spark, f"{folder}/images", ["recid"], newest_images, every=every)


def audit_stream(
    changes: DataFrame,
    folder: str,
    hot_rows: int = HOT_ROWS,
    span: int = SPAN,
    seconds: float | None = 1.0,
    every: int = EVERY,
) -> StreamingQuery:
    """Keep the history of ``changes`` under ``folder``; read it with ``read_audit``.

    A batch that is written a second time reads the images of earlier batches only, and so gives the same rows.
    """
    work = f"{folder}/work"
    publish = batch_writer(f"{folder}/history")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        flat = flat_changes(batch)
        flat.write.mode("overwrite").parquet(work)
        flat = spark.read.schema(flat.schema).parquet(work)
        linked = prior_images(flat, hot_rows, span)
        images = images_table(spark, folder, every)
        opening = linked.filter(F.col("prior").isNull())
        earlier = images.read(deleted=True, below=batch_id, keys=flat)  # the first change of each key opens
        if earlier is None:
            rows = history_rows(linked, F.col("prior.xmlrecord"))
        else:
            carried = earlier.select("recid", F.col("xmlrecord").alias("carried"))
            closed = history_rows(linked.filter(F.col("prior").isNotNull()), F.col("prior.xmlrecord"))
            opened = opening.join(carried, "recid", "left")
            rows = closed.unionByName(history_rows(opened, F.col("carried")))
        publish(rows, batch_id)
        images.add(images_of(flat), batch_id)

    stream = changes.writeStream.option("checkpointLocation", f"{folder}/checkpoint")
    return stream.foreachBatch(write).trigger(**barrier(seconds)).start()


def read_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The history so far: the same columns as the batch ``audit``."""
    return spark.read.parquet(f"{folder}/history").drop("batch_id")
