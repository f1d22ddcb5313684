"""Full history with before-images.

The capture side cannot supply the payload of a before-image, so it is rebuilt: the before-image of a
change is the newest known payload of the same key before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcflow.operators.skew import add_buckets, hot_keys, range_of
from cdcflow.operators.state import payload_known
from cdcflow.session import stored
from cdcflow.sources.envelope import flat_changes

# Changes of one key that one task orders; with records of 10 kB that is a sort of 2.5 GB, which may spill.
HOT_ROWS = 250_000
SPAN = 250_000
# Hash places that images needed by other ranges are marked by; so many numbers are broadcast at most.
PLACES = 1 << 18


def _known_image():
    return F.when(payload_known(), F.struct("xmlrecord"))


def link_images(flat: DataFrame, group: Sequence[str]) -> DataFrame:
    """Add ``prior``: the newest known image before each change inside its group.

    NULL means the group holds none, and the image has to come from an earlier group; a struct with a
    NULL payload means there was none (the record had been deleted).
    """
    before = Window.partitionBy(*group).orderBy("kafka_offset").rowsBetween(Window.unboundedPreceding, -1)
    return flat.withColumn("prior", F.last(_known_image(), ignorenulls=True).over(before))


def prior_images(flat: DataFrame, hot_rows: int = HOT_ROWS, span: int = SPAN) -> DataFrame:
    """``link_images`` over the whole history of each key, with hot keys split by offset range.

    No task sorts more than ``hot_rows`` rows of an ordinary key, or ``span`` of a hot one. From range to range goes
    the offset of the newest known image alone; its payload is joined once it is known which one a range needs. Ranges
    are as many as there are changes where the offsets of a key lie far apart, so neither they nor their payloads are
    broadcast, only the hash places of the images they need: changes at other places do not move for them.
    ``flat`` is read several times, so it should be stored.
    """
    # Dealt by range here, as the window would leave the rows of a key where the join of hot keys has gathered them.
    bucketed = add_buckets(flat, "recid", "kafka_offset", hot_rows, span).repartition("recid", "bucket")
    linked = link_images(bucketed, ["recid", "bucket"])
    tails = flat.groupBy("recid", range_of("kafka_offset", span).alias("bucket")).agg(
        F.max(F.when(payload_known(), F.col("kafka_offset"))).alias("tail")
    )
    ranges = tails.filter(F.col("bucket") > 0).join(hot_keys(flat, "recid", hot_rows), "recid", "left_semi")
    earlier = Window.partitionBy("recid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    needed = ranges.select(
        "recid", "bucket", F.last("tail", ignorenulls=True).over(earlier).alias("kafka_offset")
    ).filter(F.col("kafka_offset").isNotNull())
    carried = images_at(flat, needed, span)
    filled = linked.join(carried, ["recid", "bucket"], "left")
    return filled.withColumn("prior", F.coalesce("prior", "carried")).drop("carried", "bucket")


def images_at(flat: DataFrame, needed: DataFrame, span: int) -> DataFrame:
    """The image at the offset that each range needs: ``recid, bucket, carried``.

    Images meet their offsets by the range that holds them, of which one offset is needed at most.
    """
    place = F.pmod(F.xxhash64("recid", "kafka_offset"), F.lit(PLACES)).alias("place")
    images = flat.select("recid", range_of("kafka_offset", span).alias("source"), "kafka_offset", place, F.struct("xmlrecord").alias("carried"))
    images = images.join(F.broadcast(needed.select(place).distinct()), "place", "left_semi")
    sources = needed.groupBy("recid", "kafka_offset").agg(F.collect_list("bucket").alias("buckets"))
    sources = sources.select("recid", range_of("kafka_offset", span).alias("source"), F.col("kafka_offset").alias("tail"), "buckets")
    # Compared behind the join, so that it moves rows by their range alone.
    buckets = F.when(F.col("kafka_offset") == F.col("tail"), F.col("buckets"))
    return images.join(sources, ["recid", "source"]).select("recid", F.explode(buckets).alias("bucket"), "carried")


def history_rows(linked: DataFrame, before: Column) -> DataFrame:
    """Changes with both images, ``before`` being the payload of the earlier one."""
    return linked.select(
        "recid",
        "op",
        "kafka_partition",
        "kafka_offset",
        before.alias("before_xml"),
        F.when(~payload_known(), before).otherwise(F.col("xmlrecord")).alias("after_xml"),
    )


def audit(changes: DataFrame, hot_rows: int = HOT_ROWS, span: int = SPAN) -> DataFrame:
    """Every change with its rebuilt before-image: ``before_xml`` and ``after_xml``.

    The changes are parsed once, into the shared folder.
    """
    linked = prior_images(stored(flat_changes(changes), "changes"), hot_rows, span)
    return history_rows(linked, F.col("prior.xmlrecord"))
