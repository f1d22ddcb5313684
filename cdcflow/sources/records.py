"""Files of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.functions.records import record_id


def read_records(spark: SparkSession, path: str, one_per_file: bool = True, on_bad: str = "fail") -> DataFrame:
    """Read UTF-8 record files into ``(recid, xmlrecord)``, taking the key from the id of the record.

    ``one_per_file`` reads each file whole. Otherwise a file may hold any number of records and is
    split at the opening tag, so a large file is read by many tasks. A record that is cut off or not well-formed has
    no id: it fails the job, or with ``on_bad="keep"`` stays as it is, with a NULL ``recid``.
    """
    if on_bad not in ("fail", "keep"):
        raise ValueError(f"unknown treatment {on_bad!r}")
    if one_per_file:
        raw = spark.read.text(path, wholetext=True)
    else:
        raw = spark.read.text(path, lineSep="<row ").filter(F.ltrim("value").startswith("id="))
        whole = F.concat(F.split_part("value", F.lit("</row>"), F.lit(1)), F.lit("</row>"))
        closed = F.when(F.col("value").contains("</row>"), whole).otherwise(F.col("value"))
        raw = raw.select(F.concat(F.lit("<row "), closed).alias("value"))
    recid = record_id(F.col("value"))
    if on_bad == "fail":
        start = F.concat(F.lit("damaged record: "), F.substr("value", F.lit(1), F.lit(200)))
        recid = F.coalesce(recid, F.raise_error(start).cast("string"))
    return raw.select(recid.alias("recid"), F.col("value").alias("xmlrecord"))
