"""Splitting the history of keys that hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_of(order: str, span: int) -> Column:
    """The number of the range of ``span`` order values that holds one; of order values from 0 on it is 1 at least."""
    return (F.floor(F.col(order) / F.lit(span)) + 1).cast("bigint")


def hot_keys(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """The keys with more than ``hot_rows`` rows. Counting reads the key column only and combines before its shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows).select(key)


def add_buckets(df: DataFrame, key: str, order: str, hot_rows: int, span: int) -> DataFrame:
    """Add ``bucket``: 0 for ordinary keys, a number from 1 per range of ``span`` order values for hot keys.

    A key is hot with more than ``hot_rows`` rows. Buckets decide where rows are worked on, never which rows there are.
    """
    hot = hot_keys(df, key, hot_rows).withColumn("_hot", F.lit(True))
    bucket = F.when(F.col("_hot"), range_of(order, span)).otherwise(F.lit(0)).cast("bigint")
    return df.join(hot, key, "left").withColumn("bucket", bucket).drop("_hot")
