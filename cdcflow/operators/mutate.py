"""Writes on keyed tables as DataFrames: merge, update, delete. Keys are unique on both sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique(updates: DataFrame, key: str) -> DataFrame:
    """``updates`` as they are; a key that stands twice fails the job, as which row should win is not known."""
    rows = updates.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct("*")).alias("_row"))
    twice = F.raise_error(F.concat(F.lit("two updates of one key: "), F.col(key).cast("string")))
    return rows.select(F.when(F.col("_n") > 1, twice.cast(updates.schema)).otherwise(F.col("_row")).alias("_row")).select("_row.*")


def merge_upsert(base: DataFrame, updates: DataFrame, key: str = "recid") -> DataFrame:
    """Matched rows are replaced by the update, the others of both sides are kept."""
    updates = unique(updates, key)
    kept = base.join(updates.select(key), key, "left_anti")
    return kept.select(*base.columns).unionByName(updates.select(*base.columns))


def apply_update(base: DataFrame, updates: DataFrame, key: str = "recid", payload: str = "xmlrecord") -> DataFrame:
    """Set the payload of the rows named by ``updates``; a NULL payload is set as well. Adds no row."""
    new = unique(updates, key).select(key, F.col(payload).alias("_new"), F.lit(True).alias("_hit"))
    joined = base.join(new, key, "left")
    value = F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(payload))
    return joined.withColumn(payload, value).select(*base.columns)


def missing_keys(base: DataFrame, updates: DataFrame, key: str = "recid") -> DataFrame:
    """Update keys that no row has: zero rows updated for them."""
    return updates.select(key).join(base.select(key), key, "left_anti")


def delete_where(base: DataFrame, condition: Column) -> DataFrame:
    """Remove the rows for which the condition is true; an unknown condition keeps its row."""
    return base.filter(~F.coalesce(condition, F.lit(False)))


def delete_keys(base: DataFrame, keys: DataFrame, key: str = "recid") -> DataFrame:
    """Remove the rows named by ``keys``."""
    return base.join(keys.select(key), key, "left_anti")


def has_prefix(column: str, *prefixes: str) -> Column:
    """True when the text starts with any of the prefixes."""
    found = F.lit(False)
    for prefix in prefixes:
        found = found | F.col(column).startswith(prefix)
    return found
