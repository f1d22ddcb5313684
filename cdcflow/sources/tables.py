"""Table writes."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a parquet table."""
    df.write.mode("append").parquet(path)


def recreate(df: DataFrame, path: str) -> None:
    """Write a table anew; running it again gives the same table."""
    df.write.mode("overwrite").parquet(path)


def live_view(df: DataFrame, name: str) -> None:
    """Register a view that is computed on each read."""
    df.createOrReplaceTempView(name)
