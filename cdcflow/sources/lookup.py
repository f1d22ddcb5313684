"""The lookup that names the elements of a record."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.schema import LOOKUP, LOOKUP_CSV


def load_lookup(spark: SparkSession, path: str, multivalue_fields: Iterable[str]) -> DataFrame:
    """Read the lookup CSV (``table_name, field_index, m_index, resolved_name_en, dt``).

    The file does not say which fields repeat, so ``multivalue_fields`` has to: values of a field that repeats and is
    not named there fall into one column. An empty ``m_index`` is NULL.
    """
    rows = spark.read.schema(LOOKUP_CSV).option("header", True).option("enforceSchema", False).csv(path)
    return rows.select(
        "field_index",
        F.nullif("m_index", F.lit("")).alias("m_index"),
        "resolved_name_en",
        F.col("field_index").isin(list(multivalue_fields)).alias("is_multivalue"),
    )


def lookup_rows(spark: SparkSession, rows: Iterable[tuple[str, str | None, str, bool]]) -> DataFrame:
    """A lookup given inline, as literals of the plan, so that its size is known when joins are planned."""
    names = [part.split()[0] for part in LOOKUP.split(", ")]
    values = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row, strict=True))) for row in rows]
    kind = f"array<struct<{', '.join(part.replace(' ', ': ') for part in LOOKUP.split(', '))}>>"
    return spark.range(1).select(F.inline(F.array(*values).cast(kind)))


def position_suffix(position: Column) -> Column:
    """``_NN`` of a repeated field: first position by default, two characters always."""
    return F.concat(F.lit("_"), F.lpad(F.coalesce(position, F.lit("1")), 2, "0"))


def names_from_lookup(lookup: DataFrame, positions: int | dict[str, int]) -> list[str]:
    """Every column name the lookup can produce, in order of its rows, repeated fields up to ``positions``.

    ``positions`` may give a number for each field. The driver gets one name for each column of the result.
    """
    names: list[str] = []
    for row in lookup.select("field_index", "m_index", "resolved_name_en", "is_multivalue").collect():
        if row.m_index is None and row.is_multivalue:
            last = positions if isinstance(positions, int) else positions[row.field_index]
            names += [f"{row.resolved_name_en}_{k:02d}" for k in range(1, last + 1)]
        else:
            names.append(row.resolved_name_en)
    return list(dict.fromkeys(names))
