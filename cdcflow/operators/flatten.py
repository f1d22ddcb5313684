"""Metadata-driven flattening: record text to elements, to named elements, to wide rows.

Elements are exploded, joined with the lookup and aggregated by key. Spark sees the size of a lookup and broadcasts or
shuffles it. For one that is shuffled, ``hot_rows`` keeps the elements of a frequent field from meeting in one task.

An element is named by an exact ``(field, position)`` entry, else by the base entry of its field, with a
``_NN`` suffix when the field repeats. An element without position never matches an exact entry. Elements
without a name add nothing, but their record keeps its row; a record without any element has no row. When
several elements of one key get one name, the greatest text wins, also when the key repeats.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.functions.records import element_value, tag_matches, tag_parts, varchar_bytes
from cdcflow.session import stored
from cdcflow.sources.envelope import drop_tombstones, image
from cdcflow.sources.lookup import position_suffix

# Elements of a field above which a large lookup does not shuffle them by field.
HOT_ROWS = 250_000
# Elements of a file, of which a task reads up to 32.
FILE_ROWS = 200_000


# ---- elements and names ----------------------------------------------------------------------------


def unpivot_tags(df: DataFrame, keys: Sequence[str], xml: str = "xmlrecord") -> DataFrame:
    """One row per element: ``keys, field, position, value``. Records without elements give no row."""
    # explode_outer and a filter on its output: plain explode would have Spark evaluate the regular
    # expression a second time, in a filter on the size of the array.
    exploded = df.select(*keys, F.explode_outer(tag_matches(F.col(xml))).alias("_tag")).filter(F.col("_tag").isNotNull())
    return exploded.select(*keys, *(part.alias(name) for name, part in tag_parts(F.col("_tag")).items()))


def _lookup_sides(lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    exact = lookup.filter(F.col("m_index").isNotNull()).select(
        F.col("field_index").alias("field"),
        F.col("m_index").alias("position"),
        F.col("resolved_name_en").alias("exact_name"),
    )
    base = lookup.filter(F.col("m_index").isNull()).select(
        F.col("field_index").alias("field"),
        F.col("resolved_name_en").alias("base_name"),
        F.col("is_multivalue").alias("repeats"),
    )
    return exact, base


def _named(tags: DataFrame, exact: DataFrame, base: DataFrame) -> DataFrame:
    named = tags.join(exact, ["field", "position"], "left").join(base, "field", "left")
    base_name = F.when(
        F.col("repeats"), F.concat(F.col("base_name"), position_suffix(F.col("position")))
    ).otherwise(F.col("base_name"))
    return named.select(*tags.columns, F.coalesce("exact_name", base_name).alias("column_name"))


def resolve_names(tags: DataFrame, lookup: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Add ``column_name`` to each element; NULL where the lookup has no name for it.

    For a lookup too large to be broadcast, ``hot_rows`` takes fields with more than so many elements apart: their entries
    are broadcast, so that no task gets all elements of a field. The elements are written to the shared folder for it. Like
    that of ``audit``, the split decides where rows are worked on, never which rows there are.
    """
    if hot_rows is None:
        return _named(tags, *_lookup_sides(lookup))
    tags = stored(tags, "elements", FILE_ROWS)
    counts = tags.groupBy("field").count().filter((F.col("count") > hot_rows) & F.col("field").isNotNull())
    hot = stored(counts.select("field"), "hot-fields")  # one for each hot_rows elements at most
    entries = stored(lookup.join(F.broadcast(hot), F.col("field_index") == F.col("field"), "left_semi"), "hot-names")
    frequent = _named(tags.join(F.broadcast(hot), "field", "left_semi").select(*tags.columns), *map(F.broadcast, _lookup_sides(entries)))
    others = tags.join(F.broadcast(hot), "field", "left_anti").select(*tags.columns)
    return frequent.unionByName(_named(others, *_lookup_sides(lookup)))


def pivot_wide(resolved: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per key with one column per name, the greatest value of each.

    Two aggregations instead of one aggregate per name: greatest value per (key, name), combined before
    its shuffle, then at most ``len(names)`` entries per key into a map. The first shuffle spreads a key that repeats
    very often over its names, and gets one row a task of each; so it is not saved. Names outside the list keep their
    record's row alive and add nothing else. Names go by their places in the list, as each column is looked for among the
    values of its row and numbers are compared faster than names.
    """
    keys = list(keys)
    places = {name: place for place, name in enumerate(dict.fromkeys(names))}
    listed = F.array(*map(F.lit, places)).cast("array<string>")
    wanted = resolved.sparkSession.range(1).select(F.posexplode(listed).alias("_place", "column_name"))
    best = (
        resolved.join(F.broadcast(wanted), "column_name", "left")
        .groupBy(*keys, "_place")
        .agg(F.max("value").alias("value"))
    )
    entry = F.when(F.col("_place").isNotNull(), F.struct("_place", "value"))
    packed = best.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("_values"))
    return packed.select(*keys, *[F.col("_values")[places[n]].alias(n) for n in names])


def flatten_wide(
    df: DataFrame,
    lookup: DataFrame,
    names: Sequence[str],
    keys: Sequence[str] = ("recid",),
    xml: str = "xmlrecord",
    hot_rows: int | None = None,
) -> DataFrame:
    """One wide row per key, with the columns ``names``; ``hot_rows`` as in ``resolve_names``."""
    return pivot_wide(resolve_names(unpivot_tags(df, keys, xml), lookup, hot_rows), keys, names)


# ---- per change ------------------------------------------------------------------------------------


def change_records(changes: DataFrame) -> DataFrame:
    """``kafka_partition, kafka_offset, recid, xmlrecord`` of each change, from whichever image there is."""
    return drop_tombstones(changes).select(
        "kafka_partition",
        "kafka_offset",
        image("RECID").alias("recid"),
        image("XMLRECORD").alias("xmlrecord"),
    )


def flatten_events(changes: DataFrame, lookup: DataFrame) -> DataFrame:
    """``columns_parsed`` per change, keyed by its identity so that no change replaces another."""
    keys = ["kafka_partition", "kafka_offset"]
    resolved = resolve_names(unpivot_tags(change_records(changes), [*keys, "recid"]), lookup)
    return resolved.groupBy(*keys).agg(
        F.min("recid").alias("recid"), F.count("column_name").alias("columns_parsed")
    )


# ---- virtual columns -------------------------------------------------------------------------------


def virtual_columns(
    df: DataFrame, columns: Sequence[tuple[str, str, str]], keys: Sequence[str] = ("recid",), xml: str = "xmlrecord"
) -> DataFrame:
    """Typed columns computed from the first element of a field: ``(name, field, type)``.

    Types are ``varchar(n)``, cut to n bytes, or a number type. The record is parsed once for all columns;
    text that is not well-formed gives NULLs instead of failing the job.
    """
    fields = list(dict.fromkeys(field for _, field, _ in columns))
    schema = ", ".join(f"{f} ARRAY<STRING>" for f in fields)
    parsed = df.withColumn("_x", F.from_xml(F.col(xml), schema, {"ignoreSurroundingSpaces": "false"}))

    def column(name: str, field: str, kind: str) -> Column:
        text = element_value(F.col("_x"), field)
        if kind.startswith("varchar"):
            return varchar_bytes(text, int(kind[8:-1])).alias(name)
        return F.trim(text).try_cast(kind).alias(name)

    return parsed.select(*keys, *[column(*c) for c in columns])
