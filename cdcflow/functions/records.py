"""Expressions over the text of a record: its elements, id, time markers and stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cdcflow.schema import TAG_PATTERN


def tag_matches(xml: Column) -> Column:
    """The text of every element of a record, in order; the pattern runs over the record once."""
    return F.regexp_extract_all(xml, F.lit(TAG_PATTERN), F.lit(0))


def tag_parts(match: Column) -> dict[str, Column]:
    """``field, position, value`` of one of ``tag_matches``, cut out by place.

    A missing position is NULL. An empty value stays ``''``, because an empty element is a value.
    """
    field = F.substring_index(F.substring_index(match, "</", -1), ">", 1)
    opening = F.substring_index(match, ">", 1)
    position = F.substring_index(F.substring_index(opening, '"', 2), '"', -1)
    begin = F.length(opening) + 2
    return {
        "field": field,
        "position": F.when(opening.contains('"'), position),
        "value": F.substr(match, begin, F.length(match) - begin - F.length(field) - 2),
    }


def has_tags(xml: Column) -> Column:
    """True when at least one element matches; stops at the first match."""
    return F.coalesce(F.regexp_like(xml, F.lit(TAG_PATTERN)), F.lit(False))


def marker_ms(xml: Column, name: str) -> Column:
    """The epoch milliseconds between ``<name>`` and ``</name>``, NULL without the marker."""
    after_open = F.split_part(xml, F.lit(f"<{name}>"), F.lit(2))
    text = F.split_part(after_open, F.lit(f"</{name}>"), F.lit(1))
    return F.when(has_marker(xml, name), text.try_cast("bigint"))


def has_marker(xml: Column, name: str) -> Column:
    return F.coalesce(xml.contains(f"<{name}>"), F.lit(False))


def add_marker(xml: Column, name: str, ms: Column) -> Column:
    """Write ``<name>ms</name>`` in front of the closing tag of the record."""
    closing = F.concat(F.lit(f"<{name}>"), ms.cast("string"), F.lit(f"</{name}></row>"))
    return F.replace(xml, F.lit("</row>"), closing)


def set_record_id(xml: Column, old_id: Column | str, new_id: Column) -> Column:
    """Swap the ``id="..."`` of a template for the id of a copy."""
    old = F.lit(old_id) if isinstance(old_id, str) else old_id
    quote = F.lit('"')
    return F.replace(xml, F.concat(F.lit('id="'), old, quote), F.concat(F.lit('id="'), new_id, quote))


def replace_tag(xml: Column, field: str, value: Column) -> Column:
    """Give every plain ``<field>`` element a new value."""
    pattern = f"<{field}>[^<]*</{field}>"
    # A replacement text gives $ and \ a meaning of their own, so quote both.
    quoted = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    return F.regexp_replace(xml, F.lit(pattern), F.concat(F.lit(f"<{field}>"), quoted, F.lit(f"</{field}>")))


def record_id(xml: Column) -> Column:
    """The ``id`` attribute of ``/row``; NULL for text that is not such a record."""
    return F.from_xml(xml, "_id STRING", {"ignoreSurroundingSpaces": "false"})["_id"]


def element_value(parsed: Column, field: str) -> Column:
    """First ``field`` element of a record parsed by ``from_xml``; empty text is NULL, as in the database."""
    return F.nullif(F.get(parsed[field], F.lit(0)), F.lit(""))


def varchar_bytes(text: Column, size: int) -> Column:
    """Cut text to ``size`` UTF-8 bytes without leaving half a character at the end."""
    cut = F.make_valid_utf8(F.substring(text.cast("binary"), 1, size).cast("string"))
    return F.when(F.octet_length(text) <= size, text).otherwise(F.regexp_replace(cut, "�+$", ""))
