"""Stamped copies of records."""

from __future__ import annotations

from pyspark.sql import Column

from cdcflow.functions.records import add_marker, replace_tag, set_record_id
from cdcflow.schema import CLIENT_MARKER, DATABASE_MARKER


def stamp_record(
    template: Column,
    template_id: Column | str,
    recid: Column,
    client_ms: Column | None = None,
    database_ms: Column | None = None,
    values: dict[str, Column] | None = None,
) -> Column:
    """A copy of a record under its own id, with time markers and new values for plain elements."""
    xml = set_record_id(template, template_id, recid)
    for field, value in (values or {}).items():
        xml = replace_tag(xml, field, value)
    if client_ms is not None:
        xml = add_marker(xml, CLIENT_MARKER, client_ms)
    if database_ms is not None:
        xml = add_marker(xml, DATABASE_MARKER, database_ms)
    return xml
