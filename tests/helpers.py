"""Small change logs for tests."""

from __future__ import annotations

from cdcflow.schema import ENVELOPE, UNAVAILABLE

CHANGE = f"{ENVELOPE}, kafka_partition INT, kafka_offset BIGINT, kafka_ts TIMESTAMP"


def record(recid: str, body: str = "") -> str:
    return f'<row id="{recid}">{body}</row>'


def change(op, recid, xml, offset, source_ms=1_000, log_s=2, partition=0):
    """One change row; op None is a tombstone."""
    from datetime import datetime, timezone

    ts = datetime.fromtimestamp(log_s, timezone.utc)
    if op is None:
        return (None, None, None, None, None, partition, offset, ts)
    before = (recid, UNAVAILABLE) if op in ("u", "d") else None
    after = None if op == "d" else (recid, xml)
    return (op, before, after, (source_ms,), source_ms, partition, offset, ts)


def changes(spark, rows):
    return spark.createDataFrame(rows, CHANGE)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]
