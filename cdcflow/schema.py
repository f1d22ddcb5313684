"""Schemas and fixed values shared by every module.

A *message* is one record of a change log topic: ``value`` (JSON text) plus ``partition``, ``offset``
and ``timestamp``. A *change* is a parsed message: ``op, before, after, source, ts_ms`` and the same
metadata as ``kafka_partition, kafka_offset, kafka_ts``. The identity of a change is its
``(kafka_partition, kafka_offset)``; all changes of one record key live in one partition, so offsets
order them.
"""

from __future__ import annotations

# ---- fixed values (they have to equal what the producers of the data write) ----------------------

# One element of a record: <cN>text</cN> or <cN m="K">text</cN>; groups are field, position, value.
TAG_PATTERN = r'<(c\d+)(?:\s+m="(\d+)")?>([^<]*)</\1>'

# Payload of an image that the capture side could not supply.
UNAVAILABLE = "__debezium_unavailable_value"

# Operation codes of a change and the word each one is reported as.
OP_WORDS = {"c": "insert", "u": "update", "d": "delete", "r": "snapshot"}

# Time markers inside a record: written by the client, and by the database.
CLIENT_MARKER = "bts"
DATABASE_MARKER = "ots"

# Key prefixes of the workload generators.
MIXED_PREFIX = "BENCH-"
CONTINUOUS_PREFIX = "LOAD-"
BULK_PREFIX = "BULK-"
WORKLOAD_PREFIXES = (MIXED_PREFIX, CONTINUOUS_PREFIX, BULK_PREFIX)

# Columns of the latency trace, in report order.
TRACE_COLUMNS = (
    "recid",
    "op",
    "kafka_partition",
    "kafka_offset",
    "t1_generated",
    "t2_oracle",
    "t3_kafka",
    "t4_risingwave",
    "t5_parsed",
    "gen_to_oracle_ms",
    "oracle_to_kafka_ms",
    "kafka_to_rw_ms",
    "rw_to_parsed_ms",
    "total_ms",
    "t2_precision",
)

# ---- schemas (DDL) --------------------------------------------------------------------------------

RECORD = "recid STRING NOT NULL, xmlrecord STRING"
IMAGE = "STRUCT<RECID: STRING, XMLRECORD: STRING>"
ENVELOPE = f"op STRING, before {IMAGE}, after {IMAGE}, source STRUCT<ts_ms: BIGINT>, ts_ms BIGINT"
MESSAGE = "key STRING, value STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
LOOKUP = "field_index STRING, m_index STRING, resolved_name_en STRING, is_multivalue BOOLEAN"
LOOKUP_CSV = "table_name STRING, field_index STRING, m_index STRING, resolved_name_en STRING, dt STRING"
OBSERVATION = "kafka_partition INT, kafka_offset BIGINT, stage STRING, seen_ms BIGINT"
ARRIVAL = "kafka_partition INT, kafka_offset BIGINT, t4_ms BIGINT, t5_ms BIGINT"

EVENT_KEY = ["kafka_partition", "kafka_offset"]
