"""Expected answers as SQL over the base columns; none of them goes through record text parsing."""

from __future__ import annotations

from cdcflow.plans.account import POSITIONS

# The change log in terms of the events table.
_EVENTS = """
WITH base AS (
  SELECT event_id, ts, event_type, epoch_us(ts) // 1000 AS ms,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         CASE user_id % 3 WHEN 0 THEN 'BENCH-' WHEN 1 THEN 'LOAD-' ELSE 'BULK-' END
           || CAST(user_id AS VARCHAR) AS recid,
         json_extract_string(props, '$.k') AS k,
         CAST(CAST(value AS DECIMAL(15,2)) AS VARCHAR) AS amount,
         strftime(ts, '%Y%m%d') AS day,
         CAST(user_id % 4 AS INTEGER) AS kafka_partition,
         event_id * 2 + 1000 * (user_id % 4) AS kafka_offset,
         (SELECT max(event_id) + 1 FROM events) AS n
  FROM events),
ev AS (
  SELECT *,
         CASE WHEN op <> 'd' THEN
           '<row id="' || recid || '"><c2>' || k || '</c2><c20>' || CAST(event_id AS VARCHAR) || '</c20><c23>'
           || amount || '</c23><c46>' || day || '</c46>'
           || CASE WHEN event_type = 'purchase' THEN '<c46 m="2">' || day || '</c46>' ELSE '' END
           || CASE WHEN event_id % 4 <> 0 THEN '<bts>' || CAST(ms - 20 - event_id % 50 AS VARCHAR) || '</bts>' ELSE '' END
           || CASE WHEN event_id % 3 <> 0 THEN '<ots>' || CAST(ms AS VARCHAR) || '</ots>' ELSE '' END
           || '</row>' END AS xml,
         ms + event_id % 3000 AS t3
  FROM base)
"""

_MESSAGES = (
    _EVENTS
    + """,
msg AS (
  SELECT kafka_partition, kafka_offset, n, op, recid, xml, ms, t3,
         CASE WHEN op IN ('u', 'd') THEN '__debezium_unavailable_value' END AS before_xml
  FROM ev
  UNION ALL
  SELECT kafka_partition, kafka_offset + 1, n, NULL, NULL, NULL, NULL, t3, NULL FROM ev WHERE op = 'd')
"""
)

_STATE = (
    _EVENTS
    + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY recid ORDER BY event_id DESC) AS rn FROM ev),
state AS (SELECT * FROM ranked WHERE rn = 1 AND op <> 'd')
"""
)

# The latency trace; seeded and unpolled events have no arrival.
_TRACE = (
    _EVENTS
    + """,
timed AS (
  SELECT recid, kafka_partition, kafka_offset, event_id, n,
         CASE op WHEN 'c' THEN 'insert' WHEN 'u' THEN 'update' WHEN 'd' THEN 'delete' ELSE 'snapshot' END AS op,
         CASE WHEN op <> 'd' AND event_id % 4 <> 0 THEN ms - 20 - event_id % 50 END AS t1,
         CASE WHEN op <> 'd' AND event_id % 3 <> 0 THEN ms ELSE ms - ms % 1000 END AS t2,
         CASE WHEN op <> 'd' AND event_id % 3 <> 0 THEN 'exact' ELSE 'second' END AS t2_precision,
         t3,
         CASE WHEN event_id % 10 <> 9 AND event_id >= n // 10 THEN t3 + event_id % 700 END AS t4,
         CASE WHEN event_id % 10 <> 9 AND event_id >= n // 8 AND op <> 'd'
              THEN t3 + event_id % 700 + event_id % 5 END AS t5
  FROM ev),
trace AS (
  SELECT *, t2 - t1 AS gen2ora, t3 - t2 AS ora2kafka, t4 - t3 AS kafka2rw, t5 - t4 AS rw2parsed,
         coalesce(t5, t4) - coalesce(t1, t2) AS total_ms
  FROM timed)
"""
)


def _mean(column: str) -> str:
    """Mean rounded half away from zero, in whole numbers."""
    total, n = f"CAST(sum({column}) AS HUGEINT)", f"count({column})"
    return (
        f"CASE WHEN {n} > 0 THEN CAST(sign({total}) * ((2 * abs({total}) + {n}) // (2 * {n})) AS DECIMAL(20,0)) END"
    )


def _share(column: str) -> str:
    part = f"CAST(sum({column}) AS HUGEINT) * count(total_ms) * 1000"
    whole = f"CAST(sum(total_ms) AS HUGEINT) * count({column})"
    return (
        f"CASE WHEN {whole} <> 0 THEN CAST(CAST(sign({part}) * sign({whole}) * ((2 * abs({part}) + abs({whole})) // "
        f"(2 * abs({whole}))) AS DECIMAL(20,0)) / 10 AS DECIMAL(20,1)) END"
    )


_LEGS = ("gen2ora", "ora2kafka", "kafka2rw", "rw2parsed")
_MEANS = ", ".join(f"{_mean(leg)} AS {leg}" for leg in _LEGS)

_HEADER_XML = """'<row id="ORD-' || CAST(o_orderkey AS VARCHAR) || '"><c1>' || CAST(o_custkey AS VARCHAR) || '</c1><c8>'
  || {status} || '</c8><c23>' || {price} || '</c23><c28>' || {day} || '</c28>{marks}</row>'"""


def _header(status="o_orderstatus", price="CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR)", day=None, marks=""):
    return _HEADER_XML.format(
        status=status, price=price, day=day or "strftime(o_orderdate, '%Y%m%d')", marks=marks
    )


_RECID = "'ORD-' || CAST(o_orderkey AS VARCHAR)"
_URGENT = "o_orderpriority = '1-URGENT'"
_NEW_XML = _header(status="'X$1'")

_TAGS = f"""
SELECT {_RECID} AS recid, 'c1' AS field, NULL AS position, CAST(o_custkey AS VARCHAR) AS value, 'customer' AS column_name FROM orders
UNION ALL SELECT {_RECID}, 'c8', NULL, o_orderstatus, 'order_status' FROM orders
UNION ALL SELECT {_RECID}, 'c20', NULL, CAST(o_orderkey AS VARCHAR), NULL FROM orders
UNION ALL SELECT {_RECID}, 'c20', '2', o_orderpriority, 'priority' FROM orders
UNION ALL SELECT {_RECID}, 'c20', '32', '', 'empty_note' FROM orders
UNION ALL SELECT {_RECID}, 'c23', NULL, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR), 'total_price' FROM orders
UNION ALL SELECT {_RECID}, 'c28', NULL, strftime(o_orderdate, '%Y%m%d'), 'order_date' FROM orders
UNION ALL SELECT DISTINCT 'ORD-' || CAST(l_orderkey AS VARCHAR), 'c46',
  CASE WHEN l_linenumber <> 1 THEN CAST(l_linenumber AS VARCHAR) END, strftime(l_shipdate, '%Y%m%d'),
  'ship_date_0' || CAST(l_linenumber AS VARCHAR)
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
"""

_WIDE = f"""
SELECT {_RECID} AS recid, CAST(o_custkey AS VARCHAR) AS customer, o_orderstatus AS order_status,
  CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS total_price, strftime(o_orderdate, '%Y%m%d') AS order_date,
  CAST(NULL AS VARCHAR) AS order_ref, o_orderpriority AS priority, '' AS empty_note,
  {", ".join(f"ship_date_0{k}" for k in range(1, 8))}
FROM orders LEFT JOIN (
  SELECT l_orderkey, {", ".join(
      f"max(strftime(l_shipdate, '%Y%m%d')) FILTER (l_linenumber = {k}) AS ship_date_0{k}" for k in range(1, 8))}
  FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
"""

_ACCOUNT = f"""
SELECT {_RECID} AS recid, CAST(o_custkey AS VARCHAR) AS customer, o_orderstatus AS status,
  CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS price, strftime(o_orderdate, '%Y%m%d') AS day,
  o_orderpriority AS priority, {", ".join(
      f"{f'day_0{k}' if field == 'c46' and k <= 7 else 'CAST(NULL AS VARCHAR)'} AS group_{field}_{k:02d}"
      for field, last in POSITIONS.items() for k in range(1, last + 1))},
  {", ".join(f"CAST(NULL AS VARCHAR) AS field_{k:02d}" for k in range(160 - sum(POSITIONS.values())))}
FROM orders LEFT JOIN (
  SELECT l_orderkey, {", ".join(
      f"max(strftime(l_shipdate, '%Y%m%d')) FILTER (l_linenumber = {k}) AS day_0{k}" for k in range(1, 8))}
  FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
"""

_AUDIT = (
    _EVENTS
    + """
SELECT recid, op, kafka_partition, kafka_offset,
  lag(xml) OVER (PARTITION BY recid ORDER BY event_id) AS before_xml, xml AS after_xml FROM ev"""
)

_COLUMNS_PARSED = "3 + CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END"
_FLATTEN_EVENTS = (
    _EVENTS
    + f"""
SELECT kafka_partition, kafka_offset, recid, CAST({_COLUMNS_PARSED} AS BIGINT) AS columns_parsed FROM ev WHERE op <> 'd'"""
)

_CURRENT = _STATE + "SELECT recid, xml AS xmlrecord, kafka_offset FROM state"

_ADDED = "o_orderstatus = 'O'"

ORACLES: dict[str, str] = {
    "q_parse_envelope": _MESSAGES
    + """
SELECT kafka_partition, kafka_offset, op, before_xml, xml AS after_xml, recid,
  ms - ms % 1000 AS source_ms, ms + 5 AS ts_ms, t3 AS log_ms FROM msg""",
    "q_decode_op": _MESSAGES
    + """
SELECT kafka_offset, CASE op WHEN 'c' THEN 'insert' WHEN 'u' THEN 'update' WHEN 'd' THEN 'delete'
  WHEN 'r' THEN 'snapshot' END AS op_word FROM msg""",
    "q_drop_tombstones": _EVENTS + "SELECT kafka_partition, kafka_offset, op FROM ev",
    "q_since_offset": _MESSAGES + "SELECT kafka_partition, kafka_offset, op FROM msg WHERE kafka_offset >= n // 2 * 2 + 1000 * kafka_partition",
    "q_bad_messages": _EVENTS
    + """
SELECT kafka_partition, kafka_offset + 1 AS kafka_offset,
  CASE WHEN kafka_offset % 4 = 0 THEN '{"op":"' || op ELSE 'not json' END AS bad_value
FROM ev WHERE event_id % 25 = 0 AND op <> 'd'""",
    "q_state_despite_bad_messages": _CURRENT,
    "q_markers": _TRACE
    + """
SELECT kafka_partition, kafka_offset, recid, op, t1 AS t1_ms, t2 AS t2_ms, t2_precision, t3 AS t3_ms FROM timed""",
    "q_epoch_ms": """
SELECT event_id, (epoch_us(ts) + 500) // 1000 AS ms_by_fields, epoch_us(ts) // 1000 AS ms_by_clock,
  strftime(ts, '%H%M%S-') || lpad(CAST(epoch_us(ts) // 1000 % 1000 AS VARCHAR), 3, '0') AS suffix FROM events""",
    "q_current_state": _CURRENT,
    "q_recreate": _CURRENT,
    "q_record_files": f"SELECT {_RECID} AS recid, {_header()} AS xmlrecord FROM orders",
    "q_stream_current_state": _CURRENT,
    "q_stream_upsert": _CURRENT,
    "q_audit": _AUDIT,
    "q_audit_hot_keys": _AUDIT,
    "q_stream_audit": _AUDIT,
    "q_latest_match": _STATE
    + """
SELECT recid, xml AS xmlrecord, kafka_offset FROM state WHERE recid LIKE 'LOAD-%' ORDER BY recid DESC LIMIT 1""",
    "q_prefix_counts": _STATE
    + """
SELECT count(*) FILTER (recid LIKE 'BENCH-%' OR recid LIKE 'BULK-%') AS matching, count(*) AS total FROM state""",
    "q_delete_prefix": _STATE
    + """
SELECT recid, xml AS xmlrecord, kafka_offset FROM state WHERE NOT (recid LIKE 'BENCH-%' OR recid LIKE 'BULK-%')""",
    "q_delete_latest": _STATE
    + """
SELECT recid, xml AS xmlrecord, kafka_offset FROM state
WHERE recid <> (SELECT max(recid) FROM state WHERE recid LIKE 'LOAD-%')""",
    "q_merge_upsert": f"""
SELECT {_RECID} AS recid, CASE WHEN {_URGENT} THEN {_NEW_XML} ELSE {_header()} END AS xmlrecord
FROM orders WHERE o_orderstatus <> 'O' OR {_URGENT}""",
    "q_apply_update": f"""
SELECT {_RECID} AS recid, CASE WHEN {_URGENT} THEN {_NEW_XML} ELSE {_header()} END AS xmlrecord
FROM orders WHERE o_orderstatus <> 'O'""",
    "q_missing_keys": f"SELECT {_RECID} AS recid FROM orders WHERE {_URGENT} AND o_orderstatus = 'O'",
    "q_initial_snapshot": f"""
SELECT 'r' AS op, {_RECID} AS recid, CAST(NULL AS VARCHAR) AS before_xml, {_header()} AS after_xml FROM orders""",
    "q_snapshot_diff": f"""
SELECT CASE WHEN {_ADDED} THEN 'c' WHEN o_orderstatus = 'F' THEN 'd' ELSE 'u' END AS op, {_RECID} AS recid,
  CASE WHEN {_ADDED} THEN NULL ELSE '__debezium_unavailable_value' END AS before_xml,
  CASE WHEN o_orderstatus = 'F' THEN NULL WHEN {_URGENT} THEN {_NEW_XML} ELSE {_header()} END AS after_xml
FROM orders WHERE o_orderstatus IN ('O', 'F') OR {_URGENT}""",
    "q_publish_diff": f"""
SELECT {_RECID} AS key, false AS is_tombstone, CASE WHEN {_ADDED} THEN 'c' ELSE 'd' END AS op,
  CASE WHEN NOT {_ADDED} THEN '__debezium_unavailable_value' END AS before_xml,
  CASE WHEN {_ADDED} THEN {_header()} END AS after_xml
FROM orders WHERE o_orderstatus IN ('O', 'F')
UNION ALL SELECT {_RECID}, true, NULL, NULL, NULL FROM orders WHERE o_orderstatus = 'F'""",
    "q_unpivot_tags": f"SELECT recid, field, position, value FROM ({_TAGS})",
    "q_resolve_names": _TAGS,
    "q_flatten_wide": _WIDE,
    "q_flatten_large_lookup": _WIDE,
    "q_flatten_repeated_keys": _WIDE.replace("o_orderstatus AS order_status", "'X$1' AS order_status"),
    "q_large_lookup": _TAGS
    + f"""
UNION ALL SELECT {_RECID}, 'c' || CAST(o_orderkey + 1000 AS VARCHAR), NULL, 'x', 'name_' || CAST(o_orderkey AS VARCHAR) FROM orders""",
    "q_account_view": _ACCOUNT,
    "q_account_virtual": f"""
SELECT {_RECID} AS recid, o_orderstatus AS currency, CAST(o_custkey AS DECIMAL(38,0)) AS customer,
  CAST(NULL AS DECIMAL(38,0)) AS category, {", ".join(
      f"CAST(NULL AS VARCHAR) AS {n}" for n in ("co_code", "mnemonic", "curr_no", "posting_restrict", "opening_date", "int_no_booking"))}
FROM orders""",
    "q_capture_trace": f"""
WITH diff AS (
  SELECT {_RECID} AS recid, CASE WHEN {_ADDED} THEN 'insert' ELSE 'delete' END AS op,
    CAST(o_orderkey % 4 AS INTEGER) AS kafka_partition
  FROM orders WHERE o_orderstatus IN ('O', 'F'))
SELECT recid, op, kafka_partition,
  row_number() OVER (PARTITION BY kafka_partition ORDER BY recid) - 1 + 100 * kafka_partition AS kafka_offset,
  NULL::BIGINT AS t1_generated, 1700000000000::BIGINT AS t2_oracle, 1700000000123::BIGINT AS t3_kafka,
  NULL::BIGINT AS t4_risingwave, NULL::BIGINT AS t5_parsed, NULL::BIGINT AS gen_to_oracle_ms,
  123::BIGINT AS oracle_to_kafka_ms, NULL::BIGINT AS kafka_to_rw_ms, NULL::BIGINT AS rw_to_parsed_ms,
  NULL::BIGINT AS total_ms, 'second' AS t2_precision FROM diff""",
    "q_live_views": _STATE
    + """,
h AS (SELECT split_part(recid, '-', 1) AS workload, count(*) AS changes, count(before_xml) AS with_before FROM (
  SELECT recid, lag(xml) OVER (PARTITION BY recid ORDER BY event_id) AS before_xml FROM ev) GROUP BY 1),
s AS (SELECT split_part(recid, '-', 1) AS workload, count(*) AS live_records,
        count(*) FILTER (event_type = 'purchase') AS with_second_day FROM state GROUP BY 1)
SELECT h.workload, changes, with_before, live_records, with_second_day FROM h LEFT JOIN s ON s.workload = h.workload""",
    "q_flatten_events": _FLATTEN_EVENTS,
    "q_stream_flatten_events": _FLATTEN_EVENTS,
    "q_virtual_columns": f"""
SELECT {_RECID} AS recid, {_RECID} AS xml_id, CAST(o_custkey AS DECIMAL(38,0)) AS customer, o_orderstatus AS order_status,
  substr(CAST(o_orderkey AS VARCHAR), 1, 3) AS priority_cut,
  CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS total_price,
  CAST(strftime(o_orderdate, '%Y%m%d') AS DECIMAL(38,0)) AS order_day, CAST(NULL AS DECIMAL(38,0)) AS status_number,
  CAST(NULL AS VARCHAR) AS missing FROM orders""",
    "q_stage_union": _EVENTS
    + """
SELECT 'raw' AS stage, kafka_partition, kafka_offset FROM ev
UNION ALL SELECT 'parsed', kafka_partition, kafka_offset FROM ev WHERE op <> 'd'""",
    "q_first_visibility": _TRACE
    + """
SELECT kafka_partition, kafka_offset, t4 AS t4_ms, t5 AS t5_ms FROM timed
WHERE t4 IS NOT NULL AND NOT event_id BETWEEN n // 5 AND n * 3 // 10""",
    "q_trace": _TRACE
    + """
SELECT recid, op, kafka_partition, kafka_offset, t1 AS t1_generated, t2 AS t2_oracle, t3 AS t3_kafka,
  t4 AS t4_risingwave, t5 AS t5_parsed, gen2ora AS gen_to_oracle_ms, ora2kafka AS oracle_to_kafka_ms,
  kafka2rw AS kafka_to_rw_ms, rw2parsed AS rw_to_parsed_ms, total_ms, t2_precision FROM trace""",
    "q_trace_listing": _TRACE
    + """
SELECT recid, op, kafka_offset AS "offset", t1 AS t1_generated, t2 AS t2_oracle, t3 AS t3_kafka, t4 AS t4_risingwave,
  t5 AS t5_parsed, gen2ora, ora2kafka, kafka2rw, rw2parsed, total_ms, t2_precision AS prec
FROM trace ORDER BY kafka_offset""",
    "q_untimed": _TRACE + "SELECT recid, op, kafka_offset, t2_precision FROM trace WHERE total_ms IS NULL",
    "q_report_totals": _TRACE
    + """
SELECT count(*) AS changes, count(total_ms) AS timed, count(*) - count(total_ms) AS untimed,
  count(t1) AS with_client_stamp, min(t2) AS first_change, max(t2) AS last_change,
  min(kafka_offset) AS first_offset, max(kafka_offset) AS last_offset FROM trace""",
    "q_report_by_op": _TRACE
    + f"""
SELECT op, count(*) AS changes, count(total_ms) AS timed, count(*) - count(total_ms) AS untimed,
  {_mean("total_ms")} AS total_avg, min(total_ms) AS total_min, max(total_ms) AS total_max
FROM trace GROUP BY op ORDER BY op""",
    "q_report_by_workload": _TRACE
    + f"""
SELECT split_part(recid, '-', 1) AS workload, op, count(*) AS changes, {_MEANS}, {_mean("total_ms")} AS total_avg
FROM trace WHERE total_ms IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 2""",
    "q_report_leg_share": _TRACE
    + f"""
SELECT {", ".join(f"{_share(leg)} AS {leg}_pct" for leg in _LEGS)}
FROM trace WHERE total_ms IS NOT NULL AND gen2ora IS NOT NULL""",
    "q_report_run": _TRACE
    + f"""
SELECT op, count(*) AS changes, {_MEANS}, {_mean("total_ms")} AS total_avg, min(total_ms) AS total_min,
  max(total_ms) AS total_max
FROM trace WHERE total_ms IS NOT NULL AND kafka_offset >= n // 2 * 2 + 1000 * kafka_partition GROUP BY op ORDER BY op""",
    "q_sql_views": _TRACE
    + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY recid ORDER BY event_id DESC) AS rn FROM ev),
t AS (SELECT split_part(recid, '-', 1) AS workload, count(*) AS changes, max(total_ms) AS slowest_ms
      FROM trace GROUP BY 1),
s AS (SELECT split_part(recid, '-', 1) AS workload, count(*) AS live_records,
        count(*) FILTER (event_type = 'purchase') AS with_second_day
      FROM ranked WHERE rn = 1 AND op <> 'd' GROUP BY 1)
SELECT t.workload, changes, slowest_ms, live_records, with_second_day FROM t LEFT JOIN s ON s.workload = t.workload""",
    "q_stamp_records": f"""
SELECT 'COPY-' || CAST(o_orderkey AS VARCHAR) AS recid, replace({
        _header(
            status="'a' || chr(92) || 'b$0'",
            price="CAST(CAST(o_custkey AS DECIMAL(10,2)) AS VARCHAR)",
            day="'-' || CAST(o_custkey AS VARCHAR)",
            marks="<bts>' || CAST(epoch_ms(o_orderdate) AS VARCHAR) || '</bts><ots>'"
            " || CAST(epoch_ms(o_orderdate) + 5 AS VARCHAR) || '</ots>",
        )
    }, '"ORD-', '"COPY-') AS xmlrecord FROM orders""",
    "q_keyed_amounts": """
SELECT o_orderkey, CAST(CAST(((o_orderkey % 2147483647 * 48271 + 11) % 2147483647 * 69621 + 7) % 2147483647 % 9899901 + 100000
  AS DOUBLE) / 100 AS DECIMAL(17,2)) AS amount FROM orders""",
    "q_stream_events": _MESSAGES + "SELECT kafka_partition, kafka_offset, op, ms + 5 AS ts_ms FROM msg",
    "q_stream_flatten": _STATE
    + """
SELECT recid, kafka_offset, k AS counter, CAST(NULL AS VARCHAR) AS order_ref, amount AS total_price,
  day AS ship_date_01, CASE WHEN event_type = 'purchase' THEN day END AS ship_date_02 FROM state""",
    "q_stream_large_lookup": _STATE
    + """
SELECT recid, kafka_offset, k AS counter, CAST(NULL AS VARCHAR) AS order_ref, amount AS total_price,
  day AS ship_date_01, CASE WHEN event_type = 'purchase' THEN day END AS ship_date_02 FROM state""",
    "q_stream_lookup_change": _STATE
    + """
SELECT recid, kafka_offset, k AS counter, CAST(NULL AS VARCHAR) AS order_ref, amount AS total_price,
  day AS ship_date_01, CASE WHEN event_type = 'purchase' THEN day END AS ship_date_02 FROM state""",
    "q_stream_versions": _EVENTS
    + """,
upto AS (SELECT 3 AS batches UNION ALL SELECT 5),
ranked AS (SELECT ev.*, batches, row_number() OVER (PARTITION BY batches, recid ORDER BY event_id DESC) AS rn
           FROM ev, upto WHERE event_id < n * batches // 5)
SELECT recid, xml AS xmlrecord, kafka_offset, batches FROM ranked WHERE rn = 1 AND op <> 'd'""",
    "q_stream_followed_view": _STATE
    + """
SELECT split_part(recid, '-', 1) AS workload, count(*) AS live_records, max(kafka_offset) AS newest_offset
FROM state GROUP BY 1""",
    "q_stream_trace": _TRACE
    + """
SELECT op, count(*) AS changes, count(*) AS timed, count(*) FILTER (op <> 'delete') AS parsed,
  0::BIGINT AS negative_legs FROM timed GROUP BY op""",
}

# The same changes on tables of files.
ORACLES |= {
    "q_merge_files": ORACLES["q_merge_upsert"],
    "q_upsert_marks": ORACLES["q_merge_upsert"],
    "q_update_marks": ORACLES["q_apply_update"],
    "q_delete_vectors": ORACLES["q_delete_prefix"],
}

# The same reports, kept up to date.
ORACLES |= {"q_live_reports": ORACLES["q_report_by_workload"], "q_live_report_by_op": ORACLES["q_report_by_op"]}
ORACLES |= {"q_snapshot_diff_ranges": ORACLES["q_snapshot_diff"]}
