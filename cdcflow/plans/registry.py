"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.functions.numbers import keyed_amount
from cdcflow.functions.records import record_id, replace_tag
from cdcflow.functions.times import epoch_ms_by_fields, epoch_ms_of_utc, stamp_suffix
from cdcflow.operators import audit as history
from cdcflow.operators import flatten, mutate, partials, reports, state, visibility
from cdcflow.operators import trace as tracing
from cdcflow.plans import account
from cdcflow.plans import testdata as data
from cdcflow.plans.views import register_live_views, register_views
from cdcflow.schema import BULK_PREFIX, MIXED_PREFIX
from cdcflow.session import scratch_dir
from cdcflow.sources import capture, envelope, workload
from cdcflow.sources.filetable import FileTable
from cdcflow.sources.records import read_records
from cdcflow.sources.tables import append_rows, recreate
from cdcflow.streaming import arrivals as landing
from cdcflow.streaming import current, feed, live, reporting, wide
from cdcflow.streaming import history as live_history
from cdcflow.streaming.keyed import KeyedTable

Query = Callable[[SparkSession, str], DataFrame]

# ---- messages and changes --------------------------------------------------------------------------


def q_parse_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.changes(spark, sf_dir).select(
        "kafka_partition",
        "kafka_offset",
        "op",
        F.col("before.XMLRECORD").alias("before_xml"),
        F.col("after.XMLRECORD").alias("after_xml"),
        envelope.image("RECID").alias("recid"),
        F.col("source.ts_ms").alias("source_ms"),
        "ts_ms",
        F.unix_millis("kafka_ts").alias("log_ms"),
    )


def q_decode_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.changes(spark, sf_dir).select("kafka_offset", envelope.decode_op(F.col("op")).alias("op_word"))


def q_drop_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.drop_tombstones(data.changes(spark, sf_dir)).select("kafka_partition", "kafka_offset", "op")


def q_since_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = data.half_run(spark, sf_dir)
    return envelope.since_offset(data.changes(spark, sf_dir), start).select("kafka_partition", "kafka_offset", "op")


def q_bad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged messages out of a log that has some."""
    parsed = envelope.parse_envelope(data.damaged_messages(spark, sf_dir), on_bad="keep")
    return envelope.bad_messages(parsed).select("kafka_partition", "kafka_offset", "bad_value")


def q_state_despite_bad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.current_state(envelope.parse_envelope(data.damaged_messages(spark, sf_dir), on_bad="keep"))


def q_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracing.markers(data.changes(spark, sf_dir))


def q_epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.table(spark, sf_dir, "events").select(
        "event_id",
        epoch_ms_by_fields(F.col("ts")).alias("ms_by_fields"),
        epoch_ms_of_utc(F.col("ts")).alias("ms_by_clock"),
        stamp_suffix(F.col("ts")).alias("suffix"),
    )


# ---- state -----------------------------------------------------------------------------------------


def q_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.current_state(data.changes(spark, sf_dir))


def q_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.audit(data.changes(spark, sf_dir))


def q_audit_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history with every key with more than ten changes split into offset ranges."""
    return history.audit(data.changes(spark, sf_dir), 10, 1500)


def q_latest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = state.current_state(data.changes(spark, sf_dir))
    return state.latest_match(now, F.col("recid").like("LOAD-%"), "recid")


def q_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = state.current_state(data.changes(spark, sf_dir))
    return state.count_where(now, mutate.has_prefix("recid", MIXED_PREFIX, BULK_PREFIX))


def q_delete_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = state.current_state(data.changes(spark, sf_dir))
    return mutate.delete_where(now, mutate.has_prefix("recid", MIXED_PREFIX, BULK_PREFIX))


def q_delete_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state without its last LOAD key."""
    now = state.current_state(data.changes(spark, sf_dir))
    return mutate.delete_keys(now, state.latest_match(now, F.col("recid").like("LOAD-%"), "recid"))


# ---- writes on tables ------------------------------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str, condition: Column) -> DataFrame:
    return data.order_records(data.table(spark, sf_dir, "orders").filter(condition))


def _settled() -> Column:
    return F.col("o_orderstatus") != "O"


def _urgent_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New payloads of the urgent orders."""
    urgent = _orders(spark, sf_dir, F.col("o_orderpriority") == "1-URGENT")
    return urgent.withColumn("xmlrecord", replace_tag(F.col("xmlrecord"), "c8", F.lit("X$1")))


def q_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mutate.merge_upsert(_orders(spark, sf_dir, _settled()), _urgent_updates(spark, sf_dir))


def q_apply_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mutate.apply_update(_orders(spark, sf_dir, _settled()), _urgent_updates(spark, sf_dir))


def q_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mutate.missing_keys(_orders(spark, sf_dir, _settled()), _urgent_updates(spark, sf_dir))


def _order_files(spark: SparkSession, sf_dir: str) -> FileTable:
    """The settled orders as a table that is changed file by file."""
    table = FileTable(spark, scratch_dir(spark, "order-files"))
    table.create(_orders(spark, sf_dir, _settled()))
    return table


def q_merge_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As q_merge_upsert, by writing the touched files anew."""
    table = _order_files(spark, sf_dir)
    table.merge(_urgent_updates(spark, sf_dir))
    return table.read()


def q_upsert_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As q_merge_upsert, by marking old rows and adding files."""
    table = _order_files(spark, sf_dir)
    table.upsert(_urgent_updates(spark, sf_dir))
    return table.read()


def q_update_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As q_apply_update, by marking old rows and adding files."""
    table = _order_files(spark, sf_dir)
    table.update(_urgent_updates(spark, sf_dir), ["xmlrecord"])
    return table.read()


def q_delete_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As q_delete_prefix, by marks; those of the first prefix are folded in before the second one goes."""
    table = FileTable(spark, scratch_dir(spark, "state-files"))
    table.create(state.current_state(data.changes(spark, sf_dir)))
    table.delete(mutate.has_prefix("recid", MIXED_PREFIX))
    table.fold()
    table.delete(mutate.has_prefix("recid", BULK_PREFIX))
    return table.read()


def q_recreate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state written as a table twice, and read."""
    path = scratch_dir(spark, "state")
    for _ in range(2):
        recreate(state.current_state(data.changes(spark, sf_dir)), path)
    return spark.read.parquet(path)


def q_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order record, written to text files of many records and read back."""
    path = scratch_dir(spark, "records")
    _orders(spark, sf_dir, F.lit(True)).select("xmlrecord").write.text(path)
    return read_records(spark, path, one_per_file=False)


def _flat_envelope(changes: DataFrame) -> DataFrame:
    return changes.select(
        "op",
        envelope.image("RECID").alias("recid"),
        F.col("before.XMLRECORD").alias("before_xml"),
        F.col("after.XMLRECORD").alias("after_xml"),
    )


def q_initial_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_envelope(capture.snapshot(_orders(spark, sf_dir, F.lit(True))))


def q_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _orders(spark, sf_dir, _settled())
    new = _orders(spark, sf_dir, F.col("o_orderstatus") != "F")
    new = mutate.apply_update(new, _urgent_updates(spark, sf_dir))
    return _flat_envelope(capture.snapshot_diff(old, new))


def q_snapshot_diff_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same difference by digests of key ranges."""
    old = _orders(spark, sf_dir, _settled())
    new = _orders(spark, sf_dir, F.col("o_orderstatus") != "F")
    new = mutate.apply_update(new, _urgent_updates(spark, sf_dir))
    return _flat_envelope(capture.snapshot_diff_ranges(old, new))


def q_publish_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The difference of two states, published as messages and parsed again."""
    old = _orders(spark, sf_dir, _settled())
    new = _orders(spark, sf_dir, F.col("o_orderstatus") != "F")
    sent = envelope.to_messages(capture.snapshot_diff(old, new))
    parsed = envelope.parse_envelope(sent)
    return parsed.select(
        "key", "is_tombstone", "op", F.col("before.XMLRECORD").alias("before_xml"), F.col("after.XMLRECORD").alias("after_xml")
    )


# ---- flattening ------------------------------------------------------------------------------------


def q_unpivot_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.unpivot_tags(data.orders_xml(spark, sf_dir), ["recid"])


def q_resolve_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = flatten.unpivot_tags(data.orders_xml(spark, sf_dir), ["recid"])
    return flatten.resolve_names(tags, data.lookup_file(spark))


def q_large_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names out of a lookup that grows with the orders: each record has one element with an entry of its own."""
    number = F.split_part("recid", F.lit("-"), F.lit(2)).cast("bigint") + 1000
    field = F.concat(F.lit("c"), number.cast("string"))
    element = F.concat(F.lit("<"), field, F.lit(">x</"), field, F.lit("></row>"))
    records = data.orders_xml(spark, sf_dir).withColumn("xmlrecord", F.replace("xmlrecord", F.lit("</row>"), element))
    return flatten.resolve_names(flatten.unpivot_tags(records, ["recid"]), data.large_lookup(spark, sf_dir), flatten.HOT_ROWS)


def q_flatten_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.flatten_wide(data.orders_xml(spark, sf_dir), data.lookup(spark), data.ORDER_COLUMNS)


def q_flatten_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two records of each key: one wide row, with the greatest value of each column."""
    second = _orders(spark, sf_dir, F.lit(True))
    second = second.withColumn("xmlrecord", replace_tag(F.col("xmlrecord"), "c8", F.lit("X$1")))
    records = data.orders_xml(spark, sf_dir).unionByName(second)
    return flatten.flatten_wide(records, data.lookup(spark), data.ORDER_COLUMNS)


def q_flatten_large_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.flatten_wide(data.orders_xml(spark, sf_dir), data.large_lookup(spark, sf_dir), data.ORDER_COLUMNS, hot_rows=flatten.HOT_ROWS)


def q_flatten_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.flatten_events(data.changes(spark, sf_dir), data.lookup(spark))


def q_account_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return account.account_view(data.orders_xml(spark, sf_dir), data.account_lookup(spark))


def q_account_virtual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return account.account_virtual_columns(data.orders_xml(spark, sf_dir))


def q_virtual_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = (
        ("customer", "c1", "decimal(38,0)"),
        ("order_status", "c8", "varchar(250)"),
        ("priority_cut", "c20", "varchar(3)"),
        ("total_price", "c23", "varchar(250)"),
        ("order_day", "c28", "decimal(38,0)"),
        ("status_number", "c8", "decimal(38,0)"),
        ("missing", "c77", "varchar(250)"),
    )
    records = data.orders_xml(spark, sf_dir).withColumn("xml_id", record_id(F.col("xmlrecord")))
    return flatten.virtual_columns(records, columns, keys=["recid", "xml_id"])


# ---- latency trace ---------------------------------------------------------------------------------


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visibility.first_visibility(
        data.observations(spark, sf_dir), data.seed(spark, sf_dir), data.nothing_recorded(spark)
    )


def _trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracing.trace(data.changes(spark, sf_dir), _arrivals(spark, sf_dir))


def _as_ms(df: DataFrame) -> DataFrame:
    """Timestamps as epoch milliseconds, so that a comparison needs no time zone."""
    return df.select(
        *[F.unix_millis(c).alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes]
    )


def q_stage_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = data.changes(spark, sf_dir)
    parsed = flatten.flatten_events(changes, data.lookup(spark))
    return visibility.stage_union(envelope.drop_tombstones(changes), parsed)


def q_first_visibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended to a table of arrivals and read back."""
    path = scratch_dir(spark, "arrivals")
    append_rows(
        visibility.first_visibility(
            data.observations(spark, sf_dir), data.seed(spark, sf_dir), data.recorded(spark, sf_dir)
        ),
        path,
    )
    return spark.read.parquet(path)


def q_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_ms(_trace(spark, sf_dir))


def q_trace_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_ms(tracing.trace_listing(_trace(spark, sf_dir)))


def q_untimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracing.untimed(_trace(spark, sf_dir)).select("recid", "op", "kafka_offset", "t2_precision")


def q_report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_ms(reports.report_totals(_trace(spark, sf_dir)))


def q_report_by_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_by_op(_trace(spark, sf_dir))


def q_report_by_workload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_by_workload(_trace(spark, sf_dir))


def q_report_leg_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_leg_share(_trace(spark, sf_dir))


def q_report_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_run(_trace(spark, sf_dir), data.half_run(spark, sf_dir))


def q_sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report in SQL over the registered views: state, wide rows and trace by workload."""
    register_views(
        spark,
        data.changes(spark, sf_dir),
        data.lookup(spark),
        _arrivals(spark, sf_dir),
        data.EVENT_COLUMNS,
        prefix="given_",
    )
    return spark.sql(
        """
        SELECT t.workload, t.changes, t.slowest_ms, s.live_records, s.with_second_day
        FROM (SELECT split_part(recid, '-', 1) AS workload, count(*) AS changes, max(total_ms) AS slowest_ms
              FROM given_cdc_trace GROUP BY 1) t
        LEFT JOIN (SELECT split_part(a.recid, '-', 1) AS workload, count(*) AS live_records,
                          count(c.ship_date_02) AS with_second_day
                   FROM given_account a LEFT JOIN given_account_columns c ON c.recid = a.recid GROUP BY 1) s
          ON s.workload = t.workload
        """
    )


# ---- workloads -------------------------------------------------------------------------------------


def q_stamp_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = data.table(spark, sf_dir, "orders")
    records = data.order_records(orders, "o_orderkey", "o_orderdate", "o_custkey")
    recid = F.concat(F.lit("COPY-"), F.col("o_orderkey").cast("string"))
    client_ms = epoch_ms_of_utc(F.col("o_orderdate"))
    values = {
        "c8": F.lit("a\\b$0"),
        "c23": F.col("o_custkey").cast("decimal(10,2)").cast("string"),
        "c28": F.concat(F.lit("-"), F.col("o_custkey").cast("string")),
    }
    xml = workload.stamp_record(F.col("xmlrecord"), F.col("recid"), recid, client_ms, client_ms + 5, values)
    return records.select(recid.alias("recid"), xml.alias("xmlrecord"))


def q_keyed_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeatable random amounts, one for each order."""
    return data.table(spark, sf_dir, "orders").select("o_orderkey", keyed_amount(F.col("o_orderkey"), 1000, 99999).alias("amount"))


def q_capture_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The difference of two states, placed in a log of four partitions and traced."""
    old = _orders(spark, sf_dir, _settled())
    new = _orders(spark, sf_dir, F.col("o_orderstatus") != "F")
    diff = capture.snapshot_diff(old, new)
    number = F.split_part(envelope.image("RECID"), F.lit("-"), F.lit(2)).cast("bigint")
    log = capture.as_log(diff, 1_700_000_000_123, 4, {p: 100 * p for p in range(4)}, number)
    arrivals = visibility.first_visibility(
        data.observations(spark, sf_dir).filter(F.lit(False)), data.seed(spark, sf_dir).filter(F.lit(False)), data.nothing_recorded(spark)
    )
    return _as_ms(tracing.trace(log, arrivals))


# ---- streams: each over several micro-batches ------------------------------------------------------


def q_stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of the stream, landed append-only."""
    path = scratch_dir(spark, "stream-events")
    rows = data.change_feed(spark, sf_dir).select("kafka_partition", "kafka_offset", "op", "ts_ms")
    feed.run_to_end(live.materialize(rows, f"{path}/table", f"{path}/checkpoint", None, None))
    return spark.read.parquet(f"{path}/table").drop("batch_id")


def q_stream_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "stream-state")
    rows = current.current_state_stream(data.change_feed(spark, sf_dir))
    feed.run_to_end(live.materialize(rows, f"{path}/table", f"{path}/checkpoint", ["recid"], None, 2))
    return live.read_live(spark, f"{path}/table", ["recid"])


def q_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "stream-upsert")
    changes = data.change_feed(spark, sf_dir)
    feed.run_to_end(current.upsert_stream(changes, f"{path}/table", f"{path}/checkpoint", None, 2))
    return current.read_state(spark, f"{path}/table")


def q_stream_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "stream-flatten")
    changes, lookup = data.change_feed(spark, sf_dir), data.lookup(spark)
    feed.run_to_end(current.flatten_stream(changes, lookup, data.EVENT_COLUMNS, f"{path}/table", f"{path}/checkpoint", None, 2))
    return current.read_wide(spark, f"{path}/table")


def q_stream_large_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup grows with the orders, and each micro-batch reads it anew."""
    path = scratch_dir(spark, "stream-large-lookup")
    changes = data.change_feed(spark, sf_dir)
    query = current.flatten_stream(
        changes, lambda s: data.large_lookup(s, sf_dir), data.EVENT_COLUMNS, f"{path}/table", f"{path}/checkpoint", None, 2
    )
    feed.run_to_end(query)
    return current.read_wide(spark, f"{path}/table")


def q_stream_flatten_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "stream-flatten-events")
    changes = data.change_feed(spark, sf_dir)
    feed.run_to_end(current.flatten_events_stream(changes, data.lookup(spark), f"{path}/table", f"{path}/checkpoint", None))
    return spark.read.parquet(f"{path}/table").drop("batch_id")


def q_stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "stream-audit")
    feed.run_to_end(live_history.audit_stream(data.change_feed(spark, sf_dir), path, seconds=None, every=2))
    return live_history.read_audit(spark, path)


def q_live_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report in SQL over live state, live wide rows and live history, three streams of one topic."""
    path, lookup, changes = scratch_dir(spark, "live-views"), data.lookup(spark), data.change_feed(spark, sf_dir)
    feed.run_to_end(current.upsert_stream(changes, f"{path}/state", f"{path}/checkpoint-state", None, 2))
    feed.run_to_end(current.flatten_stream(changes, lookup, data.EVENT_COLUMNS, f"{path}/wide", f"{path}/checkpoint-wide", None, 2))
    feed.run_to_end(live_history.audit_stream(changes, f"{path}/audit", seconds=None, every=2))
    register_live_views(spark, f"{path}/state", f"{path}/wide", f"{path}/audit")
    return spark.sql(
        """
        SELECT h.workload, h.changes, h.with_before, s.live_records, s.with_second_day
        FROM (SELECT split_part(recid, '-', 1) AS workload, count(*) AS changes, count(before_xml) AS with_before
              FROM live_account_audit GROUP BY 1) h
        LEFT JOIN (SELECT split_part(a.recid, '-', 1) AS workload, count(*) AS live_records,
                          count(c.ship_date_02) AS with_second_day
                   FROM live_account a LEFT JOIN live_account_columns c ON c.recid = a.recid GROUP BY 1) s
          ON s.workload = h.workload
        """
    )


def q_stream_lookup_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows of a stream whose lookup gets a name in its third batch and has another one changed in its fifth."""
    path, whole, batches = scratch_dir(spark, "stream-lookup-change"), data.lookup(spark), itertools.count()

    def lookup(session: SparkSession) -> DataFrame:
        n = next(batches)
        early = whole.filter(F.col("field_index") != "c46") if n < 2 else whole
        other = F.when(F.col("field_index") == "c23", "counter").otherwise(F.col("resolved_name_en"))
        return early.withColumn("resolved_name_en", other) if n < 4 else early

    feed.run_to_end(wide.wide_stream(data.change_feed(spark, sf_dir), lookup, data.EVENT_COLUMNS, path, None, 2))
    return wide.read_wide(spark, path)


def q_stream_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after the third batch and after the last, out of one table that has been merged since."""
    path = scratch_dir(spark, "stream-versions")
    feed.run_to_end(wide.state_stream(data.change_feed(spark, sf_dir), f"{path}/table", f"{path}/checkpoint", None, 2))
    table = KeyedTable(spark, f"{path}/table", ["recid"], state.newest_images)
    earlier = wide.read_state(spark, f"{path}/table", table.version(below=3).number)
    table.merge_all()
    now = wide.read_state(spark, f"{path}/table")
    return earlier.withColumn("batches", F.lit(3)).unionByName(now.withColumn("batches", F.lit(data.BATCHES)))


def q_stream_followed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report over a view that moves on with its table, of which old versions are removed as the stream goes on."""
    path, view = scratch_dir(spark, "stream-followed"), f"state_{uuid.uuid4().hex}"
    changes = data.change_feed(spark, sf_dir)
    feed.run_to_end(wide.state_stream(changes, f"{path}/table", f"{path}/checkpoint", None, 2, follow=view, keep=2))
    workload = F.split_part("recid", F.lit("-"), F.lit(1)).alias("workload")
    return spark.table(f"global_temp.{view}").groupBy(workload).agg(
        F.count(F.lit(1)).alias("live_records"), F.max("kafka_offset").alias("newest_offset")
    )


def _live_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial rows of reports kept up to date over the changes and the polls, half of which come a batch late."""
    path = scratch_dir(spark, "live-reports")
    reporting.begin(spark, path, reporting.of_seed(data.seed(spark, sf_dir)))
    seen = reporting.of_observations(data.observation_feed(spark, sf_dir))
    changes = reporting.of_changes(data.change_feed(spark, sf_dir))
    feed.run_to_end(reporting.reports_stream(changes.unionByName(seen), path, None, 3))
    return reporting.read_groups(spark, path)


def q_live_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partials.report_by_workload(_live_groups(spark, sf_dir))


def q_live_report_by_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partials.report_by_op(_live_groups(spark, sf_dir))


def q_stream_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A measured run: land the stream, stamp both stages, trace it, and check the order of the stamps."""
    path = scratch_dir(spark, "stream-trace")
    lookup = data.lookup(spark)
    feed.run_to_end(
        landing.traced_stream(data.change_feed(spark, sf_dir), lookup, path, f"{path}/checkpoint", seconds=None)
    )
    seen = landing.read_landed(spark, path, "observations")
    nothing = data.nothing_recorded(spark)
    arrivals = visibility.first_visibility(seen, seen.filter(F.lit(False)), nothing)
    traced = tracing.trace(landing.read_landed(spark, path, "events"), arrivals)
    return traced.groupBy("op").agg(
        F.count(F.lit(1)).alias("changes"),
        F.count("total_ms").alias("timed"),
        F.count("t5_parsed").alias("parsed"),
        F.count_if(F.col("rw_to_parsed_ms") < 0).alias("negative_legs"),
    )


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("q_") and callable(f)}

