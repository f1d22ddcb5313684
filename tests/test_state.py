from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from cdcflow.operators import audit as history
from cdcflow.operators import mutate, skew, state
from cdcflow.schema import MESSAGE, UNAVAILABLE
from cdcflow.sources import capture, envelope, tables
from helpers import change, changes, record, rows

LOG = [
    change("c", "A", record("A", "1"), 0),
    change("u", "A", record("A", "2"), 1),
    change("c", "B", record("B", "1"), 2),
    change("d", "B", None, 3),
    change(None, None, None, 4),
    change("c", "C", record("C", "1"), 5),
    change("d", "C", None, 6),
    change(None, None, None, 7),
    change("c", "C", record("C", "2"), 8),
    change("r", "D", record("D", "1"), 9),
    change("u", "D", record("D", "2"), 10),
    change("u", "D", UNAVAILABLE, 11),
    change("u", "E", None, 12),
    change("c", "F", record("F", "1"), 13),
    change("u", "F", None, 14),
    change("u", "F", UNAVAILABLE, 15),
    change("u", "F", record("F", "2"), 16),
]

STATE = [
    ("A", record("A", "2"), 1),
    ("C", record("C", "2"), 8),
    ("D", record("D", "2"), 11),
    ("E", None, 12),
    ("F", record("F", "2"), 16),
]


def brute_audit(log):
    """Replay in a dictionary."""
    last, out = {}, []
    for op, before, after, _, _, part, offset, _ in sorted(log, key=lambda r: r[6]):
        if op is None:
            continue
        recid = (after or before)[0]
        xml = after[1] if after else None
        known = last.get(recid)
        if xml == UNAVAILABLE:
            xml = known
        out.append((recid, op, part, offset, known, xml))
        last[recid] = xml
    return sorted(out, key=lambda r: r[3])


def test_parse_messages(spark):
    import datetime

    ts = datetime.datetime(2024, 1, 1)
    data = [
        ("A", '{"op":"c","before":null,"after":{"RECID":"A","XMLRECORD":"x"},"source":{"ts_ms":5000,"db":"q"},"ts_ms":7}', 1, 0, ts),
        ("A", '{"op":"d","before":{"RECID":"A","XMLRECORD":"y"},"after":null,"source":{"ts_ms":6000},"ts_ms":8}', 1, 1, ts),
        ("A", None, 1, 2, ts),
        ("B", '{"op":"z","after":{"RECID":"B"}}', 0, 4, ts),
    ]
    parsed = envelope.parse_envelope(spark.createDataFrame(data, MESSAGE))
    assert parsed.count() == 4
    got = rows(
        envelope.drop_tombstones(parsed).select(
            envelope.image("RECID"), envelope.image("XMLRECORD"), envelope.decode_op(F.col("op")), "source.ts_ms", "kafka_offset"
        ),
        "kafka_offset",
    )
    assert got == [("A", "x", "insert", 5000, 0), ("A", "y", "delete", 6000, 1), ("B", None, "z", None, 4)]
    text = envelope.parse_envelope(
        spark.createDataFrame(data, MESSAGE), envelope="op STRING, before STRING, after STRING, source STRING, ts_ms BIGINT"
    )
    assert '"db":"q"' in text.filter("kafka_offset = 0").head().source
    assert envelope.since_offset(parsed, {1: 2}).count() == 2  # partition 0 is taken whole
    assert envelope.since_offset(parsed, {0: 5, 1: 1}).count() == 2
    assert envelope.since_offset(parsed, {}).count() == 4


def test_damaged_messages_are_not_lost(spark):
    import datetime

    ts = datetime.datetime(2024, 1, 1)
    good = '{"op":"c","before":null,"after":{"RECID":"A","XMLRECORD":"x"},"source":{"ts_ms":5000},"ts_ms":7}'
    values = [good, good[:40], "not json", "null", None, '{"ts_ms":7}', good[:-1]]
    log = spark.createDataFrame([("A", v, 0, k, ts) for k, v in enumerate(values)], MESSAGE)
    kept = envelope.parse_envelope(log, on_bad="keep")
    assert rows(envelope.bad_messages(kept).select("kafka_offset", "bad_value"), "kafka_offset") == [
        (k, values[k]) for k in (1, 2, 3, 5, 6)
    ]
    assert rows(envelope.drop_tombstones(kept).select("kafka_offset"), "kafka_offset") == [(0,)]
    assert rows(state.current_state(kept), "recid") == [("A", "x", 0)]
    with pytest.raises(Exception, match="damaged message"):
        state.current_state(envelope.parse_envelope(log)).collect()
    whole = envelope.parse_envelope(log.filter("offset IN (0, 4)"))
    assert rows(state.current_state(whole), "recid") == [("A", "x", 0)]


def test_published_messages_parse_back(spark):
    df = changes(spark, [r for r in LOG if r[0]])
    sent = envelope.to_messages(df, "kafka_offset")
    assert sent.count() == len(LOG)
    assert rows(sent.filter("value IS NULL").select("key", "is_tombstone", "kafka_offset"), "kafka_offset") == [
        ("B", True, 3),
        ("C", True, 6),
    ]
    back = envelope.parse_envelope(sent).filter("NOT is_tombstone")
    assert rows(back.select("op", "before", "after", "kafka_offset"), "kafka_offset") == rows(
        df.select("op", "before", "after", "kafka_offset"), "kafka_offset"
    )


@pytest.mark.parametrize("shuffled", [False, True])
def test_current_state(spark, shuffled):
    log = list(LOG)
    if shuffled:
        random.Random(3).shuffle(log)
    df = changes(spark, log).repartition(4)
    assert rows(state.current_state(df), "recid") == STATE


@pytest.mark.parametrize("hot_rows, span", [(1_000_000, 1_000_000), (0, 1), (0, 3), (2, 2), (1, 5)])
def test_audit_splits_hot_keys(spark, hot_rows, span):
    got = rows(history.audit(changes(spark, LOG).repartition(3), hot_rows, span), "kafka_offset")
    assert got == brute_audit(LOG)


def test_audit_of_one_dominant_key(spark):
    rng = random.Random(11)
    log = []
    for offset in range(400):
        recid = "HOT" if rng.random() < 0.5 else f"K{rng.randrange(40)}"
        op = rng.choice("cuuud")
        xml = None if op == "d" else UNAVAILABLE if op == "u" and rng.random() < 0.3 else record(recid, str(offset))
        log.append(change(op, recid, xml, offset))
    got = rows(history.audit(changes(spark, log), hot_rows=20, span=32), "kafka_offset")
    assert got == brute_audit(log)


def test_audit_reads_its_input_once(spark):
    """The changes are written before the history is planned on them, however many branches it has."""
    log = changes(spark, LOG)
    plan = history.audit(log, 1, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan and "parquet" in plan


def test_updates_of_one_key_twice_are_refused(spark):
    base = spark.createDataFrame([("A", "1")], "recid STRING, xmlrecord STRING")
    updates = spark.createDataFrame([("A", "2"), ("A", "3")], "recid STRING, xmlrecord STRING")
    for write in (mutate.merge_upsert, mutate.apply_update):
        with pytest.raises(Exception, match="two updates of one key: A"):
            write(base, updates).collect()


def test_captured_changes_enter_state_and_trace(spark):
    from cdcflow.operators.trace import markers

    schema = "recid STRING, xmlrecord STRING"
    old = spark.createDataFrame([(f"K{k}", "1") for k in range(20)], schema)
    new = spark.createDataFrame([(f"K{k}", "2") for k in range(10, 30)], schema)
    first = capture.as_log(capture.snapshot(old), 1_000_000, 3)
    ends = {r[0]: r[1] + 1 for r in first.groupBy("kafka_partition").agg(F.max("kafka_offset")).collect()}
    log = first.unionByName(capture.as_log(capture.snapshot_diff(old, new), 2_000_123, 3, ends))
    assert log.select("kafka_partition", "kafka_offset").distinct().count() == log.count() == 50
    assert rows(state.current_state(log).drop("kafka_offset"), "recid") == rows(new, "recid")
    times = {(r.t2_ms, r.t3_ms) for r in markers(log).collect()}
    assert times == {(1_000_000, 1_000_000), (2_000_000, 2_000_123)}


def test_hot_keys_are_split_and_others_are_not(spark):
    df = spark.range(100).select(F.when(F.col("id") < 60, "HOT").otherwise(F.col("id").cast("string")).alias("k"), "id")
    got = skew.add_buckets(df, "k", "id", hot_rows=10, span=20)
    assert got.count() == 100
    assert rows(got.groupBy("k").agg(F.countDistinct("bucket")).filter("k = 'HOT'"), "k") == [("HOT", 3)]
    assert rows(got.filter("k <> 'HOT'").select("bucket").distinct(), "bucket") == [(0,)]


def test_merge_update_delete(spark):
    schema = "recid STRING, xmlrecord STRING"
    base = spark.createDataFrame([("A", "1"), ("B", "2"), ("C", None)], schema)
    updates = spark.createDataFrame([("B", None), ("C", "9"), ("X", "7")], schema)
    assert rows(mutate.merge_upsert(base, updates), "recid") == [("A", "1"), ("B", None), ("C", "9"), ("X", "7")]
    assert rows(mutate.apply_update(base, updates), "recid") == [("A", "1"), ("B", None), ("C", "9")]
    assert rows(mutate.missing_keys(base, updates), "recid") == [("X",)]
    assert rows(mutate.delete_where(base, F.col("xmlrecord") == "1"), "recid") == [("B", "2"), ("C", None)]
    assert rows(mutate.delete_where(base, mutate.has_prefix("recid", "A", "B")), "recid") == [("C", None)]
    assert rows(mutate.delete_keys(base, updates), "recid") == [("A", "1")]
    assert state.count_where(base, F.col("xmlrecord") == "1").head() == (1, 3)
    assert state.latest_match(base, F.col("recid") < "C", "recid").head() == ("B", "2")
    assert state.latest_match(base, F.col("recid") > "C", "recid").head() is None


def test_snapshot_then_diff_leads_to_the_same_state(spark):
    schema = "recid STRING, xmlrecord STRING, other STRING"
    old = spark.createDataFrame([("A", "1", "x"), ("B", "2", "x"), ("C", None, "x"), ("D", "4", "x")], schema)
    new = spark.createDataFrame([("A", "1", "y"), ("B", "3", "x"), ("C", None, "x"), ("E", "5", "x")], schema)
    first = capture.snapshot(old)
    assert first.columns == ["op", "before", "after"] and {r.op for r in first.collect()} == {"r"}
    diff = capture.snapshot_diff(old, new)
    assert sorted((r.op, (r.after or r.before).RECID) for r in diff.collect()) == [("c", "E"), ("d", "D"), ("u", "B")]
    offsets = F.lit(0).alias("kafka_partition")
    log = first.select("*", offsets, F.lit(0).alias("kafka_offset")).unionByName(
        diff.select("*", offsets, F.lit(1).alias("kafka_offset"))
    )
    assert rows(state.current_state(log).drop("kafka_offset"), "recid") == rows(new.drop("other"), "recid")


def test_table_writes_repeat(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    tables.recreate(df, path)
    tables.recreate(df, path)
    assert spark.read.parquet(path).count() == 3
    tables.append_rows(df, path)
    assert spark.read.parquet(path).count() == 6
    tables.live_view(df, "live_ids")
    tables.live_view(df, "live_ids")
    assert spark.sql("SELECT count(*) FROM live_ids").head()[0] == 3


def test_changes_do_not_move_to_look_for_the_images_of_ranges(spark, tmp_path):
    rows = [("a", "u", None if i % 3 else f"<x>{i}</x>", 0, i) for i in range(40)] + [("b", "c", "<y/>", 0, 99), (None, "c", "<z/>", 0, 100)]
    changes = spark.createDataFrame(rows, "recid STRING, op STRING, xmlrecord STRING, kafka_partition INT, kafka_offset BIGINT")
    changes.write.parquet(f"{tmp_path}/flat")
    flat, key = spark.read.parquet(f"{tmp_path}/flat"), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        linked = history.prior_images(flat, hot_rows=10, span=5)
        plan = linked._jdf.queryExecution().executedPlan().toString()
        found = {tuple(r) for r in linked.selectExpr("recid", "kafka_offset", "prior.xmlrecord", "prior IS NULL").collect()}
    finally:
        spark.conf.set(key, before)
    assert not re.search(r"hashpartitioning\([^)]*kafka_offset", plan)
    whole = history.link_images(flat, ["recid"]).selectExpr("recid", "kafka_offset", "prior.xmlrecord", "prior IS NULL")
    assert found == {tuple(r) for r in whole.collect()} and len(found) == 42


@pytest.mark.parametrize("places", [1, 5, 1 << 18])
def test_what_ranges_need_is_not_broadcast(spark, tmp_path, monkeypatch, places):
    """Keys whose offsets lie far apart have a range for each change; only hash places are broadcast, so many at most."""
    monkeypatch.setattr(history, "PLACES", places, raising=False)
    rng = random.Random(places)
    log = [(f"K{rng.randrange(6)}", rng.choice("cuud"), rng.choice([UNAVAILABLE, UNAVAILABLE, None, f"<x>{k}</x>"]), 0, 7 * k) for k in range(300)]
    schema = "recid STRING, op STRING, xmlrecord STRING, kafka_partition INT, kafka_offset BIGINT"
    spark.createDataFrame(log, schema).write.parquet(f"{tmp_path}/flat")
    flat, key = spark.read.parquet(f"{tmp_path}/flat"), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        linked = history.prior_images(flat, hot_rows=10, span=5)
        plan = linked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    sent = re.findall(r"BroadcastExchange [^\n]*\n[ :+|-]*(\w+\(keys=\[\w+|\w+)", plan)
    assert sent == ["HashAggregate(keys=[place"]
    pick = ["recid", "kafka_offset", "prior.xmlrecord", "prior IS NULL"]
    whole = history.link_images(flat, ["recid"])
    order = ["recid", "kafka_offset"]
    assert rows(linked.selectExpr(*pick), *order) == rows(whole.selectExpr(*pick), *order)


def test_a_hot_key_is_ordered_by_several_tasks(spark, tmp_path):
    """Also where the join of hot keys has dealt the rows by key."""
    log = [("HOT", "c", f"<x>{k}</x>", 0, k) for k in range(200)]
    schema = "recid STRING, op STRING, xmlrecord STRING, kafka_partition INT, kafka_offset BIGINT"
    spark.createDataFrame(log, schema).write.parquet(f"{tmp_path}/flat")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        linked = history.prior_images(spark.read.parquet(f"{tmp_path}/flat"), hot_rows=10, span=5)
        tasks = linked.select(F.spark_partition_id().alias("task")).distinct().count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert tasks > 1
