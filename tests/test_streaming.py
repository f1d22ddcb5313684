from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cdcflow.operators import flatten
from cdcflow.operators.audit import audit
from cdcflow.operators.state import current_state, newest_images
from cdcflow.operators.trace import trace
from cdcflow.operators.visibility import first_visibility
from cdcflow.plans.views import register_live_views
from cdcflow.schema import OBSERVATION, UNAVAILABLE
from cdcflow.session import scratch_dir
from cdcflow.sources.lookup import lookup_rows
from cdcflow.streaming import arrivals, current, feed, history, live
from helpers import CHANGE, change, changes, record, rows
from test_state import LOG, STATE, brute_audit

NAMES = [("c1", None, "customer", False), ("c46", None, "day", True)]
COLUMNS = ["customer", "day_01", "day_02"]


class Topic:
    """A folder that grows by one file per call, read as a stream of changes."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files = spark, str(path), 0

    def add(self, log):
        self.files += 1
        changes(self.spark, log).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self, per_batch=1):
        return self.spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", per_batch).parquet(self.path)


def body(customer, *days):
    tags = f"<c1>{customer}</c1>" if customer else ""
    return tags + "".join(f"<c46>{d}</c46>" if k == 0 else f'<c46 m="{k + 1}">{d}</c46>' for k, d in enumerate(days))


def random_log(start, rows_, rng, keys=12):
    """A third of the changes belong to one key."""
    log = []
    for offset in range(start, start + rows_):
        recid = "HOT" if rng.random() < 0.34 else f"K{rng.randrange(keys)}"
        op = rng.choice("cuurd")
        xml = None
        if op == "u" and rng.random() < 0.2:
            xml = UNAVAILABLE
        elif op != "d":
            xml = record(recid, body(rng.choice(["", str(offset)]), *[f"d{offset}"] * rng.randrange(3)))
        log.append(change(op, recid, xml, offset * 2))
        if op == "d":
            log.append(change(None, None, None, offset * 2 + 1))
    return log


@pytest.fixture(scope="module")
def names(spark):
    return lookup_rows(spark, NAMES)


@pytest.fixture(scope="module")
def batches():
    rng = random.Random(5)
    return [random_log(k * 60, 60, rng) for k in range(3)]


def everything(batches):
    return [row for batch in batches for row in batch]


def test_current_state_over_batches(spark, tmp_path, batches):
    topic = Topic(spark, tmp_path / "topic")
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    for k, batch in enumerate(batches):
        topic.add(batch)
        stream = current.current_state_stream(topic.stream())
        feed.run_to_end(live.materialize(stream, table, checkpoint, ["recid"], None, every=2))
        so_far = current_state(changes(spark, everything(batches[: k + 1])))
        assert rows(live.read_live(spark, table, ["recid"]), "recid") == rows(so_far, "recid")
    assert spark.read.parquet(f"{table}/batch").select("batch_id").distinct().count() >= 3
    assert live.covered_layers(spark, table) == [f"{table}/batch/batch_id={n}" for n in (0, 1)]


def test_upserts_over_batches(spark, tmp_path, batches):
    topic = Topic(spark, tmp_path / "topic")
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    for k, batch in enumerate(batches):
        topic.add(batch)
        feed.run_to_end(current.upsert_stream(topic.stream(), table, checkpoint, None, every=2))
        want = rows(current_state(changes(spark, everything(batches[: k + 1]))), "recid")
        assert rows(current.read_state(spark, table), "recid") == want
    live.merge_layers(spark, table, newest_images, 2)
    assert rows(current.read_state(spark, table), "recid") == want
    assert len(live.covered_layers(spark, table)) == 4


@pytest.mark.parametrize("every", [1, 2, 100])
def test_a_deleted_key_stays_deleted_whatever_is_merged(spark, tmp_path, every):
    """An older change that is read after the delete must not bring the key back."""
    topic = Topic(spark, tmp_path / "topic")
    topic.add([change("c", "A", record("A", "1"), 0), change("c", "B", record("B", "1"), 1)])
    topic.add([change("d", "A", None, 9)])
    topic.add([change("u", "A", record("A", "2"), 5)])
    table = str(tmp_path / "table")
    feed.run_to_end(current.upsert_stream(topic.stream(), table, str(tmp_path / "cp"), None, every))
    assert rows(current.read_state(spark, table), "recid") == [("B", record("B", "1"), 1)]
    forgotten = str(tmp_path / "forgotten")
    feed.run_to_end(current.upsert_stream(topic.stream(), forgotten, str(tmp_path / "cp2"), None, 2, forget_after=1))
    assert live.read_keyed(spark, forgotten, newest_images, deleted=True).filter("recid = 'A'").head().deleted


def test_old_deletes_are_forgotten_when_told_to(spark, tmp_path):
    topic = Topic(spark, tmp_path / "topic")
    topic.add([change("c", "A", record("A", "1"), 0)])
    topic.add([change("d", "A", None, 1)])
    topic.add([change("c", "B", record("B", "1"), 2)])
    topic.add([change("c", "C", record("C", "1"), 3)])
    table = str(tmp_path / "table")
    feed.run_to_end(current.upsert_stream(topic.stream(), table, str(tmp_path / "cp"), None, 4, forget_after=2))
    assert rows(live.layers(spark, table).select("recid"), "recid") == [("B",), ("C",)]


def test_an_unfinished_merge_is_not_read(spark, tmp_path):
    topic = Topic(spark, tmp_path / "topic")
    topic.add([change("c", "A", record("A", "1"), 0)])
    topic.add([change("c", "B", record("B", "1"), 1)])
    table = str(tmp_path / "table")
    feed.run_to_end(current.upsert_stream(topic.stream(), table, str(tmp_path / "cp"), None, 100))
    spark.read.parquet(f"{table}/batch").limit(0).write.parquet(f"{table}/merged/upto=1")
    assert [r[0] for r in rows(current.read_state(spark, table), "recid")] == ["A", "B"]


def test_upserts_of_the_small_log(spark, tmp_path):
    topic = Topic(spark, tmp_path / "topic")
    for part in (LOG[:2], LOG[2:6], LOG[6:11], LOG[11:12], LOG[12:15], LOG[15:16], LOG[16:]):
        topic.add(part)
    table = str(tmp_path / "table")
    feed.run_to_end(current.upsert_stream(topic.stream(), table, str(tmp_path / "cp"), None))
    assert rows(current.read_state(spark, table), "recid") == STATE


def test_flatten_over_batches(spark, tmp_path, batches, names):
    topic = Topic(spark, tmp_path / "topic")
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    for batch in batches:
        topic.add(batch)
    feed.run_to_end(current.flatten_stream(topic.stream(), names, COLUMNS, table, checkpoint, None, every=2))
    state = current_state(changes(spark, everything(batches)))
    want = flatten.flatten_wide(state, names, COLUMNS)
    assert rows(current.read_wide(spark, table).drop("kafka_offset"), "recid") == rows(want, "recid")


def test_names_added_to_the_lookup_reach_a_stream(spark, tmp_path):
    topic, table = Topic(spark, tmp_path / "topic"), str(tmp_path / "table")
    known = [("c1", None, "customer", False)]
    topic.add([change("c", "A", record("A", body("1", "x")), 0)])
    for _ in range(2):
        stream = current.flatten_stream(topic.stream(), lambda s: lookup_rows(s, known), COLUMNS, table, str(tmp_path / "cp"), None)
        feed.run_to_end(stream)
        known = NAMES
        topic.add([change("c", "B", record("B", body("2", "y")), 1)])
    assert rows(current.read_wide(spark, table).drop("kafka_offset"), "recid") == [("A", "1", None, None), ("B", "2", "y", None)]


def test_update_to_a_record_without_tags_removes_the_wide_row(spark, tmp_path, names):
    topic = Topic(spark, tmp_path / "topic")
    topic.add([change("c", "A", record("A", body("1", "x", "y")), 0), change("c", "B", record("B", body("2")), 1)])
    topic.add([change("u", "A", record("A"), 2), change("u", "B", record("B", body("", "z")), 3)])
    table = str(tmp_path / "table")
    feed.run_to_end(current.flatten_stream(topic.stream(), names, COLUMNS, table, str(tmp_path / "cp"), None))
    # nothing of an older version stays either
    assert rows(current.read_wide(spark, table).drop("kafka_offset"), "recid") == [("B", None, "z", None)]


def test_event_counts(spark, tmp_path, batches, names):
    topic = Topic(spark, tmp_path / "topic")
    for batch in batches:
        topic.add(batch)
    table = str(tmp_path / "table")
    feed.run_to_end(current.flatten_events_stream(topic.stream(2), names, table, str(tmp_path / "cp"), None))
    want = flatten.flatten_events(changes(spark, everything(batches)), names)
    assert rows(spark.read.parquet(table).drop("batch_id"), "kafka_offset") == rows(want, "kafka_offset")


@pytest.mark.parametrize("hot_rows, span", [(1_000_000, 1_000_000), (5, 16)])
def test_audit_over_batches(spark, tmp_path, batches, hot_rows, span):
    topic = Topic(spark, tmp_path / "topic")
    folder = str(tmp_path / "audit")
    for k, batch in enumerate(batches):
        topic.add(batch)
        if k == 1:
            continue  # two batches are waiting the next time
        feed.run_to_end(history.audit_stream(topic.stream(), folder, hot_rows, span, None, every=2))
        so_far = everything(batches[: k + 1])
        assert rows(history.read_audit(spark, folder), "kafka_offset") == brute_audit(so_far)
    assert rows(audit(changes(spark, everything(batches)), 5, 16), "kafka_offset") == brute_audit(everything(batches))


def test_audit_of_a_small_log_in_small_batches(spark, tmp_path):
    """After each batch, all that can be read is final: images of earlier batches are carried before it is published."""
    topic, folder = Topic(spark, tmp_path / "topic"), str(tmp_path / "audit")
    parts = (LOG[:2], LOG[2:6], LOG[6:11], LOG[11:12], LOG[12:])
    for k, part in enumerate(parts):
        topic.add(part)
        feed.run_to_end(history.audit_stream(topic.stream(), folder, seconds=None, every=3))
        assert rows(history.read_audit(spark, folder), "kafka_offset") == brute_audit(everything(parts[: k + 1]))


def test_a_history_batch_can_be_written_again(spark, tmp_path):
    topic, folder = Topic(spark, tmp_path / "topic"), str(tmp_path / "audit")
    for part in (LOG[:6], LOG[6:]):
        topic.add(part)
    feed.run_to_end(history.audit_stream(topic.stream(), folder, seconds=None, every=1))
    earlier = live.read_keyed(spark, f"{folder}/images", newest_images, deleted=True, below=1)
    assert earlier.agg(F.max("kafka_offset")).head()[0] < 6
    assert rows(history.read_audit(spark, folder), "kafka_offset") == brute_audit(LOG)


def test_live_audit(spark, tmp_path, batches):
    topic = Topic(spark, tmp_path / "topic")
    topic.add(batches[0])
    folder = str(tmp_path / "audit")
    query = history.audit_stream(topic.stream(), folder, seconds=0.2)
    try:
        topic.add(batches[1])
        feed.drain(query)
        got = rows(history.read_audit(spark, folder), "kafka_offset")
    finally:
        query.stop()
    assert got == brute_audit(everything(batches[:2]))


def test_live_views(spark, tmp_path, batches, names):
    topic, folder = Topic(spark, tmp_path / "topic"), str(tmp_path)
    for batch in batches:
        topic.add(batch)
    feed.run_to_end(current.upsert_stream(topic.stream(), f"{folder}/state", f"{folder}/cp1", None))
    feed.run_to_end(current.flatten_stream(topic.stream(), names, COLUMNS, f"{folder}/wide", f"{folder}/cp2", None))
    feed.run_to_end(history.audit_stream(topic.stream(), f"{folder}/audit", seconds=None))
    found = register_live_views(spark, f"{folder}/state", f"{folder}/wide", f"{folder}/audit", "x_")
    assert found == ["x_account", "x_account_columns", "x_account_audit"]
    log = changes(spark, everything(batches))
    assert rows(spark.table("x_account"), "recid") == rows(current_state(log), "recid")
    assert rows(spark.table("x_account_audit"), "kafka_offset") == brute_audit(everything(batches))


def test_registered_streams_cross_batches(spark):
    from cdcflow.plans import testdata

    sf_dir = "/root/testdata/sf0.001"
    changes_, path = testdata.change_feed(spark, sf_dir), scratch_dir(spark, "crossing")
    feed.run_to_end(current.upsert_stream(changes_, f"{path}/t", f"{path}/cp", None, 100))
    batch = spark.read.parquet(f"{path}/t/batch")
    assert batch.select("batch_id").distinct().count() >= 4
    assert batch.groupBy("recid").count().filter("count > 1").count() > 10
    ends = batch.groupBy("batch_id").agg(F.min("kafka_offset"), F.max("kafka_offset")).orderBy("batch_id").collect()
    assert [r[1] for r in ends] == sorted(r[1] for r in ends)


def test_batch_writer_can_be_replayed(spark, tmp_path):
    path = str(tmp_path / "t")
    write = live.batch_writer(path)
    first, second = spark.range(3), spark.range(3, 5)
    write(first, 0)
    write(second, 1)
    write(second, 1)
    assert rows(spark.read.parquet(path).select("id", "batch_id"), "id") == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 1)]


def test_traced_run(spark, tmp_path, batches, names):
    topic = Topic(spark, tmp_path / "topic")
    for batch in batches:
        topic.add(batch)
    folder = str(tmp_path / "run")
    before = arrivals.now_ms()
    feed.run_to_end(arrivals.traced_stream(topic.stream(), names, folder, str(tmp_path / "cp"), seconds=None))
    after = arrivals.now_ms()
    seen = arrivals.read_landed(spark, folder, "observations")
    assert seen.select("seen_ms").distinct().count() >= 3
    none = spark.createDataFrame([], OBSERVATION)
    times = first_visibility(seen, none, none)
    traced = trace(arrivals.read_landed(spark, folder, "events"), times)
    changed = [r for r in everything(batches) if r[0]]
    assert traced.count() == len(changed) and traced.filter("total_ms IS NULL").count() == 0
    stats = times.agg(F.min("t4_ms"), F.max("t4_ms"), F.max("t5_ms"), F.count_if(F.col("t5_ms") < F.col("t4_ms"))).head()
    assert before <= stats[0] <= stats[1] <= stats[2] <= after and stats[3] == 0


def test_barrier_and_drain(spark, tmp_path, batches):
    assert feed.barrier() == {"processingTime": "1000 milliseconds"} and feed.barrier(None) == {"availableNow": True}
    topic = Topic(spark, tmp_path / "topic")
    topic.add(batches[0])
    table = str(tmp_path / "table")
    query = live.materialize(current.current_state_stream(topic.stream()), table, str(tmp_path / "cp"), ["recid"], 0.2)
    try:
        feed.drain(query)
        assert rows(live.read_live(spark, table, ["recid"]), "recid") == rows(
            current_state(changes(spark, batches[0])), "recid"
        )
        topic.add(batches[1])
        feed.drain(query)
    finally:
        query.stop()
    assert rows(live.read_live(spark, table, ["recid"]), "recid") == rows(
        current_state(changes(spark, everything(batches[:2]))), "recid"
    )


def test_start_positions():
    assert feed.starting_offsets("earliest") == "earliest" and feed.starting_offsets("latest") == "latest"
    assert feed.starting_offsets({"topic": {0: 125}}) == '{"topic": {"0": 125}}'
    with pytest.raises(ValueError):
        feed.starting_offsets("middle")
    options = feed.kafka_options("host:9092", "topic", "latest")
    assert options["subscribe"] == "topic" and options["startingOffsets"] == "latest"
    assert int(options["maxOffsetsPerTrigger"]) > 0


def test_file_feed_of_messages(spark, tmp_path):
    data = spark.createDataFrame([("A", '{"op":"c","after":{"RECID":"A","XMLRECORD":"x"}}', 0, 0)], "key STRING, value STRING, partition INT, offset BIGINT")
    data.withColumn("timestamp", F.lit(0).cast("timestamp")).write.json(str(tmp_path / "in"))
    stream = feed.change_stream(spark, {"maxFilesPerTrigger": "10"}, "json", str(tmp_path / "in"))
    query = live.materialize(stream, str(tmp_path / "out"), str(tmp_path / "cp"), None, None)
    feed.run_to_end(query)
    assert spark.read.parquet(str(tmp_path / "out")).select("key", "offset").head() == ("A", 0)
