"""Tables with a version log, and what is built on them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cdcflow.operators import flatten
from cdcflow.operators.state import current_state, latest_images, newest_images
from cdcflow.sources import files
from cdcflow.sources.lookup import lookup_rows
from cdcflow.streaming import feed, history, wide
from cdcflow.streaming.keyed import KeyedTable
from cdcflow.streaming.live import newest_rows
from helpers import change, changes, record, rows
from test_streaming import COLUMNS, NAMES, Topic, body, everything, random_log


@pytest.fixture(scope="module")
def batches():
    rng = random.Random(11)
    return [random_log(k * 40, 40, rng) for k in range(4)]


def table(spark, path, **options):
    return KeyedTable(spark, str(path), ["k"], newest_rows(["k"], "v"), **{"buckets": 8, "every": 3} | options)


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k STRING, v BIGINT")


def content(t, **options):
    return rows(t.read(**options).select("k", "v"), "k")


def test_versions_merges_and_vacuum(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert t.read() is None
    want, states = {}, {}
    for n in range(7):
        new = {f"k{n}": n, "hot": n}
        want |= new
        t.add(frame(spark, *new.items()), n)
        states[n] = sorted(want.items())
        assert content(t) == states[n]
    assert len(t.version().layers) < 7 and max(x["level"] for x in t.version().layers) == 1
    for n in range(7):  # every batch can still be read, merged since or not
        assert content(t, version=t.version(below=n + 1).number) == states[n]
    open_reader = t.read()
    t.merge_all()
    assert len(t.version().layers) == 1
    assert rows(open_reader.select("k", "v"), "k") == states[6]  # a merge takes nothing from a reader
    gone = t.vacuum(keep=2)
    assert any("/data/layer=" in g for g in gone) and any("/log/" in g for g in gone)
    assert content(t) == states[6] and len(t.versions()) == 2
    with pytest.raises(ValueError, match="not kept"):
        t.read(version=0)
    assert t.vacuum(keep=2) == []


def test_a_repeated_batch_and_an_unfinished_layer(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.add(frame(spark, ("a", 1)), 0)
    t.add(frame(spark, ("a", 9)), 0)
    assert content(t) == [("a", 1)]
    t._write(frame(spark, ("b", 1)).withColumn("batch_id", F.lit(1)), 1)  # a writer that died before it committed
    assert content(t) == [("a", 1)]
    t.add(frame(spark, ("c", 1)), 1)
    assert content(t) == [("a", 1), ("c", 1)]
    t.add(frame(spark, ("d", 1)), 2)
    assert len([g for g in t.vacuum() if "/data/" in g]) >= 1
    assert content(t) == [("a", 1), ("c", 1), ("d", 1)]
    t.add(frame(spark), 3)
    assert t.version().batch_id == 3 and len(content(t)) == 3


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.add(frame(spark, ("a", 1)), 0)
    with pytest.raises(RuntimeError, match="another writer"):
        t._commit(t.version())
    assert not files.put_if_absent(spark, f"{t.path}/log/{0:020d}.json", "x")


@pytest.mark.parametrize("few", [200, 2])
def test_keys_open_their_buckets_only(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr("cdcflow.streaming.keyed.FEW_KEYS", few)
    t = table(spark, tmp_path / "t", every=100)
    for n in range(3):
        t.add(frame(spark, *((f"k{i}", i * 10 + n) for i in range(40)), (None, n)), n)
    asked = frame(spark, ("k3", 0), ("k3", 1), ("k17", 0), ("nowhere", 0))
    assert content(t, keys=asked) == [("k17", 172), ("k3", 32)]
    opened = {f.split("bucket=")[1].split("/")[0] for f in t.rows(keys=asked).inputFiles()}
    every = {f.split("bucket=")[1].split("/")[0] for f in t.rows().inputFiles()}
    assert len(opened) <= 3 < len(every)
    assert [tuple(r) for r in t.read(keys=frame(spark, (None, 0))).select("k", "v").collect()] == [(None, 2)]
    assert content(t, keys=frame(spark)) == []


def test_short_lists_of_keys_reach_the_scan(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.add(frame(spark, *((f"k{i}", i) for i in range(40))), 0)
    plan = t.rows(keys=frame(spark, ("k3", 0)))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "k3" in plan.split("PushedFilters")[1].split("]")[0]


def test_the_history_opens_the_files_of_its_keys(spark, tmp_path):
    folder, topic = str(tmp_path / "audit"), Topic(spark, tmp_path / "topic")
    topic.add([change("c", f"K{i}", record(f"K{i}", str(i)), i) for i in range(60)])
    feed.run_to_end(history.audit_stream(topic.stream(), folder, seconds=None))
    images = history.images_table(spark, folder)
    opened = images.rows(keys=spark.createDataFrame([("K7",)], "recid STRING")).inputFiles()
    assert len(opened) == 1 < len(images.rows().inputFiles())
    topic.add([change("u", "K7", record("K7", "new"), 100)])
    feed.run_to_end(history.audit_stream(topic.stream(), folder, seconds=None))
    last = history.read_audit(spark, folder).filter("kafka_offset = 100").head()
    assert (last.before_xml, last.after_xml) == (record("K7", "7"), record("K7", "new"))


@pytest.mark.parametrize("every", [2, 100])
def test_lookup_changes_reach_rows_already_written(spark, tmp_path, batches, every):
    topic, folder = Topic(spark, tmp_path / "topic"), str(tmp_path / "wide")
    lookups = [NAMES[:1], NAMES, [("c1", None, "day_01", False), ("c46", "2", "day_02", False)], [("c46", None, "day", True)]]
    for k, (batch, known) in enumerate(zip(batches, lookups, strict=True)):
        topic.add(batch)
        feed.run_to_end(wide.wide_stream(topic.stream(), lambda s, n=known: lookup_rows(s, n), COLUMNS, folder, None, every))
        state = current_state(changes(spark, everything(batches[: k + 1])))
        want = flatten.flatten_wide(state, lookup_rows(spark, known), COLUMNS)
        assert rows(wide.read_wide(spark, folder).drop("kafka_offset"), "recid") == rows(want, "recid")
    wide.refresh(spark, folder, lookup_rows(spark, NAMES), COLUMNS, every)
    want = flatten.flatten_wide(state, lookup_rows(spark, NAMES), COLUMNS)
    assert rows(wide.read_wide(spark, folder).drop("kafka_offset"), "recid") == rows(want, "recid")


def test_a_lookup_change_touches_only_the_keys_that_hold_its_field(spark, tmp_path):
    topic, folder = Topic(spark, tmp_path / "topic"), str(tmp_path / "wide")
    log = [change("c", f"K{i}", record(f"K{i}", body(str(i), *(["x"] if i == 5 else []))), i) for i in range(20)]
    topic.add(log)
    feed.run_to_end(wide.wide_stream(topic.stream(), lookup_rows(spark, NAMES[:1]), COLUMNS, folder, None))
    before = wide.wide_table(spark, folder).version()
    wide.refresh(spark, folder, lookup_rows(spark, NAMES), COLUMNS)
    t = wide.wide_table(spark, folder)
    new = [x for x in t.version().layers if x not in before.layers]
    assert rows(t._rows(t.version(), new).select("recid", "day_01"), "recid") == [("K5", "x")]
    wide.refresh(spark, folder, lookup_rows(spark, NAMES), COLUMNS)  # nothing has changed
    assert t.version().number == before.number + 1


def test_versions_of_a_state_stream_and_a_view_that_follows(spark, tmp_path, batches):
    topic, path = Topic(spark, tmp_path / "topic"), str(tmp_path / "state")
    query = None
    for k, batch in enumerate(batches):
        topic.add(batch)
        query = query or wide.state_stream(topic.stream(), path, str(tmp_path / "cp"), 0.2, every=2, follow="followed_state")
        feed.drain(query)
        want = rows(current_state(changes(spark, everything(batches[: k + 1]))), "recid")
        assert rows(spark.table("global_temp.followed_state"), "recid") == want
    query.stop()
    t = KeyedTable(spark, path, ["recid"], newest_images)
    earlier = current_state(changes(spark, everything(batches[:2])))
    assert rows(wide.read_state(spark, path, t.version(below=2).number), "recid") == rows(earlier, "recid")
    assert t.read().count() == len(want)


def test_deleted_keys_are_forgotten_when_told_to(spark, tmp_path):
    path = str(tmp_path / "t")
    t = KeyedTable(spark, path, ["recid"], newest_images, every=2, forget_after=1)
    for n, row in enumerate([change("c", "A", record("A"), 0), change("d", "A", None, 1), change("c", "B", record("B"), 2), change("c", "C", record("C"), 3)]):
        t.add(latest_images(changes(spark, [row])), n)
    t.merge_all()
    assert rows(t.rows().select("recid"), "recid") == [("B",), ("C",)]
