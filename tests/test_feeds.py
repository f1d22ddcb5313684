"""The given tables as streams: micro-batches of several files."""

from __future__ import annotations

import datetime

from cdcflow.plans import testdata
from cdcflow.schema import OBSERVATION
from cdcflow.streaming import feed, live


def test_batches_are_dealt_to_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(testdata, "FILE_ROWS", 30)
    monkeypatch.setattr(testdata, "scratch_dir", lambda spark, name: f"{tmp_path}/{name}")
    ids = [i for i in range(400) if i < 160 or i == 200 or i >= 240]  # one event in the third batch
    at = datetime.datetime(2024, 1, 1)
    rows = [(i, at + datetime.timedelta(seconds=i), i % 7, ["view", "click", "error"][i % 3], 1.5, '{"k": 1}') for i in ids]
    events = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    spark.createDataFrame(rows, events).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    changes = testdata.change_feed(spark, str(tmp_path))
    feed.run_to_end(live.materialize(changes, f"{tmp_path}/table", f"{tmp_path}/checkpoint", None, None))
    got = spark.read.parquet(f"{tmp_path}/table")
    found = {(r.batch_id, (r.kafka_offset - 1000 * r.kafka_partition) // 2) for r in got.collect()}
    assert found == {(i // 80, i) for i in ids}
    assert got.count() == len(ids) + sum(i % 3 == 2 for i in ids)
    files = list((tmp_path / "topic").glob("part-*"))
    assert len(files) == 5 * 3  # the third batch has empty ones
    assert max(spark.read.parquet(str(f)).count() for f in files) <= 60  # tombstones included


def test_polls_keep_their_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(testdata, "FILE_ROWS", 20)
    polls = [spark.range(n).selectExpr("CAST(0 AS INT) AS p", "id", "'raw'", f"CAST({n} AS BIGINT)").toDF(*[c.split()[0] for c in OBSERVATION.split(", ")]) for n in (50, 0, 7)]
    rows = testdata.file_stream(polls, f"{tmp_path}/polls", OBSERVATION)
    feed.run_to_end(live.materialize(rows, f"{tmp_path}/table", f"{tmp_path}/checkpoint", None, None))
    got = spark.read.parquet(f"{tmp_path}/table").groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in got} == {0: 50, 2: 7}
    assert len(list((tmp_path / "polls").glob("part-*"))) == 9


def test_live_views_read_one_feed(monkeypatch):
    from types import SimpleNamespace

    from cdcflow.plans import registry

    feeds, read = [], []
    monkeypatch.setattr(registry.data, "change_feed", lambda *a: feeds.append(object()) or feeds[-1])
    monkeypatch.setattr(registry.data, "lookup", lambda spark: None)
    monkeypatch.setattr(registry, "scratch_dir", lambda spark, name: name)
    monkeypatch.setattr(registry, "register_live_views", lambda *a: None)
    monkeypatch.setattr(registry.feed, "run_to_end", lambda query: None)
    for module, name in ((registry.current, "upsert_stream"), (registry.current, "flatten_stream"), (registry.live_history, "audit_stream")):
        monkeypatch.setattr(module, name, lambda changes, *a, **b: read.append(changes))
    registry.q_live_views(SimpleNamespace(sql=lambda text: None), "")
    assert len(feeds) == 1 and read == feeds * 3
