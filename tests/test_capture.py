"""Changes out of tables get places in a log: each partition without gaps, by key, whatever the number of tasks."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cdcflow.sources import capture


@pytest.fixture()
def many_tasks(spark, request):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))


def numbered(log):
    rows = log.select("kafka_partition", "kafka_offset", F.coalesce("after.RECID", "before.RECID").alias("key")).collect()
    return sorted((r.kafka_partition, r.kafka_offset, r.key) for r in rows)


@pytest.mark.parametrize("partitions", [1, 3])
def test_a_partition_is_numbered_by_many_tasks(spark, many_tasks, partitions):
    records = spark.range(20_000).select(F.format_string("K%06d", (F.col("id") * 7919) % 20_000).alias("recid"), F.lit("<r/>").alias("xmlrecord"))
    changes = capture.snapshot(records)
    start = {p: 1000 * p + 5 for p in range(partitions)}
    got = numbered(capture.as_log(changes, 1_700_000_000_123, partitions, start))
    key = F.col("after.RECID")
    place = changes.withColumn("p", F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int"))
    nth = F.row_number().over(Window.partitionBy("p").orderBy(key))
    want = place.select("p", nth.alias("n"), key.alias("key")).collect()
    assert got == sorted((r.p, start[r.p] + r.n - 1, r.key) for r in want)


def test_no_task_numbers_a_whole_partition(spark, many_tasks):
    records = spark.range(20_000).select(F.format_string("K%06d", "id").alias("recid"), F.lit("<r/>").alias("xmlrecord"))
    log = capture.as_log(capture.snapshot(records), 0, 1)
    files = log.inputFiles()
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    assert len(files) > 1 and plan.count("Window") == 1 and "row_number" not in plan


def test_repeated_keys_and_no_changes(spark):
    records = spark.createDataFrame([("A", str(i)) for i in range(50)] + [(None, "x")] * 3, "recid STRING, xmlrecord STRING")
    got = capture.as_log(capture.snapshot(records), 0, 1).collect()
    assert sorted(r.kafka_offset for r in got) == list(range(53))
    assert [r.after.RECID for r in sorted(got, key=lambda r: r.kafka_offset)] == [None] * 3 + ["A"] * 50
    assert capture.as_log(capture.snapshot(records.limit(0)), 0, 2).collect() == []


STATE = "recid STRING, xmlrecord STRING"


def text(changes):
    return sorted(map(str, changes.collect()))


@pytest.mark.parametrize("levels", [(1,), (4, 64), (1 << 10, 1 << 20)])
def test_difference_by_ranges_is_the_difference(spark, levels):
    old = [(f"K{i}", f"v{i}") for i in range(300)] + [("N", None), ("E", ""), ("S", None), (None, "x"), (None, "x")]
    new = [(k, v) for k, v in old if k not in ("K7", "K70")]
    new = [("K9", "other") if r == ("K9", "v9") else r for r in new if r[0] not in ("N", "E")]
    new += [("N", ""), ("E", None), ("L", "new"), (None, "y")]
    old, new = (spark.createDataFrame(rows, STATE) for rows in (old, new))
    assert text(capture.snapshot_diff_ranges(old, new, levels=levels)) == text(capture.snapshot_diff(old, new))
    for one, two in ((old, old.limit(0)), (old.limit(0), new), (old.limit(0), old.limit(0))):
        assert text(capture.snapshot_diff_ranges(one, two, levels=levels)) == text(capture.snapshot_diff(one, two))


def test_only_unequal_ranges_are_joined(spark, monkeypatch):
    kept, store = {}, capture.stored
    monkeypatch.setattr(capture, "stored", lambda df, name: kept.setdefault(f"{name}-{len(kept)}", store(df, name)))
    old = spark.range(20_000).select(F.format_string("K%06d", "id").alias("recid"), F.lit("<r/>").alias("xmlrecord"))
    new = old.withColumn("xmlrecord", F.when(F.col("recid") == "K000100", "<s/>").otherwise(F.col("xmlrecord")))
    assert capture.snapshot_diff_ranges(old, new).count() == 1
    assert {name: rows.count() for name, rows in kept.items()} == {"ranges-0": 1, "ranges-1": 1, "changed-2": 1}


def test_levels_that_do_not_nest(spark):
    none = spark.createDataFrame([], STATE)
    with pytest.raises(ValueError):
        capture.snapshot_diff_ranges(none, none, levels=(4, 6))
