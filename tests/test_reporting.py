from __future__ import annotations

import pytest
from helpers import change, changes, record

from cdcflow.operators import partials, reports, trace, visibility
from cdcflow.schema import OBSERVATION
from cdcflow.streaming import reporting

REPORTS = ["report_totals", "report_by_op", "report_by_workload", "report_leg_share"]


def one(recid, op, offset, partition=0, stamp=None):
    body = "" if stamp is None else f"<bts>{stamp}</bts>"
    return change(op, recid, record(recid, body), offset, source_ms=2_000 + offset, log_s=3, partition=partition)


def polls(spark, rows):
    return spark.createDataFrame([(p, o, stage, ms) for p, o, stage, ms in rows], OBSERVATION)


def expected(spark, log, seen, seed, recorded):
    key = "kafka_partition INT, kafka_offset BIGINT"
    arrivals = visibility.first_visibility(
        polls(spark, seen),
        spark.createDataFrame(seed, f"{key}, stage STRING"),
        spark.createDataFrame(recorded, key),
    )
    return trace.trace(changes(spark, log), arrivals)


def same(live, batch):
    return [tuple(r) for r in live.collect()] == [tuple(r) for r in batch.collect()]


LOG = [
    [one("A-1", "c", 0, stamp=1_500), one("B-1", "c", 1), one("A-2", "c", 0, partition=1)],
    [one("A-1", "u", 2, stamp=1_600), one("B-1", "d", 3), one("C-1", "r", 4), one("A-9", "c", 1, partition=1)],
    [],
]
# Sightings come before their change, after it, twice, and earlier than what was known; the last batch brings the least times.
SEEN = [
    [(0, 0, "raw", 5_000), (0, 0, "parsed", 5_010), (0, 4, "raw", 9_000), (1, 0, "raw", 4_000)],
    [(0, 1, "raw", 5_500), (0, 1, "parsed", 5_505), (0, 0, "raw", 5_000), (0, 3, "raw", 6_000), (1, 1, "raw", 7_000)],
    [(0, 0, "raw", 4_100), (0, 0, "parsed", 4_200), (0, 2, "parsed", 6_100), (0, 4, "raw", 8_000), (7, 7, "raw", 1)],
]
SEED = [(1, 0, "raw"), (0, 1, "parsed")]
RECORDED = [(1, 1)]


def fragments(spark, batch):
    return reporting.of_changes(changes(spark, LOG[batch])).unionByName(reporting.of_observations(polls(spark, SEEN[batch])))


def test_reports_after_each_batch_equal_those_of_all_rows(spark, tmp_path):
    folder = str(tmp_path)
    key = "kafka_partition INT, kafka_offset BIGINT"
    seed = reporting.of_seed(spark.createDataFrame(SEED, f"{key}, stage STRING"))
    reporting.begin(spark, folder, seed.unionByName(reporting.of_recorded(spark.createDataFrame(RECORDED, key))))
    for n in range(3):
        # Every batch comes twice, as after a lost driver.
        for _ in range(2):
            reporting._apply(spark, folder, fragments(spark, n), 2, None, n)
        whole = expected(spark, sum(LOG[: n + 1], []), sum(SEEN[: n + 1], []), SEED, RECORDED)
        groups = reporting.read_groups(spark, folder)
        for name in REPORTS:
            assert same(getattr(partials, name)(groups), getattr(reports, name)(whole)), (n, name)
        assert sorted(map(str, reporting.read_trace(spark, folder).collect())) == sorted(map(str, whole.collect()))


def test_a_batch_that_failed_between_its_tables_is_made_up_for(spark, tmp_path):
    folder = str(tmp_path)
    reporting._apply(spark, folder, fragments(spark, 0), 2, None, 0)
    facts = reporting.known_table(spark, folder, 2)
    facts.add(reporting.known(fragments(spark, 1)), 1)
    for n in (1, 2):
        reporting._apply(spark, folder, fragments(spark, n), 2, None, n)
    whole = expected(spark, sum(LOG, []), sum(SEEN, []), [], [])
    groups = reporting.read_groups(spark, folder)
    assert all(same(getattr(partials, name)(groups), getattr(reports, name)(whole)) for name in REPORTS)


def test_reports_of_nothing(spark, tmp_path):
    with pytest.raises(ValueError):
        reporting.read_groups(spark, str(tmp_path))
    with pytest.raises(ValueError):
        reporting.begin(spark, str(tmp_path), reporting.of_changes(changes(spark, LOG[0])))
    reporting._apply(spark, str(tmp_path), fragments(spark, 0).limit(0), 2, None, 0)
    groups = reporting.read_groups(spark, str(tmp_path))
    none = expected(spark, [], [], [], [])
    assert all(same(getattr(partials, name)(groups), getattr(reports, name)(none)) for name in REPORTS)


def test_partial_rows_take_back_what_they_added(spark):
    whole = expected(spark, sum(LOG, []), sum(SEEN, []), [], [])
    some = whole.filter("op = 'insert'")
    rows = partials.partials(whole).unionByName(partials.partials(some, -1))
    left = reports.report_by_op(whole.filter("op <> 'insert'"))
    assert same(partials.report_by_op(partials.merged(rows)), left)
