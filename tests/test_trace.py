from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from cdcflow.operators import reports, visibility
from cdcflow.operators import trace as tracing
from cdcflow.schema import ARRIVAL, OBSERVATION, TRACE_COLUMNS
from helpers import change, changes, record, rows


def log(spark):
    return changes(
        spark,
        [
            change("c", "BENCH-1", record("BENCH-1", "<c1>1</c1><bts>1100</bts><ots>1250</ots>"), 0, 1000, 2),
            change("u", "BENCH-1", record("BENCH-1", "<c1>1</c1><bts>1100</bts>"), 1, 2000, 3),
            change("d", "BENCH-1", None, 2, 3000, 4),
            change(None, None, None, 3),
            change("c", "LOAD-1", record("LOAD-1", "<c1>1</c1>"), 4, 4000, 5),
        ],
    )


def arrivals(spark):
    return spark.createDataFrame([(0, 0, 2100, 2100), (0, 1, 3100, 3150), (0, 2, 4300, None)], ARRIVAL)


def test_trace_rules(spark):
    traced = tracing.trace(log(spark), arrivals(spark))
    assert tuple(traced.columns) == TRACE_COLUMNS
    legs = ["op", "gen_to_oracle_ms", "oracle_to_kafka_ms", "kafka_to_rw_ms", "rw_to_parsed_ms", "total_ms", "t2_precision"]
    got = rows(traced.select("kafka_offset", *legs), "kafka_offset")
    assert got == [
        (0, "insert", 150, 750, 100, 0, 1000, "exact"),
        (1, "update", 900, 1000, 100, 50, 2050, "second"),
        (2, "delete", None, 1000, 300, None, 1300, "second"),
        (4, "insert", None, 1000, None, None, None, "second"),
    ]
    assert [r.kafka_offset for r in tracing.untimed(traced).collect()] == [4]
    assert [r.offset for r in tracing.trace_listing(traced).collect()] == [0, 1, 2, 4]
    assert tracing.run_scope(traced, {0: 2}).count() == 2


def test_textual_source(spark):
    text = log(spark).withColumn("source", F.to_json("source"))
    got = rows(tracing.markers(text).select("kafka_offset", "t2_ms"), "kafka_offset")
    assert got == [(0, 1250), (1, 2000), (2, 3000), (4, 4000)]


def test_reports(spark):
    traced = tracing.trace(log(spark), arrivals(spark))
    totals = reports.report_totals(traced).head()
    assert totals[:4] == (4, 3, 1, 2) and (totals.first_offset, totals.last_offset) == (0, 4)
    assert rows(reports.report_by_op(traced), "op") == [
        ("delete", 1, 1, 0, Decimal(1300), 1300, 1300),
        ("insert", 2, 1, 1, Decimal(1000), 1000, 1000),
        ("update", 1, 1, 0, Decimal(2050), 2050, 2050),
    ]
    assert rows(reports.report_by_workload(traced), "op")[0] == (
        "BENCH", "delete", 1, None, Decimal(1000), Decimal(300), None, Decimal(1300)
    )
    # 1050 of 3050, 1750 of 3050, 200 of 3050, 50 of 3050
    assert reports.report_leg_share(traced).head() == (Decimal("34.4"), Decimal("57.4"), Decimal("6.6"), Decimal("1.6"))
    assert rows(reports.report_run(traced, {0: 1}), "op") == [
        ("delete", 1, None, Decimal(1000), Decimal(300), None, Decimal(1300), 1300, 1300),
        ("update", 1, Decimal(900), Decimal(1000), Decimal(100), Decimal(50), Decimal(2050), 2050, 2050),
    ]
    nothing = traced.filter(F.lit(False))
    assert reports.report_totals(nothing).head().changes == 0
    assert reports.report_leg_share(nothing).head() == (None, None, None, None)


def test_first_visibility(spark):
    seen = [
        (0, 1, "raw", 100), (0, 1, "raw", 50), (0, 1, "parsed", 120), (0, 1, "parsed", 70),
        (0, 2, "raw", 60),
        (0, 3, "raw", 60), (0, 3, "parsed", 60),
        (0, 4, "raw", 60), (0, 4, "parsed", 60),
        (0, 5, "raw", 60),
        (0, 6, "parsed", 60),
        (1, 1, "raw", 500),
    ]
    observations = spark.createDataFrame(seen, OBSERVATION)
    seed = spark.createDataFrame([(0, 3, "raw", None), (0, 4, "parsed", None)], OBSERVATION).drop("seen_ms")
    recorded = spark.createDataFrame([(0, 5, 1, 1)], ARRIVAL)
    got = rows(visibility.first_visibility(observations, seed, recorded), "kafka_partition", "kafka_offset")
    assert got == [(0, 1, 50, 70), (0, 2, 60, None), (0, 4, 60, None), (1, 1, 500, None)]
