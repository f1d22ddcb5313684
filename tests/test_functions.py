from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cdcflow.functions.numbers import amount_text, keyed_amount, random_amount, round_ratio
from cdcflow.functions.records import add_marker, marker_ms, record_id, replace_tag, set_record_id, varchar_bytes
from cdcflow.functions.times import epoch_ms_by_fields, epoch_ms_of_utc, utc_now


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"])
    return df.select(column.alias("x")).head()[0]


@pytest.mark.parametrize(
    "num, den, digits, want",
    [
        (1, 2, 0, "1"),
        (-1, 2, 0, "-1"),
        (49999999, 100000000, 0, "0"),
        (5, 3, 1, "1.7"),
        (-5, 3, 1, "-1.7"),
        (1, 3, 2, "0.33"),
        (0, 7, 0, "0"),
    ],
)
def test_round_ratio_is_exact(spark, num, den, digits, want):
    got = one(spark, round_ratio(F.col("n"), F.col("d"), digits), n=num, d=den)
    assert got == Decimal(want)


def test_round_ratio_of_nothing_is_null(spark):
    assert one(spark, round_ratio(F.col("n"), F.col("d"), 0), n=1, d=0) is None
    assert one(spark, round_ratio(F.lit(None).cast("bigint"), F.lit(3), 0)) is None


def test_marker(spark):
    xml = "<row><c1>x</c1><bts>1700000000123</bts></row>"
    assert one(spark, marker_ms(F.lit(xml), "bts")) == 1700000000123
    assert one(spark, marker_ms(F.lit(xml), "ots")) is None
    assert one(spark, marker_ms(F.lit("<bts>oops</bts>"), "bts")) is None
    assert one(spark, marker_ms(F.lit(None).cast("string"), "bts")) is None


def test_stamps(spark):
    xml = '<row id="A"><c23>1</c23><c23>2</c23><c23 m="2">3</c23></row>'
    assert one(spark, set_record_id(F.lit(xml), "A", F.lit("B"))) == xml.replace('id="A"', 'id="B"')
    assert one(spark, add_marker(F.lit("<row></row>"), "bts", F.lit(5))) == "<row><bts>5</bts></row>"
    # every plain element, and a value with characters that mean something in a replacement
    got = one(spark, replace_tag(F.lit(xml), "c23", F.lit("$1\\0")))
    assert got == '<row id="A"><c23>$1\\0</c23><c23>$1\\0</c23><c23 m="2">3</c23></row>'


def test_record_id(spark):
    assert one(spark, record_id(F.lit('<row id="a&amp;1"><c1>x</c1></row>'))) == "a&1"
    assert one(spark, record_id(F.lit("<row><c1>broken"))) is None


def test_varchar_bytes_cuts_whole_characters(spark):
    assert one(spark, varchar_bytes(F.lit("abc"), 3)) == "abc"
    assert one(spark, varchar_bytes(F.lit("abcd"), 3)) == "abc"
    assert one(spark, varchar_bytes(F.lit("عميل"), 3)) == "ع"
    assert one(spark, varchar_bytes(F.lit("عميل"), 8)) == "عميل"


def test_epoch_ms_both_ways(spark):
    for zone in ("UTC", "Africa/Cairo", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            ts = F.lit("2024-01-01 00:00:07.179575").cast("timestamp_ntz")
            assert one(spark, epoch_ms_by_fields(ts)) == 1704067207180  # rounded, the other one cuts
            assert one(spark, epoch_ms_of_utc(ts)) == 1704067207179
            # an hour that New York has twice, and one that it does not have
            assert one(spark, epoch_ms_of_utc(F.lit("2024-11-03 01:30:00").cast("timestamp_ntz"))) == 1730597400000
            assert one(spark, epoch_ms_of_utc(F.lit("2024-03-10 02:30:00").cast("timestamp_ntz"))) == 1710037800000
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_amounts(spark):
    assert one(spark, amount_text(F.lit(-0.5))) == "-0.50"
    df = spark.range(2000)
    fixed = df.select(keyed_amount(F.col("id"), 100, 200).alias("a"))
    assert fixed.collect() == fixed.collect()
    bounds = df.select(random_amount(100, 200, 1).alias("a")).agg(F.min("a"), F.max("a"), F.countDistinct("a")).head()
    assert 100 <= bounds[0] < 110 and 190 < bounds[1] <= 200 and bounds[2] > 1000


def test_now(spark):
    import time

    assert abs(one(spark, utc_now()) - time.time() * 1000) < 60_000
