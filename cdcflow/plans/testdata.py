"""The given tables as records, messages, observations and templates.

Pure expressions over whole tables, so every expected answer can be restated from the base columns:

* ``orders`` and ``lineitem`` become one record per order, with one repeated ``c46`` element per line;
* ``events`` becomes a change log: one change per event and a tombstone after each delete. Events are at even
  offsets, tombstones at the odd offset behind their delete. Each partition counts from a start of its own, so an
  offset says nothing without its partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.functions.numbers import amount_text
from cdcflow.functions.times import epoch_ms_of_utc
from cdcflow.plans.account import POSITIONS
from cdcflow.schema import EVENT_KEY, MESSAGE, OBSERVATION, UNAVAILABLE
from cdcflow.session import scratch_dir, stored
from cdcflow.sources.envelope import parse_envelope, to_messages
from cdcflow.sources.files import names
from cdcflow.sources.lookup import load_lookup, lookup_rows
from cdcflow.streaming.feed import change_stream

LOOKUP_ROWS = (
    ("c1", None, "customer", False),
    ("c2", None, "counter", False),
    ("c8", None, "order_status", False),
    ("c20", "1", "order_ref", False),
    ("c20", "2", "priority", False),
    ("c20", "32", "empty_note", False),
    ("c23", None, "total_price", False),
    ("c28", None, "order_date", False),
    ("c46", None, "ship_date", True),
    ("c99", None, "unused_name", False),
)
ORDER_COLUMNS = [
    "customer",
    "order_status",
    "total_price",
    "order_date",
    "order_ref",
    "priority",
    "empty_note",
    *[f"ship_date_{k:02d}" for k in range(1, 8)],
]
EVENT_COLUMNS = ["counter", "order_ref", "total_price", "ship_date_01", "ship_date_02"]

# Micro-batches of the message stream, and the rows of a file of it at most.
BATCHES = 5
FILE_ROWS = 50_000


# A setting of the bench alone: deal each table, mostly one small file here, to so many partitions after reading it.
SPREAD = "spark.cdcflow.spreadTables"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df, spread = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.conf.get(SPREAD, None)
    return df.repartition(int(spread)) if spread else df


def event_count(spark: SparkSession, sf_dir: str) -> int:
    """One more than the greatest event_id; parts of a run are shares of it."""
    return table(spark, sf_dir, "events").agg(F.coalesce(F.max("event_id"), F.lit(-1)) + 1).head()[0]


def lookup(spark: SparkSession) -> DataFrame:
    return lookup_rows(spark, LOOKUP_ROWS)


def lookup_file(spark: SparkSession) -> DataFrame:
    """The same lookup, written as a CSV file of its usual form and loaded again."""
    path = scratch_dir(spark, "lookup")
    rows = lookup(spark).selectExpr("'orders' AS table_name", "field_index", "m_index", "resolved_name_en", "'2026-01-01' AS dt")
    rows.coalesce(1).write.option("header", True).csv(path)
    return load_lookup(spark, path, [field for field, _, _, repeats in LOOKUP_ROWS if repeats])


def large_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup with one more field for each order."""
    more = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("c"), (F.col("o_orderkey") + 1000).cast("string")).alias("field_index"),
        F.lit(None).cast("string").alias("m_index"),
        F.concat(F.lit("name_"), F.col("o_orderkey").cast("string")).alias("resolved_name_en"),
        F.lit(False).alias("is_multivalue"),
    )
    return lookup(spark).unionByName(more)


def account_lookup(spark: SparkSession) -> DataFrame:
    """A lookup of the shape of the account table's: repeated fields, an exact entry, and 165 columns in all."""
    rows = [("c1", None, "customer", False), ("c8", None, "status", False), ("c23", None, "price", False)]
    rows += [("c28", None, "day", False), ("c20", "2", "priority", False)]
    rows += [(field, None, f"group_{field}", True) for field in POSITIONS]
    rows += [(f"c{1000 + k}", None, f"field_{k:02d}", False) for k in range(165 - 5 - sum(POSITIONS.values()))]
    return lookup_rows(spark, rows)


def _tag(field: str, value: Column, position: Column | int | None = None) -> Column:
    value = value.cast("string")
    if position is None:
        return F.concat(F.lit(f"<{field}>"), value, F.lit(f"</{field}>"))
    at = F.lit(position) if isinstance(position, int) else position
    return F.concat(F.lit(f'<{field} m="'), at.cast("string"), F.lit('">'), value, F.lit(f"</{field}>"))


def _day(ts: str) -> Column:
    # Through a date, so that no session time zone can move the wall clock.
    return F.date_format(F.to_date(ts), "yyyyMMdd")


# ---- records ---------------------------------------------------------------------------------------


def order_id() -> Column:
    return F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string"))


def order_records(orders: DataFrame, *extra: str) -> DataFrame:
    """Records of the order header alone: ``recid, xmlrecord``."""
    recid = order_id()
    xml = F.concat(
        F.lit('<row id="'),
        recid,
        F.lit('">'),
        _tag("c1", F.col("o_custkey")),
        _tag("c8", F.col("o_orderstatus")),
        _tag("c23", amount_text(F.col("o_totalprice"))),
        _tag("c28", _day("o_orderdate")),
        F.lit("</row>"),
    )
    return orders.select(recid.alias("recid"), xml.alias("xmlrecord"), *extra)


def orders_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full order records: header, an unresolved ``c20``, an empty element, one ``c46`` per line.

    Lines are gathered as a set of element texts: at most one per line number and ship date, whatever the
    number of lines, and combined before the shuffle.
    """
    day = _day("l_shipdate")
    number = F.col("l_linenumber")
    line = F.when(number == 1, _tag("c46", day)).otherwise(_tag("c46", day, number))
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.array_join(F.array_sort(F.collect_set(line)), "").alias("lines"))
    )
    orders = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left")
    recid = order_id()
    xml = F.concat(
        F.lit('<row id="'),
        recid,
        F.lit('">'),
        _tag("c1", F.col("o_custkey")),
        _tag("c8", F.col("o_orderstatus")),
        _tag("c20", F.col("o_orderkey")),
        _tag("c20", F.col("o_orderpriority"), 2),
        _tag("c20", F.lit(""), 32),
        _tag("c23", amount_text(F.col("o_totalprice"))),
        _tag("c28", _day("o_orderdate")),
        F.coalesce("lines", F.lit("")),
        F.lit("</row>"),
    )
    return orders.select(recid.alias("recid"), xml.alias("xmlrecord"))


# ---- change log ------------------------------------------------------------------------------------


def event_op() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "signup", "c")
        .when(kind == "view", "r")
        .when(kind.isin("click", "purchase"), "u")
        .when(kind == "error", "d")
    )


def event_recid() -> Column:
    user = F.col("user_id")
    prefix = F.when(user % 3 == 0, "BENCH-").when(user % 3 == 1, "LOAD-").otherwise("BULK-")
    return F.concat(prefix, user.cast("string"))


def event_partition() -> Column:
    return (F.col("user_id") % 4).cast("int")


def event_offset() -> Column:
    return F.col("event_id") * 2 + event_partition() * 1000


def half_run(spark: SparkSession, sf_dir: str) -> dict[int, int]:
    """The offset of each partition at which the second half of the events begins."""
    half = event_count(spark, sf_dir) // 2
    return {p: 2 * half + 1000 * p for p in range(4)}


def event_log_ms() -> Column:
    """Time at which an event reached the log."""
    return epoch_ms_of_utc(F.col("ts")) + F.col("event_id") % 3000


def change_messages(events: DataFrame) -> DataFrame:
    """The event table, batch or stream, as messages of a change log topic."""
    event_id, ms, op, recid = F.col("event_id"), F.col("_ms"), F.col("_op"), F.col("_recid")
    rows = events.select(
        "*",
        epoch_ms_of_utc(F.col("ts")).alias("_ms"),
        event_op().alias("_op"),
        event_recid().alias("_recid"),
    )
    day = _day("ts")
    xml = F.concat(
        F.lit('<row id="'),
        recid,
        F.lit('">'),
        _tag("c2", F.get_json_object("props", "$.k")),
        _tag("c20", event_id),
        _tag("c23", amount_text(F.col("value"))),
        _tag("c46", day),
        F.when(F.col("event_type") == "purchase", _tag("c46", day, 2)).otherwise(""),
        F.when(event_id % 4 != 0, _tag("bts", ms - 20 - event_id % 50)).otherwise(""),
        F.when(event_id % 3 != 0, _tag("ots", ms)).otherwise(""),
        F.lit("</row>"),
    )

    def image(payload: Column) -> Column:
        return F.struct(recid.alias("RECID"), payload.alias("XMLRECORD"))

    changes = rows.select(
        op.alias("op"),
        F.when(op.isin("u", "d"), image(F.lit(UNAVAILABLE))).alias("before"),
        F.when(op != "d", image(xml)).alias("after"),
        F.struct(F.lit("events").alias("table"), (ms - ms % 1000).alias("ts_ms")).alias("source"),
        (ms + 5).alias("ts_ms"),
        event_partition().alias("partition"),
        event_offset().alias("_offset"),
        F.timestamp_millis(ms + event_id % 3000).alias("timestamp"),
    )
    offset = F.col("_offset") + F.col("is_tombstone").cast("int")
    return to_messages(changes, "partition", "_offset", "timestamp").select(
        "key", "value", "partition", offset.alias("offset"), "timestamp"
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_messages(table(spark, sf_dir, "events"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_envelope(messages(spark, sf_dir))


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages, and behind some of them one that is cut off or no JSON at all, at an offset of its own."""
    events = table(spark, sf_dir, "events").filter((F.col("event_id") % 25 == 0) & (F.col("event_type") != "error"))
    cut = F.when(F.col("offset") % 4 == 0, F.substr("value", F.lit(1), F.lit(8))).otherwise(F.lit("not json"))
    bad = change_messages(events).withColumns({"value": cut, "offset": F.col("offset") + 1})
    return messages(spark, sf_dir).unionByName(bad)


def file_stream(parts: list[DataFrame], path: str, schema: str, derive: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """A stream with a micro-batch for each of ``parts``, as ``derive`` makes it of them, added to ``path`` one after the other.

    Each part has the same number of files, as the source counts files: as many as the largest needs to have about
    FILE_ROWS rows in a file. What a part lacks is made up by empty files.
    """
    spark = parts[0].sparkSession
    largest = max(part.count() for part in parts)
    files = max(1, -(-largest // FILE_ROWS))
    held = 0
    for part in parts:
        dealt = derive(part).coalesce(1) if files == 1 else derive(part.repartition(files))
        dealt.write.mode("append").parquet(path)
        held += files
        for _ in range(held - sum(name.startswith("part-") for name in names(spark, path))):
            spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(path)
    return change_stream(spark, {"maxFilesPerTrigger": str(files)}, "parquet", path, schema)


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as a stream of BATCHES micro-batches in log order."""
    path, n = scratch_dir(spark, "topic"), event_count(spark, sf_dir)
    events = table(spark, sf_dir, "events")
    parts = [events.filter(F.col("event_id").between(n * k // BATCHES, n * (k + 1) // BATCHES - 1)) for k in range(BATCHES)]
    return parse_envelope(file_stream(parts, path, MESSAGE, change_messages))


# ---- observations ----------------------------------------------------------------------------------


def _events_with_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        event_partition().alias("kafka_partition"),
        event_offset().alias("kafka_offset"),
        event_op().alias("op"),
        event_log_ms().alias("t3"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls of both stages: each stage of an event is seen three times, 50 ms apart.

    Every tenth event is one that no poll saw. Deletes are never seen parsed.
    """
    events = _events_with_identity(spark, sf_dir).filter(F.col("event_id") % 10 != 9)
    polls = F.explode(F.array(F.lit(0), F.lit(50), F.lit(100))).alias("poll")
    raw_ms = F.col("t3") + F.col("event_id") % 700
    raw = events.select("*", polls).select(
        "kafka_partition", "kafka_offset", F.lit("raw").alias("stage"), (raw_ms + F.col("poll")).alias("seen_ms")
    )
    parsed = (
        events.filter(F.col("op") != "d")
        .select("*", polls)
        .select(
            "kafka_partition",
            "kafka_offset",
            F.lit("parsed").alias("stage"),
            (raw_ms + F.col("event_id") % 5 + F.col("poll")).alias("seen_ms"),
        )
    )
    return raw.unionByName(parsed)


def observation_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The polls as a stream of BATCHES + 1 micro-batches; every second poll, by its hash, comes a batch late.

    So a change is known before it was seen, or was seen earlier than what was known of it so far.
    """
    path, n = scratch_dir(spark, "polls"), event_count(spark, sf_dir)
    ids = _events_with_identity(spark, sf_dir).select(*EVENT_KEY, "event_id")
    late = F.pmod(F.xxhash64(*EVENT_KEY, "stage", "seen_ms"), F.lit(2))
    batch = (F.col("event_id") * BATCHES / n).cast("int") + late
    polls = observations(spark, sf_dir).join(ids, EVENT_KEY).withColumn("batch", batch).drop("event_id")
    polls = stored(polls, "polls-by-batch")
    return file_stream([polls.filter(F.col("batch") == k).drop("batch") for k in range(BATCHES + 1)], path, OBSERVATION)


def seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both stages held before polling began: a tenth of the events raw, an eighth parsed."""
    events, n = _events_with_identity(spark, sf_dir), event_count(spark, sf_dir)
    stages = F.array(
        F.when(F.col("event_id") < n // 10, "raw"),
        F.when((F.col("event_id") < n // 8) & (F.col("op") != "d"), "parsed"),
    )
    return (
        events.select("kafka_partition", "kafka_offset", F.explode(stages).alias("stage"))
        .filter(F.col("stage").isNotNull())
    )


def recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that an earlier run had measured: the third tenth."""
    n = event_count(spark, sf_dir)
    return (
        _events_with_identity(spark, sf_dir)
        .filter(F.col("event_id").between(n // 5, n * 3 // 10))
        .select("kafka_partition", "kafka_offset")
    )


def nothing_recorded(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], OBSERVATION).select("kafka_partition", "kafka_offset")
