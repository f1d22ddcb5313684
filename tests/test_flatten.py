from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from cdcflow.operators import flatten
from cdcflow.plans import account
from cdcflow.plans.views import register_views
from cdcflow.schema import TAG_PATTERN
from cdcflow.sources.lookup import load_lookup, lookup_rows, names_from_lookup
from cdcflow.sources.records import read_records
from helpers import change, changes, record, rows

LOOKUP = [
    ("c1", None, "customer", False),
    ("c3", None, "title", False),
    ("c5", None, "note", False),
    ("c20", "1", "first_local", False),
    ("c20", "2", "second_local", False),
    ("c23", None, "balance", False),
    ("c23", "7", "seventh_balance", False),
    ("c46", None, "day", True),
]
COLUMNS = ["customer", "title", "note", "first_local", "second_local", "balance", "seventh_balance"]
COLUMNS += [f"day_{k:02d}" for k in range(1, 13)]

RECORDS = {
    "full": "<c1>7</c1><c3>عميل</c3><c5></c5><c20>raw</c20><c20 m=\"2\">b</c20><c23>-12.50</c23><c77>?</c77>"
    "<c46>a</c46><c46 m=\"2\">b</c46><c46 m=\"10\">j</c46><c46 m=\"100\">cut</c46><bts>5</bts><ots>6</ots>",
    "repeats": '<c23>9</c23><c23 m="3">10</c23><c23>5</c23><c23 m="7">seven</c23>',
    "odd": '<c1/><c3 x="1">no</c3><c5>a&amp;b > c</c5><c23 m="x">no</c23><c46\tm="4">tab</c46><c1>1<b/></c1>',
    "mismatch": "<c1>1</c2><c3>ok</c3>",
    "unknown": "<c99>1</c99>",
    "empty": "",
}


@pytest.fixture(scope="module")
def lookup(spark):
    return lookup_rows(spark, LOOKUP).cache()


@pytest.fixture(scope="module")
def records(spark):
    data = [(k, record(k, v)) for k, v in RECORDS.items()] + [("null", None)]
    return spark.createDataFrame(data, "recid STRING, xmlrecord STRING").cache()


def wide_rows(df):
    return {r.recid: {c: r[c] for c in df.columns if c != "recid" and r[c] is not None} for r in df.collect()}


WIDE = {
    "full": {
        "customer": "7",
        "title": "عميل",
        "note": "",
        "second_local": "b",
        "balance": "-12.50",
        "day_01": "a",
        "day_02": "b",
        # position 100 is cut to two digits and meets position 10; the greater text stays
        "day_10": "j",
    },
    "repeats": {"balance": "9", "seventh_balance": "seven"},
    "odd": {"note": "a&amp;b > c", "day_04": "tab"},
    "mismatch": {"title": "ok"},
    "unknown": {},
}


def test_unpivot(spark, records):
    got = rows(flatten.unpivot_tags(records.filter("recid = 'full'"), ["recid"]).drop("recid"), "field", "position", "value")
    assert ("c20", None, "raw") in got and ("c20", "2", "b") in got and ("c5", None, "") in got
    assert len(got) == 11 and not [g for g in got if g[0] in ("bts", "ots")]
    keys = {r.recid for r in flatten.unpivot_tags(records, ["recid"]).select("recid").collect()}
    assert keys == {"full", "repeats", "odd", "mismatch", "unknown"}


def test_names(spark, records, lookup):
    got = flatten.resolve_names(flatten.unpivot_tags(records, ["recid"]), lookup)
    names = {(r.recid, r.field, r.position, r.value): r.column_name for r in got.collect()}
    assert names[("full", "c20", None, "raw")] is None  # no position never meets position 1
    assert names[("full", "c77", None, "?")] is None
    assert names[("repeats", "c23", "7", "seven")] == "seventh_balance"  # exact before base
    assert names[("full", "c46", "100", "cut")] == "day_10"


def test_wide(spark, records, lookup):
    wide = flatten.flatten_wide(records, lookup, COLUMNS)
    assert wide.columns == ["recid", *COLUMNS]
    assert wide_rows(wide) == WIDE


def test_records_of_one_key_are_one_row(spark, lookup):
    data = [("A", record("A", "<c1>1</c1><c3>b</c3>")), ("A", record("A", "<c1>2</c1><c46>x</c46>")), ("A", record("A"))]
    df = spark.createDataFrame(data, "recid STRING, xmlrecord STRING")
    assert wide_rows(flatten.flatten_wide(df, lookup, COLUMNS)) == {"A": {"customer": "2", "title": "b", "day_01": "x"}}


def brute_wide(recid, xml, lookup):
    """One record with the regular expressions of Python."""
    exact = {(f, m): n for f, m, n, _ in lookup if m is not None}
    base = {f: (n, multi) for f, m, n, multi in lookup if m is None}
    found, out = re.findall(TAG_PATTERN, xml), {}
    for field, position, value in found:
        name = exact.get((field, position)) if position else None
        if name is None and field in base:
            name, multi = base[field]
            if multi:
                name += "_" + (position or "1").rjust(2, "0")[:2]
        if name is not None:
            out[name] = max(out.get(name, value).encode(), value.encode()).decode()
    return out if found else None


def test_random_records_against_brute_force(spark, lookup):
    rng = random.Random(17)
    pieces = ["x", "9", "10", "ع", "&amp;", ">", "$", "\\", '"', " ", "\n", ""]

    def element():
        field = rng.choice(["c1", "c3", "c20", "c23", "c46", "c99", "c046", "d1", "c"])
        mark = rng.choice(["", "", ' m="2"', ' m="7"', ' m="11"', ' m="123"', '  m="3"', ' m=""', ' k="1"'])
        close = field if rng.random() < 0.9 else "c1"
        return f"<{field}{mark}>" + "".join(rng.choices(pieces, k=rng.randrange(4))) + f"</{close}>"

    data = [(f"R{k}", record(f"R{k}", "".join(element() for _ in range(rng.randrange(8))))) for k in range(400)]
    want = {k: w for k, x in data if (w := brute_wide(k, x, LOOKUP)) is not None}
    names = sorted({n for w in want.values() for n in w})
    df = spark.createDataFrame(data, "recid STRING, xmlrecord STRING").repartition(4)
    assert wide_rows(flatten.flatten_wide(df, lookup, names)) == want


def test_lookup_of_any_size_gives_the_same(spark, records, lookup):
    """Beyond the broadcast threshold, and with more rows than any driver-side limit there has been."""
    more = spark.range(6000).selectExpr(
        "concat('c', id + 1000) AS field_index", "CAST(NULL AS STRING) AS m_index", "concat('n', id) AS resolved_name_en", "false AS is_multivalue"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = flatten.flatten_wide(records, lookup.unionByName(more), COLUMNS)
        assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
        assert wide_rows(df) == WIDE
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ambiguous_lookup(spark, records, lookup):
    twice = lookup.unionByName(lookup.filter("field_index = 'c1'").withColumn("resolved_name_en", F.lit("second")))
    got = wide_rows(flatten.flatten_wide(records, twice, ["customer", "second"]))
    assert got["full"] == {"customer": "7", "second": "7"}


def test_empty_lookup(spark, records):
    nothing = lookup_rows(spark, [])
    assert wide_rows(flatten.flatten_wide(records, nothing, ["customer"])) == {k: {} for k in WIDE}


def test_plan_runs_the_pattern_once_and_broadcasts_a_small_lookup(spark, records):
    plan = flatten.flatten_wide(records, lookup_rows(spark, LOOKUP), COLUMNS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    plan = flatten.resolve_names(flatten.unpivot_tags(records, ["recid"]), lookup_rows(spark, LOOKUP))
    assert plan._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 2


def test_per_event_counts(spark, lookup):
    log = changes(
        spark,
        [
            change("c", "A", record("A", RECORDS["full"]), 0),
            change("u", "A", record("A", "<c99>1</c99>"), 1),
            change("u", "A", record("A"), 2),
            change("d", "A", None, 3),
            change(None, None, None, 4),
        ],
    )
    want = [(0, 0, "A", 9), (0, 1, "A", 0)]
    assert rows(flatten.flatten_events(log, lookup), "kafka_offset") == want


def test_names_from_lookup(spark, lookup):
    names = names_from_lookup(lookup, 3)
    assert names[:2] == ["customer", "title"] and names[-3:] == ["day_01", "day_02", "day_03"]
    assert names_from_lookup(lookup, {"c46": 1})[-1] == "day_01"


def test_lookup_file_and_account_view(spark, tmp_path):
    lines = ["account,c1,,customer,2026-01-01", "account,c20,2,local,2026-01-01"]
    lines += [f"account,{field},,many_{field},2026-01-01" for field in account.POSITIONS]
    lines += [f"account,c{1000 + k},,field_{k},2026-01-01" for k in range(53)]
    path = tmp_path / "lookup.csv"
    path.write_text("\n".join(['"table_name","field_index","m_index","resolved_name_en","dt"', *lines]) + "\n", encoding="utf-8")
    lookup = load_lookup(spark, str(path), account.POSITIONS)
    assert lookup.filter("m_index IS NULL AND is_multivalue").count() == 9
    assert lookup.filter("m_index = '2' AND NOT is_multivalue").count() == 1
    body = '<c1>customer</c1><c20>x</c20><c20 m="2">local</c20>'
    body += "".join(f"<c{1000 + k}>field_{k}</c{1000 + k}>" for k in range(53))
    for field, last in account.POSITIONS.items():
        body += f"<{field}>many_{field}_01</{field}>"
        body += "".join(f'<{field} m="{k}">many_{field}_{k:02d}</{field}>' for k in range(2, last + 1))
    records = spark.createDataFrame([("A", record("A", body))], "recid STRING, xmlrecord STRING")
    view = account.account_view(records, lookup)
    assert len(view.columns) == 166
    assert list(view.head())[1:] == view.columns[1:]
    with pytest.raises(TypeError):
        load_lookup(spark, str(path))


def test_views(spark, lookup):
    log = changes(spark, [change("c", "A", record("A", RECORDS["full"]), 0), change("d", "A", None, 1),
                          change("c", "B", record("B", "<c1>2</c1>"), 2)])
    names = register_views(spark, log, lookup, columns=COLUMNS, prefix="bank_")
    assert len(names) == 9 and all(spark.catalog.tableExists(n) for n in names)
    assert rows(spark.table("bank_account_columns").select("recid", "customer"), "recid") == [("B", "2")]
    got = spark.sql("SELECT before_xml FROM bank_account_audit WHERE op = 'd'").head()[0]
    assert got == record("A", RECORDS["full"])
    assert spark.sql("SELECT count(*), count(total_ms) FROM bank_cdc_trace WHERE recid LIKE 'A%'").head() == (2, 0)


def test_virtual_columns(spark):
    data = [
        ("a", record("a", "<c1>12</c1><c2>6510</c2><c8>EGP</c8><c8 m=\"2\">USD</c8><c6>a&amp;b</c6><c13></c13>")),
        ("b", record("b", f"<c1>12.5x</c1><c6>{'ع' * 200}</c6>")),
        ("c", "<row><c1>broken"),
        ("d", None),
    ]
    records = spark.createDataFrame(data, "recid STRING, xmlrecord STRING")
    got = {r.recid: r for r in account.account_virtual_columns(records).collect()}
    assert (got["a"].customer, got["a"].category, got["a"].currency, got["a"].mnemonic) == (12, 6510, "EGP", "a&b")
    assert got["a"].posting_restrict is None and got["b"].customer is None
    assert got["b"].mnemonic == "ع" * 125
    assert got["c"].customer is None and got["d"].customer is None and len(got) == 4


def test_record_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.xml").write_text(record(f"R{k}", "\n  <c3>عميل</c3>\n"), encoding="utf-8")
    got = rows(read_records(spark, str(tmp_path)), "recid")
    assert [g[0] for g in got] == ["R0", "R1", "R2"] and "عميل" in got[0][1]
    many = tmp_path / "many"
    many.mkdir()
    (many / "all.xml").write_text("\n".join(record(f"R{k}", f"\n<c1>{k}</c1>") for k in range(5)) + "\n", encoding="utf-8")
    got = rows(read_records(spark, str(many), one_per_file=False), "recid")
    assert got == [(f"R{k}", record(f"R{k}", f"\n<c1>{k}</c1>")) for k in range(5)]


def test_damaged_records_are_reported(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<rows>\n" + record("A", "<c1>1</c1>") + "\n" + record("B") + "\n<row id=\"C\"><c1>2</c1", encoding="utf-8")
    with pytest.raises(Exception, match="damaged record"):
        read_records(spark, str(tmp_path), one_per_file=False).collect()
    got = read_records(spark, str(tmp_path), one_per_file=False, on_bad="keep")
    assert {(r.recid, r.xmlrecord) for r in got.collect()} == {
        ("A", record("A", "<c1>1</c1>")), ("B", record("B")), (None, '<row id="C"><c1>2</c1')
    }
    with pytest.raises(Exception, match="damaged record"):
        read_records(spark, str(tmp_path)).collect()


def test_frequent_fields_are_taken_apart(spark):
    names = [("a", None, "x", True), ("a", "2", "second", False), ("b", None, "y", False), ("b", None, "z", False), ("c", None, "w", False)]
    lookup = lookup_rows(spark, names)
    tags = [(i, f, p, f"{f}{i}") for i in range(9) for f, p in (("a", None), ("a", "2"), ("a", "3"), ("d", None))]
    tags += [(i, f, None, "v") for i, f in ((1, "b"), (2, "c"), (3, "e"))]
    tags = spark.createDataFrame(tags, "recid INT, field STRING, position STRING, value STRING")
    plain = sorted(map(str, flatten.resolve_names(tags, lookup).collect()))
    for hot_rows in (0, 5, 1000):
        split = flatten.resolve_names(tags, lookup, hot_rows)
        assert sorted(map(str, split.collect())) == plain
    apart = flatten.resolve_names(tags, lookup, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in apart and "LeftSemi" in apart


def test_wide_rows_are_shuffled_by_the_places_of_names(spark):
    rows = [("a", "x", "1"), ("a", "x", "3"), ("a", "z", "2"), ("b", None, "9"), ("b", "w", "8"), (None, "z", "7"), ("c", "x", None)]
    named = spark.createDataFrame(rows, "recid STRING, column_name STRING, value STRING")
    wide = flatten.pivot_wide(named, ["recid"], ["z", "x", "y"])
    assert {tuple(r) for r in wide.collect()} == {("a", "2", "3", None), ("b", None, None, None), (None, "7", None, None), ("c", None, None, None)}
    assert wide.columns == ["recid", "z", "x", "y"]
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(recid#\d+, _place", plan) and not re.search(r"hashpartitioning\([^)]*column_name", plan)
    twice = flatten.pivot_wide(named, ["recid"], ["x", "x"]).filter("recid = 'a'").first()
    assert tuple(twice) == ("a", "3", "3")
    assert flatten.pivot_wide(named, ["recid"], []).count() == 4
