"""Tables changed file by file: equal to the same change on whole tables, and only what a change touches is written."""

import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cdcflow.operators import mutate
from cdcflow.sources.filetable import FileTable

SCHEMA = "recid STRING, n BIGINT, xmlrecord STRING"


def rows(spark, numbers, text="old"):
    return spark.createDataFrame([(f"K{i:06d}", i, f"{text} {i}") for i in numbers], SCHEMA)


@pytest.fixture()
def table(spark, tmp_path, request):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that small tables have several files
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    made = FileTable(spark, str(tmp_path / "table"))
    made.create(rows(spark, range(2000)))
    return made


def listed(df):
    return sorted(map(tuple, df.collect()), key=repr)


def digests(table, at):
    names = [r.file for r in table.manifest(at).select("file").collect()]
    return {n: hashlib.sha256((Path(table.path) / "data" / n).read_bytes()).hexdigest() for n in names}


def test_merge_writes_touched_files_only(spark, table):
    before = digests(table, table.snapshot())
    assert len(before) > 2
    old, new = table.read(), rows(spark, [5, 6, 7], "new")
    want = listed(mutate.merge_upsert(old, new))
    after = digests(table, table.merge(new))
    untouched = before.keys() & after.keys()
    assert len(untouched) == len(before) - 1
    assert all(before[n] == after[n] for n in untouched)
    assert listed(table.read()) == want
    assert listed(table.read(0)) == listed(rows(spark, range(2000)))


def test_merge_of_many_keys_adds_and_replaces(spark, table):
    new = rows(spark, range(1500, 2500), "new")
    want = listed(mutate.merge_upsert(table.read(), new))
    before = digests(table, table.snapshot())
    after = digests(table, table.merge(new))
    assert before.keys() & after.keys()  # files below the least key stay
    assert listed(table.read()) == want


def test_marks_write_no_data_file(spark, table):
    before = digests(table, table.snapshot())
    table.delete(F.col("n") % 3 == 0)
    table.delete_keys(rows(spark, [1, 3, 4, 99999]))
    at = table.snapshot()
    assert digests(table, at) == before
    assert table.manifest(at).agg(F.sum("marked")).first()[0] == len({i for i in range(2000) if i % 3 == 0} | {1, 3, 4})
    assert listed(table.read()) == listed(rows(spark, [i for i in range(2000) if i % 3 and i not in (1, 4)]))
    assert listed(table.read(1)) == listed(rows(spark, [i for i in range(2000) if i % 3]))


def test_deleting_what_is_not_there_changes_nothing(spark, table):
    assert table.delete(F.lit(None).cast("boolean")).number == 0
    assert table.delete_keys(rows(spark, [])).number == 0
    assert table.merge(rows(spark, [])).number == table.upsert(rows(spark, [])).number == 0
    assert table.update(rows(spark, [99999]), ["xmlrecord"]).number == 0


def test_update_and_upsert_add_files(spark, table):
    before = digests(table, table.snapshot())
    news = spark.createDataFrame([("K000001", None, 1), ("K000900", "x", 1), ("none", "x", 1)], "recid STRING, xmlrecord STRING, other INT")
    want = listed(mutate.apply_update(table.read(), news))
    after = digests(table, table.update(news, ["xmlrecord"]))
    assert before.items() <= after.items()
    assert listed(table.read()) == want
    more = rows(spark, range(1990, 2010), "more")
    want = listed(mutate.merge_upsert(table.read(), more))
    assert before.items() <= digests(table, table.upsert(more)).items()
    assert listed(table.read()) == want


def test_fold_and_vacuum(spark, table):
    table.delete(F.col("n") < 900)
    table.delete(F.col("n") == 1999)
    want = listed(table.read())
    at = table.fold(0.5)
    assert at.marks and 0 < table.manifest(at).agg(F.sum("marked")).first()[0] < 900
    assert listed(table.read()) == want
    at = table.fold()
    assert not at.marks and table.manifest(at).agg(F.sum("marked"), F.sum("rows")).first()[:] == (0, len(want))
    assert listed(table.read()) == want
    assert any("data/" in n for n in table.vacuum(1))
    assert listed(table.read()) == want and table.versions() == [at.number]
    left = {f"{p.parent.name}/{p.name}" for p in (Path(table.path) / "data").glob("*/*.parquet")}
    assert left == set(digests(table, at))
    assert not table.vacuum(1)


def test_marks_of_files_with_many_rows(spark, tmp_path):
    table = FileTable(spark, str(tmp_path / "table"), "id")
    table.create(spark.range(100_000))
    gone = [0, 7, 8, 32_767, 32_768, 32_769, 65_535, 65_536, 99_999]
    table.delete(F.col("id").isin(gone))
    table.delete(F.col("id").between(40_000, 70_000))
    assert table.manifest(table.snapshot()).agg(F.max("rows")).first()[0] > 70_000
    assert {r.id for r in table.read().collect()} == set(range(100_000)) - set(gone) - set(range(40_000, 70_001))


def test_null_keys_match_nothing(spark, tmp_path):
    table = FileTable(spark, str(tmp_path / "table"))
    base = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("K1", 3, None)], SCHEMA)
    table.create(base)
    new = spark.createDataFrame([(None, 9, "n"), ("K1", 4, "x")], SCHEMA)
    want = listed(mutate.merge_upsert(base, new))
    table.merge(new)
    assert listed(table.read()) == want
    table.delete_keys(spark.createDataFrame([(None,), ("K1",)], "recid STRING"))
    assert listed(table.read()) == [r for r in want if r[0] is None]


def test_two_updates_of_a_key_commit_nothing(spark, table):
    with pytest.raises(Exception, match="two updates of one key"):
        table.merge(rows(spark, [1, 1]))
    assert table.versions() == [0]


def test_empty_table(spark, tmp_path):
    table = FileTable(spark, str(tmp_path / "table"))
    table.create(rows(spark, []))
    assert table.read().count() == 0 and table.delete(F.lit(True)).number == 0
    table.merge(rows(spark, [1]))
    table.delete(F.lit(True))
    assert table.read().count() == 0 and table.fold().marks == [] and table.read().count() == 0


def test_a_second_writer_fails(spark, table, monkeypatch):
    stale = table.snapshot()
    table.delete(F.col("n") == 1)
    monkeypatch.setattr(table, "snapshot", lambda number=None: stale)
    with pytest.raises(RuntimeError, match="another writer"):
        table.delete(F.col("n") == 2)


def test_random_changes_equal_a_model(spark, table):
    rng, model = random.Random(5), {f"K{i:06d}": (f"K{i:06d}", i, f"old {i}") for i in range(2000)}
    for step in range(6):
        picked = rng.sample(range(2200), rng.choice([1, 20, 400]))
        news = rows(spark, picked, f"s{step}")
        if step % 3 == 2:
            table.delete_keys(news)
            for i in picked:
                model.pop(f"K{i:06d}", None)
        else:
            (table.merge if step % 3 else table.upsert)(news)
            model |= {r[0]: tuple(r) for r in news.collect()}
        if step == 3:
            table.fold(0.2)
        assert listed(table.read()) == sorted(model.values(), key=repr)
