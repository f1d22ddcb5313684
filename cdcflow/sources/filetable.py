"""Keyed tables of Parquet files, changed file by file.

``log/N.json`` names version N: a manifest with every data file (rows, least and greatest key, rows marked as deleted) and
the layers of marks. A version is there whole or not at all, and any version that is kept can be read.

``merge`` writes the files that hold a key of the updates anew and leaves all others as they are. ``delete``,
``delete_keys``, ``update`` and ``upsert`` write no file anew: they mark rows by their place, a bitmap for each 32,768 rows
of a file, and add files with what is new. A reader joins the marks to the files that have some, and reads the others
plain. ``fold`` writes marked files anew without the marked rows.

Files are in order of the key, so a change looks at those whose range may hold its keys, and there at the key column
alone. What comes to the driver is a line a file, as the file listing of any scan does, and FEW_KEYS keys at most.

A NULL key matches nothing: such rows stay, and such an update is a new row. Keys are unique otherwise; two updates of
one key (or of none) fail the job before anything is committed. An empty set of updates changes nothing. Columns of
updates that the table does not have are left out. ``__file``, ``__row``, ``__bucket`` and ``__bits`` are reserved names.

There is one writer at a time; a second one fails when it commits. A job that is repeated writes new files, and what
no version names goes with ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cdcflow.operators.mutate import unique
from cdcflow.sources import files

FEW_KEYS = 200  # asked for by value; of more, only the least and the greatest
PLACE = ["__file", "__row"]
MARKS = "__file STRING, __bucket BIGINT, __bits BINARY"


@dataclass
class Snapshot:
    """A version: its number, the schema of its rows, the folder of its manifest, its layers of marks."""

    number: int = -1
    schema: str = ""
    manifest: str = ""
    marks: list[str] = field(default_factory=list)


def _bucket() -> Column:
    return F.bitmap_bucket_number(F.col("__row") + 1)


def _is_marked() -> Column:
    """Whether the bitmap has the bit of this row."""
    at = F.bitmap_bit_position(F.col("__row") + 1).cast("int")
    byte = F.expr("substring(__bits, CAST(bitmap_bit_position(__row + 1) AS INT) DIV 8 + 1, 1)")
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(at, F.lit(8))) == 1


@dataclass
class FileTable:
    spark: SparkSession
    path: str
    key: str = "recid"

    # ---- the log -----------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        found = files.names(self.spark, f"{self.path}/log")
        return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json") and not n.startswith("_"))

    def snapshot(self, number: int | None = None) -> Snapshot:
        numbers = self.versions()
        if not numbers or (number is not None and number not in numbers):
            raise ValueError(f"{self.path} has no version {'' if number is None else number}")
        number = numbers[-1] if number is None else number
        return Snapshot(**json.loads(files.read_text(self.spark, f"{self.path}/log/{number:020d}.json")))

    def _commit(self, number: int, schema: str, entries: DataFrame, marks: list[str]) -> Snapshot:
        new = Snapshot(number, schema, self._new("manifest"), marks)
        entries.coalesce(1).write.parquet(f"{self.path}/{new.manifest}")
        if not files.put_if_absent(self.spark, f"{self.path}/log/{number:020d}.json", json.dumps(vars(new))):
            raise RuntimeError(f"another writer has committed version {number} of {self.path}")
        return new

    @staticmethod
    def _new(kind: str) -> str:
        return f"{kind}/{uuid.uuid4().hex}"

    def manifest(self, at: Snapshot) -> DataFrame:
        """A row for each data file: file, rows, low and high (of its keys), marked."""
        key = StructType.fromJson(json.loads(at.schema))[self.key].dataType
        schema = StructType(
            [
                StructField("file", StringType()),
                StructField("rows", LongType()),
                StructField("low", key),
                StructField("high", key),
                StructField("marked", LongType()),
            ]
        )
        return self.spark.read.schema(schema).parquet(f"{self.path}/{at.manifest}")

    # ---- reading -----------------------------------------------------------------------------------

    def _scan(self, schema: StructType, paths: Sequence[str]) -> DataFrame:
        """Rows of some data files (or folders of them) with their places."""
        if not paths:
            places = [StructField("__file", StringType()), StructField("__row", LongType())]
            return self.spark.createDataFrame([], StructType([*schema.fields, *places]))
        found = self.spark.read.schema(schema).parquet(*(f"{self.path}/data/{p}" for p in paths))
        name = F.concat_ws("/", F.element_at(F.split("_metadata.file_path", "/"), -2), F.col("_metadata.file_name"))
        return found.select(*schema.names, name.alias("__file"), F.col("_metadata.row_index").alias("__row"))

    def _marks(self, names: Sequence[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], MARKS)
        found = self.spark.read.schema(MARKS).parquet(*(f"{self.path}/{n}" for n in names))
        return found.groupBy("__file", "__bucket").agg(F.bitmap_or_agg("__bits").alias("__bits"))

    def _live(self, at: Snapshot, entries: DataFrame) -> DataFrame:
        """Rows of the data files in ``entries`` that are not marked, with their places."""
        schema = StructType.fromJson(json.loads(at.schema))
        listed = entries.select("file", "marked").collect()
        plain = self._scan(schema, [r.file for r in listed if not r.marked])
        marked = [r.file for r in listed if r.marked]
        if not marked:
            return plain
        rows = self._scan(schema, marked).withColumn("__bucket", _bucket())
        rows = rows.join(self._marks(at.marks), ["__file", "__bucket"], "left")
        rows = rows.filter(F.col("__bits").isNull() | ~_is_marked())
        return plain.unionByName(rows.select(*plain.columns))

    def read(self, version: int | None = None) -> DataFrame:
        at = self.snapshot(version)
        return self._live(at, self.manifest(at)).drop(*PLACE)

    # ---- finding -----------------------------------------------------------------------------------

    def _holding(self, at: Snapshot, keys: DataFrame) -> tuple[DataFrame, list | None]:
        """The files whose range may hold one of ``keys``, and the keys themselves if they are few."""
        first = [r[0] for r in keys.filter(F.col(self.key).isNotNull()).distinct().limit(FEW_KEYS + 1).collect()]
        entries = self.manifest(at)
        if len(first) > FEW_KEYS:
            low, high = keys.agg(F.min(self.key), F.max(self.key)).first()
            return entries.filter((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low))), None
        may = [F.lit(k).between(F.col("low"), F.col("high")) for k in first]
        return entries.filter(reduce(Column.__or__, may, F.lit(False))), first

    def matched(self, at: Snapshot, keys: DataFrame) -> DataFrame:
        """The rows that hold one of ``keys``, with their places."""
        keys = keys.select(self.key)
        entries, few = self._holding(at, keys)
        rows = self._live(at, entries)
        if few is not None:
            return rows.filter(F.col(self.key).isin(few)) if few else rows.filter(F.lit(False))
        return rows.join(keys, self.key, "left_semi")

    # ---- writing -----------------------------------------------------------------------------------

    def _write(self, schema: StructType, rows: DataFrame) -> DataFrame:
        """New data files in order of the key, as entries of a manifest."""
        folder = uuid.uuid4().hex
        writer = rows.select(*schema.names).repartitionByRange(self.key).sortWithinPartitions(self.key).write
        writer = writer.option(f"parquet.bloom.filter.enabled#{self.key}", "true")
        writer.option(f"parquet.bloom.filter.adaptive.enabled#{self.key}", "true").parquet(f"{self.path}/data/{folder}")
        return self._scan(schema, [folder]).groupBy(F.col("__file").alias("file")).agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(self.key).alias("low"),
            F.max(self.key).alias("high"),
            F.lit(0).cast("bigint").alias("marked"),
        )

    def _kept(self, rows: DataFrame) -> DataFrame:
        """``rows`` written beside the table, so that the steps of a change see the same ones."""
        folder = f"{self.path}/{self._new('draft')}"
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def create(self, rows: DataFrame) -> Snapshot:
        """Version 0: the table with ``rows``."""
        return self._commit(0, json.dumps(rows.schema.jsonValue()), self._write(rows.schema, rows), [])

    def merge(self, updates: DataFrame) -> Snapshot:
        """Matched rows are replaced by the update, other updates are added; only files with a matched row are
        written anew, without their marked rows."""
        at = self.snapshot()
        schema = StructType.fromJson(json.loads(at.schema))
        updates = self._kept(unique(updates.select(*schema.names), self.key))
        if updates.isEmpty():
            return at
        hit = self.matched(at, updates).select(F.col("__file").alias("file")).distinct()
        hit = self._kept(hit.coalesce(1))
        old = self._live(at, self.manifest(at).join(hit, "file", "left_semi")).drop(*PLACE)
        old = old.join(updates.select(self.key), self.key, "left_anti")
        new = self._write(schema, old.select(*schema.names).unionByName(updates))
        entries = self.manifest(at).join(hit, "file", "left_anti").unionByName(new)
        return self._commit(at.number + 1, at.schema, entries, at.marks)

    def _mark(self, at: Snapshot, places: DataFrame, new: DataFrame | None = None) -> Snapshot:
        """Commit marks on the rows at ``places``, and new data files with them."""
        layer = self._new("marks")
        bits = places.groupBy("__file", _bucket().alias("__bucket"))
        bits = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("__row") + 1)).alias("__bits"))
        bits.write.parquet(f"{self.path}/{layer}")
        found = self.spark.read.schema(MARKS).parquet(f"{self.path}/{layer}")
        more = found.groupBy(F.col("__file").alias("file")).agg(F.sum(F.bitmap_count("__bits")).alias("_more"))
        if new is None and more.isEmpty():
            return at
        entries = self.manifest(at).join(more, "file", "left")
        entries = entries.withColumn("marked", F.col("marked") + F.coalesce("_more", F.lit(0))).drop("_more")
        entries = entries if new is None else entries.unionByName(new)
        return self._commit(at.number + 1, at.schema, entries, [*at.marks, layer])

    def delete(self, condition: Column) -> Snapshot:
        """Mark the rows for which the condition is true; an unknown condition keeps its row."""
        at = self.snapshot()
        return self._mark(at, self._live(at, self.manifest(at)).filter(condition).select(*PLACE))

    def delete_keys(self, keys: DataFrame) -> Snapshot:
        """Mark the rows named by ``keys``."""
        at = self.snapshot()
        keys = self._kept(keys.select(self.key).distinct())
        return self._mark(at, self.matched(at, keys).select(*PLACE))

    def update(self, updates: DataFrame, columns: Sequence[str]) -> Snapshot:
        """Set ``columns`` of the rows named by ``updates``, to NULL as well: the old rows are marked. Adds no key."""
        at = self.snapshot()
        schema = StructType.fromJson(json.loads(at.schema))
        updates = self._kept(unique(updates.select(self.key, *columns), self.key))
        renamed = updates.select(self.key, *(F.col(c).alias(f"__new_{c}") for c in columns))
        new = self.matched(at, updates).join(renamed, self.key)
        new = new.withColumns({c: F.col(f"__new_{c}").cast(schema[c].dataType) for c in columns})
        new = self._kept(new.select(*schema.names, *PLACE))
        if new.isEmpty():
            return at
        return self._mark(at, new.select(*PLACE), self._write(schema, new))

    def upsert(self, updates: DataFrame) -> Snapshot:
        """As ``merge``, but matched rows are marked and no file is written anew."""
        at = self.snapshot()
        schema = StructType.fromJson(json.loads(at.schema))
        updates = self._kept(unique(updates.select(*schema.names), self.key))
        if updates.isEmpty():
            return at
        return self._mark(at, self.matched(at, updates).select(*PLACE), self._write(schema, updates))

    def fold(self, least: float = 0.0) -> Snapshot:
        """Write files anew of which more than the share ``least`` is marked, and the marks of the others as one layer."""
        at = self.snapshot()
        worn = (F.col("marked") > 0) & (F.col("marked") > least * F.col("rows"))
        old, kept = self.manifest(at).filter(worn), self.manifest(at).filter(~worn)
        if old.isEmpty():
            return at
        schema, marks = StructType.fromJson(json.loads(at.schema)), []
        new = self._write(schema, self._live(at, old))
        left = kept.filter("marked > 0").select(F.col("file").alias("__file"))
        if not left.isEmpty():
            marks = [self._new("marks")]
            self._marks(at.marks).join(left, "__file", "left_semi").write.parquet(f"{self.path}/{marks[0]}")
        return self._commit(at.number + 1, at.schema, kept.unionByName(new), marks)

    def vacuum(self, keep: int = 10) -> list[str]:
        """Delete all but the newest ``keep`` versions, and what none of these names; returns what went.

        For the writer, between two changes: a change that is under way has files that no version names yet.
        """
        numbers = self.versions()
        kept = [self.snapshot(n) for n in numbers[-max(1, keep) :]]
        named = {m for at in kept for m in (*at.marks, at.manifest)}
        data = {r.file for at in kept for r in self.manifest(at).select("file").collect()}
        gone = [f"log/{n:020d}.json" for n in numbers if n < kept[0].number]
        for kind in ("marks", "manifest", "draft"):
            gone += [p for n in files.names(self.spark, f"{self.path}/{kind}") if (p := f"{kind}/{n}") not in named]
        for folder in files.names(self.spark, f"{self.path}/data"):
            found = [f"{folder}/{n}" for n in files.names(self.spark, f"{self.path}/data/{folder}") if n.endswith(".parquet")]
            used = [f for f in found if f in data]
            gone += [f"data/{f}" for f in found if f not in data] if used else [f"data/{folder}"]
        for name in gone:
            files.remove(self.spark, f"{self.path}/{name}")
        return gone
