"""Keyed tables with a log of versions, dealt to buckets by key.

``data/layer=S-xxxx/bucket=B`` has the rows of one layer by bucket; ``log/N.json`` names the layers of version N, so a
reader opens one small file and lists no history. A version is there whole or not at all. What it names stays until
``vacuum``, so a reader is not disturbed by later batches and merges, and any version that is kept can be read.

A batch adds a layer. When a level has ``every`` layers they are merged into one of the next level, so a row is written
once a level, not once a merge of the whole table. A reader that asks for keys opens their buckets only; inside them,
Parquet's own bounds and key filters skip what cannot hold a short list of keys.

One stream writes a table, as Structured Streaming has it; a batch that is repeated finds itself in the log.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cdcflow.sources import files

EVERY = 8  # layers of a level before they are merged
BUCKETS = 16  # for a few GB; a large table takes as many as give it files of a few hundred MB
SINGLE_FOLDERS = 32
FEW_KEYS = 200  # asked for by value in the scan; more are joined

Merge = Callable[[DataFrame], DataFrame]


@dataclass
class Version:
    """A version of a table: its number, the newest batch in it, how many layers were ever added, and its layers."""

    number: int = -1
    batch_id: int = -1
    added: int = 0
    schema: str = ""
    layers: list[dict] = field(default_factory=list)


@dataclass
class KeyedTable:
    """The table at ``path``. ``merge`` makes one row per key of the rows of some layers in a row; it keeps the columns,
    ``batch_id`` (the number of the layer a row came with) among them."""

    spark: SparkSession
    path: str
    keys: Sequence[str]
    merge: Merge
    buckets: int = BUCKETS
    every: int = EVERY
    forget_after: int | None = None

    # ---- the log -----------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        found = files.names(self.spark, f"{self.path}/log")
        return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json") and not n.startswith("_"))

    def version(self, number: int | None = None, below: int | None = None) -> Version:
        """A version by its number, the newest one, or the newest whose batches are all before ``below``."""
        numbers = self.versions()
        if number is not None and number not in numbers:
            raise ValueError(f"version {number} of {self.path} is not kept")
        for n in reversed(numbers if number is None else [number]):
            found = Version(**json.loads(files.read_text(self.spark, f"{self.path}/log/{n:020d}.json")))
            if below is None or found.batch_id < below:
                return found
        return Version()

    def _commit(self, version: Version) -> None:
        text = json.dumps(vars(version))
        if not files.put_if_absent(self.spark, f"{self.path}/log/{version.number:020d}.json", text):
            raise RuntimeError(f"another writer has committed version {version.number} of {self.path}")

    # ---- writing -----------------------------------------------------------------------------------

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, number: int) -> dict | None:
        layer = f"{number:012d}-{uuid.uuid4().hex[:8]}"
        folder = f"{self.path}/data/layer={layer}"
        writer = rows.withColumn("bucket", self.bucket()).hint("rebalance", "bucket").write.partitionBy("bucket")
        for key in self.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
            writer = writer.option(f"parquet.bloom.filter.adaptive.enabled#{key}", "true")
        writer.parquet(folder)
        found = [n.removeprefix("bucket=") for n in files.names(self.spark, folder) if n.startswith("bucket=")]
        return {"name": layer, "level": 0, "buckets": sorted(map(int, found))} if found else None

    def add(self, rows: DataFrame, batch_id: int | None) -> Version:
        """Commit the rows of a batch, then merge levels that are full. A batch that is in the log already stays as it is.

        Rows that belong to no batch (None) are added to what the newest one left.
        """
        now = self.version()
        if batch_id is None:
            batch_id = now.batch_id
        elif batch_id <= now.batch_id:
            return now
        rows = rows.drop("batch_id").withColumn("batch_id", F.lit(now.added).cast("bigint"))
        layer = self._write(rows, now.added)
        schema = now.schema or json.dumps(rows.schema.jsonValue())
        now = Version(now.number + 1, batch_id, now.added + 1, schema, now.layers + [layer] * bool(layer))
        self._commit(now)
        return self.merge_levels()

    def merge_levels(self) -> Version:
        """Merge the layers of each level that has ``every`` of them (two at least), lowest first."""
        now, most = self.version(), max(2, self.every)
        while full := [x for x in {y["level"] for y in now.layers} if sum(y["level"] == x for y in now.layers) >= most]:
            now = self._merged(now, [y for y in now.layers if y["level"] <= min(full)])
        return now

    def merge_all(self) -> Version:
        now = self.version()
        return self._merged(now, now.layers) if len(now.layers) > 1 else now

    def _merged(self, now: Version, old: list[dict]) -> Version:
        rows = self.merge(self._rows(now, old))
        if self.forget_after is not None and len(old) == len(now.layers) and "deleted" in rows.columns:
            rows = rows.filter(~F.col("deleted") | (F.col("batch_id") >= now.added - self.forget_after))
        layer = self._write(rows, now.added - 1)
        kept = [x for x in now.layers if x not in old]
        new = [layer | {"level": max(x["level"] for x in old) + 1}] if layer else []
        now = Version(now.number + 1, now.batch_id, now.added, now.schema, kept + new)
        self._commit(now)
        return now

    def vacuum(self, keep: int = 10) -> list[str]:
        """Delete all but the newest ``keep`` versions, and the layers that none of these names; returns what went.

        Versions of a batch that may still be repeated have to stay, so two are kept at least.
        """
        numbers = self.versions()
        kept, gone = numbers[-max(keep, 2) :], []
        named = {x["name"] for n in kept for x in self.version(n).layers}
        newest = self.version().added
        for name in files.names(self.spark, f"{self.path}/data"):
            layer = name.removeprefix("layer=")
            # A layer that is being written has a number which is not in the log yet.
            if name.startswith("layer=") and layer not in named and int(layer.split("-")[0]) < newest:
                gone.append(f"{self.path}/data/{name}")
        gone += [f"{self.path}/log/{n:020d}.json" for n in numbers if n not in kept]
        for path in gone:
            files.remove(self.spark, path)
        return gone

    # ---- reading -----------------------------------------------------------------------------------

    def _rows(self, version: Version, layers: list[dict], buckets: Sequence[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(json.loads(version.schema))
        layers = [x | {"buckets": [b for b in x["buckets"] if buckets is None or b in buckets]} for x in layers]
        layers = [x for x in layers if x["buckets"]]
        if not layers:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/data/layer={x['name']}" for x in layers]
        single = [f"{folder}/bucket={b}" for folder, x in zip(folders, layers, strict=True) for b in x["buckets"]]
        # Some folders are named to the scan one by one; of many it prunes those that it does not need.
        paths = single if buckets is not None and len(single) <= SINGLE_FOLDERS else folders
        found = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths)
        return (found if buckets is None else found.filter(F.col("bucket").isin(list(buckets)))).select(*schema.names)

    def rows(self, version: int | None = None, below: int | None = None, keys: DataFrame | None = None) -> DataFrame | None:
        """The rows of all layers; ``keys`` asks for those of some keys alone. None before the first batch.

        What comes to the driver of ``keys`` is bounded: the buckets, and at most FEW_KEYS of them.
        """
        at = self.version(version, below)
        if not at.schema:
            return None
        if keys is None:
            return self._rows(at, at.layers)
        keys = keys.select(*self.keys)
        buckets = keys.agg(F.collect_set(self.bucket())).first()[0]
        # Many buckets have many keys; only of few ones is it worth the while to look at each.
        first = keys.distinct().limit(FEW_KEYS + 1).collect() if len(buckets) <= self.buckets // 2 else None
        found = self._rows(at, at.layers, buckets)
        if first is None or len(first) > FEW_KEYS or any(v is None for r in first for v in r):
            same = [F.col(f"_r.{k}").eqNullSafe(F.col(f"_k.{k}")) for k in self.keys]
            return found.alias("_r").join(keys.distinct().alias("_k"), same, "left_semi")
        for i, key in enumerate(self.keys):
            found = found.filter(F.col(key).isin(sorted({r[i] for r in first})))
        if len(self.keys) > 1:
            found = found.join(F.broadcast(self.spark.createDataFrame(first, keys.schema)), list(self.keys), "left_semi")
        return found

    def read(
        self, deleted: bool = False, version: int | None = None, below: int | None = None, keys: DataFrame | None = None
    ) -> DataFrame | None:
        """One row per key, deleted keys only if asked for."""
        rows = self.rows(version, below, keys)
        if rows is None:
            return None
        rows = self.merge(rows)
        return rows if deleted or "deleted" not in rows.columns else rows.filter(~F.col("deleted"))

    def follow(self, view: str, columns: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """Let the global temporary view ``view`` show the newest version. Called after each commit, it makes a view
        that all sessions of the application see and that moves on with the table."""
        rows = self.read()
        if rows is not None:
            columns(rows).createOrReplaceGlobalTempView(view)


def is_logged(spark: SparkSession, path: str) -> bool:
    return bool(files.names(spark, f"{path}/log"))
