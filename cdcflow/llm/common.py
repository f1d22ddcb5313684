"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cdcflow.session import scratch_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


BATCH_BYTES = 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session set to hand Python tasks at most BATCH_BYTES at once.

    A task holds a batch several times over, as columns and as Python objects, and texts can be long.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(key, None) != str(BATCH_BYTES):
        df.sparkSession.conf.set(key, str(BATCH_BYTES))
    return df


def give_back() -> None:
    """Return to the system what this process has freed; Arrow's and C's allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
    if trim:
        trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``task``, behind which its worker gives memory back: it may stand idle, or run a smaller task, while others need it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder that the cluster shares, and read from there: computed once, lineage cut."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, column: str) -> str:
    """The name of a table with the rows of ``df``, dealt by ``column`` in files, so that what groups by it need not
    shuffle them again. Whoever made it drops it."""
    table = f"{name}_{uuid.uuid4().hex}"
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", "zstd").bucketBy(n, column).saveAsTable(table, format="parquet")
    return table


def spread_keys(spark: SparkSession) -> list[int]:
    """As many numbers as the session has shuffle partitions, that hash to one partition each.

    Buckets dealt out by these keys fill the partitions evenly. Were the hash another one, partitions would be
    uneven, nothing else.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found: dict[int, int] = {}
    tries = 16 * n
    while len(found) < n:
        rows = spark.range(tries).selectExpr("id", f"pmod(hash(id), {n}) AS p").groupBy("p").agg({"id": "min"})
        found = dict(map(tuple, rows.collect()))
        tries *= 2
    return [found[p] for p in range(n)]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
