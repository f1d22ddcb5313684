"""Session helpers: a local session for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(
    app: str = "cdcflow", cores: str = "*", partitions: int = 8, memory: str = "8g", conf: dict[str, str] | None = None
) -> SparkSession:
    """A quiet ``local[cores]`` session in UTC with adaptive execution; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stored(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """``df`` written to the shared folder and read from there: computed once, lineage cut.

    ``file_rows`` bounds the rows of a file. Spark counts each file it opens as some MB more, so small files also bound the
    rows that one task reads, however well they compress.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for tables and stream checkpoints in the folder all executors share.

    The folder is ``spark.checkpoint.dir`` of the session. Only a session in one process, where every task sees
    the same disk, may leave it unset; then a temporary folder is taken.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        base = tempfile.mkdtemp(prefix="cdcflow-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Settings to start a cluster with. Spark sizes the rest at run time.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Many small shuffle partitions, merged after the fact to about this size.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Record text grows in memory when it is parsed, so keep scan tasks moderate.
    "spark.sql.files.maxPartitionBytes": "128m",
    # Partitions of streaming state are fixed when a query first starts.
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
