"""A folder every executor can reach, for tables written to cut lineage."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_root: str | None = None


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's ``spark.checkpoint.dir``.

    Where that is unset, a local session (tests) gets a temporary folder; a cluster is an error, since a
    machine-local folder is not visible to the other executors.
    """
    global _local_root
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder all executors share")
        _local_root = _local_root or tempfile.mkdtemp(prefix="shelfwise-")
        root = _local_root
    return f"{root.rstrip('/')}/shelfwise/{name}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later uses neither repeat its work nor depend on the
    executors that did it. ``options`` are those of its files."""
    path = shared_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._shared_path = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Deletes what ``materialized`` wrote, once all that reads it is stored itself."""
    for table in tables:
        place = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._shared_path)
        place.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of queries that are done. It does so when the driver collects garbage, which
    a driver with little to do puts off while the disks of the executors fill."""
    gc.collect()
    spark._jvm.System.gc()
