"""A folder that driver and executors share, and lineage cuts in it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where that is unset, a local session (``local[n]``, as in tests) gets a
    temporary folder that goes with the process; on a cluster it is an error,
    since executors would write to disks of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not _own_dir:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        _own_dir.append(tempfile.mkdtemp(prefix="stemfold-"))
        atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
    return f"file://{_own_dir[0]}"


def _session_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stemfold/{spark.conf.get('spark.app.id', 'session')}"


def fresh(spark: SparkSession, tag: str) -> str:
    """A path of its own in this application's part of the shared folder."""
    return f"{_session_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that later jobs do not depend on earlier tasks."""
    spark = df.sparkSession
    path = fresh(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: list[str], buckets: int, tag: str) -> DataFrame:
    """``df`` written in buckets of ``key`` to the shared folder, and read as a table: joins and groupings on the key of tables with as many buckets need no shuffle."""
    spark = df.sparkSession
    name = f"{tag}_{uuid.uuid4().hex}"
    df.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key).format("parquet").option("path", fresh(spark, tag)).saveAsTable(name)
    return spark.table(name)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path that ``fresh`` gave. DataFrames that read it cannot be used afterwards."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def clear(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder. DataFrames that read it cannot be used afterwards."""
    remove(spark, _session_dir(spark))
