"""Incremental ingest of manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stemfold.operators.curate import resolve_license
from stemfold.operators.expect import RowRule, failures
from stemfold.sources.manifests import store_new

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ingest(spark: SparkSession, source: str, schema: str, urls: DataFrame, families: DataFrame, target: str, checkpoint: str, remember: str = "1 hour", buckets: int = 256, path: str = "cleaned_path", rules: tuple[RowRule, ...] = ()) -> StreamingQuery:
    """Append new manifest files, with their licences resolved, to a Parquet table in which each path is stored once.

    Two guards keep repeats out. A manifest row that comes again within
    ``remember`` is dropped by the stream's state, which holds no more than the rows
    of that time and lies in RocksDB, not in the executors' heap. Whatever is left meets the target
    in an anti join that reads one column of those folder buckets that the
    batch touches, so paths stored long ago, or by another job, are not stored again. A replayed batch
    finds its own rows there and adds nothing.

    A path with several rows in a batch keeps the least of them, column by
    column; one that is in the target keeps its row. Time is that of the batch, so
    no row is ever too late. Rows without a path name no file and are left out.
    Failures of ``rules`` are counted on the way, over all rows that are read: the query's progress has
    them as observed metrics named ``violations``. The query stops when it has read what is there.
    """
    new = spark.readStream.schema(schema).option("header", "true").csv(source)
    columns = new.columns
    read = new.observe("violations", *failures(*rules)) if rules else new
    once = read.where(F.col(path).isNotNull()).withColumn("_seen", F.current_timestamp()).withWatermark("_seen", remember).dropDuplicatesWithinWatermark(columns)

    def store(batch: DataFrame, _id: int) -> None:
        store_new(resolve_license(batch.select(columns), urls, families), target, path, buckets)

    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, ROCKS)  # the query takes the setting that holds as it starts
    try:
        return once.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(store).start()
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
