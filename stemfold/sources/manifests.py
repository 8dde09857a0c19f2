"""Reading and writing manifests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from stemfold.sources.scratch import cut


def inventory(spark: SparkSession, folder: str, glob: str = "*", tags: dict[str, str] | None = None, recursive: bool = True) -> DataFrame:
    """(path, length) of the files under a folder, with source constants as columns. Contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(folder).select("path", "length")
    return files.withColumns({k: F.lit(v) for k, v in (tags or {}).items()})


DIALECTS = {
    "csv": {"sep": ",", "header": "true"},
    "semicolon": {"sep": ";", "header": "true"},
    "tab": {"sep": "\t", "header": "false"},
    "space": {"sep": " ", "header": "false"},
    "pipe": {"sep": "|", "header": "false"},
}


def _without_headers(lines: DataFrame, header_rows: int) -> DataFrame:
    """(value): the lines of text files without the first ``header_rows`` of each. A split of a file keeps its lines in order, and only the first one has the header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, seen = None, 0
        for b in batches:
            files, first = b.column(1).to_pylist(), b.column(2).to_pylist()
            keep = np.ones(b.num_rows, bool)
            for k, (name, start) in enumerate(zip(files, first, strict=True)):
                if (name, start) != file:
                    file, seen = (name, start), 0
                if start == 0 and seen < header_rows:
                    keep[k] = False
                seen += 1
            yield b.select([0]).filter(pa.array(keep))

    return lines.select("value", F.col("_metadata.file_path"), F.col("_metadata.file_block_start")).mapInArrow(run, "value string")


def read_manifest(spark: SparkSession, path: str, schema: str, dialect: str = "csv", header_rows: int = 0, missing_ok: bool = False) -> DataFrame | None:
    """A delimited file with a given schema. ``header_rows`` lines at the top of each file are dropped first, and blank lines with them.

    With ``missing_ok`` a path that is not there gives None, so that a source
    can be left out.
    """
    try:
        if not header_rows:
            return spark.read.schema(schema).options(**DIALECTS[dialect]).csv(path)
        rows = _without_headers(spark.read.text(path), header_rows).where(F.trim("value") != "")
        return rows.select(F.from_csv("value", schema, {"sep": DIALECTS[dialect]["sep"]}).alias("r")).select("r.*")
    except AnalysisException as e:
        if missing_ok and "PATH_NOT_FOUND" in str(e):
            return None
        raise


def explode_keyed_json(df: DataFrame, col: str, value_schema: str, key: str = "id") -> DataFrame:
    """A JSON object keyed by id becomes one row for each id."""
    parsed = df.select(F.explode(F.from_json(col, f"map<string, struct<{value_schema}>>")).alias(key, "v"))
    return parsed.select(key, "v.*")


def explode_stems(df: DataFrame, col: str = "stems") -> DataFrame:
    """Nested stems[].tracks[] become rows (stem, component, has_bleed); other columns stay."""
    rest = [c for c in df.columns if c != col]
    stems = df.select(*rest, F.explode(col).alias("s"))
    return stems.select(*rest, F.col("s.stemName").alias("stem"), F.explode("s.tracks").alias("t")).select(*rest, "stem", F.col("t.id").alias("component"), F.col("t.has_bleed").alias("has_bleed"))


def path_columns(df: DataFrame, path: str, names: list[str]) -> DataFrame:
    """The last parts of a path as columns, the last name being the last part; null where there are fewer parts."""
    parts = F.split(path, "/")
    return df.withColumns({n: F.when(F.size(parts) >= len(names) - i, F.get(parts, F.size(parts) - (len(names) - i))) for i, n in enumerate(names)})


def write_manifest(df: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """One folder for each subset and split.

    Rows are rebalanced on both first: small partitions share a task and a large one is
    split by size over several, so a folder has files of about the session's
    advisory partition size and not one for each task that holds some of it.
    """
    df.hint("rebalance", "subset", "split").write.mode(mode).partitionBy("subset", "split").parquet(folder)


def split_failed(df: DataFrame, col: str) -> DataFrame:
    """Rows without a result get the split ``<split>_failed``, so that one partitioned write parts them."""
    return df.withColumn("split", F.concat("split", F.when(F.col(col).isNull(), "_failed").otherwise("")))


def write_annotations(df: DataFrame, folder: str, composites: list[str]) -> None:
    """Annotations of stems; the mixture and composites carry none, and rows without a submix are of no stem."""
    write_manifest(df.where(~F.col("submix").isin("mixture", *composites)), folder)


def outputs(df: DataFrame, key: list[str], output_mixture: bool = True) -> DataFrame:
    """(key, submix): the signals that are put out, one for each submix of a mixture; the mixture itself only with ``output_mixture``."""
    names = df.where(F.col("submix").isNotNull()).select(*key, "submix").distinct()
    return names if output_mixture else names.where("submix <> 'mixture'")


def folder_bucket(path: str, buckets: int) -> Column:
    """Which of ``buckets`` a path belongs to, by its folder: files of one folder share it."""
    return F.pmod(F.xxhash64(F.regexp_replace(path, "/[^/]*$", "")), F.lit(buckets)).cast("int")


def stored(spark: SparkSession, target: str) -> DataFrame | None:
    """The rows of a Parquet table, None if there is none yet."""
    try:
        return spark.read.parquet(target)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def store_new(rows: DataFrame, target: str, key: str, buckets: int = 256) -> None:
    """Append the rows whose key is not in the table at ``target``; each key once, with the least of its rows.

    The table is partitioned by the bucket of the key's folder. Only buckets
    that the rows touch are read, and of them only the key; so what a small
    delivery reads depends on its folders and not on the table. A large bucket is written by several tasks,
    small ones share one. A table that exists without buckets is read whole and
    appended to as it is. Null keys are left out.
    """
    rest = [c for c in rows.columns if c != key]
    one = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("r")).select(key, "r.*") if rest else rows.where(F.col(key).isNotNull()).distinct()
    new = cut(one.withColumn("bucket", folder_bucket(key, buckets)), "new")
    old = stored(rows.sparkSession, target)
    if old is None or "bucket" in old.columns:
        if old is not None:
            touched = [r[0] for r in new.select("bucket").distinct().collect()]  # as many as buckets at most
            new = todo(new, old.where(F.col("bucket").isin(touched)).select(key), key)
        new.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(target)
    else:
        todo(new.drop("bucket"), old.select(key), key).write.mode("append").parquet(target)


def todo(everything: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What has no result yet."""
    return everything.join(done, key, "left_anti")
