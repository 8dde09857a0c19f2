"""Segmented scans: runs, silence and ladders for keys of any length, by blocks that are reduced alone and stitched at their edges."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemfold.operators.segments import mean_level, near_mean
from stemfold.sources.scratch import cut

#: Rows that a block is meant to hold.
BLOCK_ROWS = 1_000_000


def _same(keys: list[str], others: list[str]) -> Column:
    return reduce(and_, (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(keys, others, strict=True)), F.lit(True))


def in_blocks(rows: DataFrame, keys: list[str], pos: str, blocks: int | None = None) -> DataFrame:
    """``rows`` with ``_block``: ranges of (keys, pos) of about even size, whatever share of the rows a key holds.

    The blocks are written, so that later jobs see the same ones.
    """
    n = blocks or max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // BLOCK_ROWS))
    return cut(rows.repartitionByRange(n, *keys, pos).withColumn("_block", F.spark_partition_id()), "blocks")


def scan_runs(rows: DataFrame, keys: list[str], pos: str, cls: str, low: str | None = None, high: str | None = None, blocks: int | None = None) -> DataFrame:
    """(keys, class, first, last, n) of runs of rows with equal ``cls``, in order of ``pos`` within their key.

    ``first`` and ``last`` are the places of a run's first and last row in its
    key, from 0, or the least ``low`` and the greatest ``high`` of its rows;
    n is the number of rows of its key.

    A block finds the runs among its own rows of a key and says how many rows and runs
    there are and which classes stand at its edges. Over these summaries, one row
    for a key and block, running sums give each block the rows and runs before it; a
    block whose first class is the last one before goes on with that run. So no
    task holds more than a block of a key, and a run may reach over any number of blocks.
    """
    held = in_blocks(rows.select(*keys, F.col(pos).alias("_pos"), F.col(cls).alias("class"), *([F.col(low).alias("_low"), F.col(high).alias("_high")] if low else [])), keys, "_pos", blocks)
    order = Window.partitionBy(*keys, "_block").orderBy("_pos")
    index = F.row_number().over(order) - 1
    new = F.when((index == 0) | ~F.col("class").eqNullSafe(F.lag("class").over(order)), 1).otherwise(0)
    marked = held.select("*", index.alias("_i"), new.alias("_new")).withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    ends = (F.min("_low"), F.max("_high")) if low else (F.min("_i"), F.max("_i"))
    own = cut(marked.groupBy(*keys, "_block", "_run").agg(F.first("class").alias("class"), ends[0].alias("_a"), ends[1].alias("_b"), F.count("*").alias("_rows")), "runs")

    edges = own.groupBy(*keys, "_block").agg(F.sum("_rows").alias("_rows"), F.count("*").alias("_runs"), F.min_by("class", "_run").alias("_head"), F.max_by("class", "_run").alias("_tail"))
    along = Window.partitionBy(*keys).orderBy("_block")  # a row for each block of a key
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.col("_head").eqNullSafe(F.lag("_tail").over(along)) & F.lag("_block").over(along).isNotNull()
    known = edges.select("*", F.when(goes_on, 1).otherwise(0).alias("_on"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"), F.sum("_rows").over(Window.partitionBy(*keys)).alias("_n"))
    numbered = known.withColumn("_first_run", F.coalesce(F.sum(F.col("_runs") - F.col("_on")).over(before), F.lit(0)) - F.col("_on"))
    names = [f"_k{k}" for k in range(len(keys))]
    summary = numbered.select(*(F.col(c).alias(n) for c, n in zip(keys, names, strict=True)), F.col("_block").alias("_at"), "_first_run", "_rows_before", "_n")

    placed = own.join(summary, _same(keys, names) & (F.col("_block") == F.col("_at")))
    shift = F.lit(0) if low else F.col("_rows_before")
    whole = placed.groupBy(*keys, (F.col("_run") + F.col("_first_run")).alias("_run"))
    return whole.agg(F.first("class").alias("class"), F.min(F.col("_a") + shift).alias("first"), F.max(F.col("_b") + shift).alias("last"), F.first("_n").alias("n")).drop("_run")


def run_length_scan(frames: DataFrame, key: str | list[str], pos: str, cls: str, frame: float = 1.0, blocks: int | None = None) -> DataFrame:
    """As ``segments.run_length``, for keys whose frames no task could hold."""
    keys = [key] if isinstance(key, str) else key
    return scan_runs(frames, keys, pos, cls, blocks=blocks).select(*keys, "class", (F.col("first") * frame).alias("start_time"), ((F.col("last") + 1) * frame).alias("end_time"))


def _nonsilent(frames: DataFrame, key: str, pos: str, level: str, frame: float, drops: list[float], least_silence: float, pad: float, blocks: int | None) -> DataFrame:
    means = frames.groupBy(key).agg(*(c.alias(n) for n, c in mean_level(level).items())).withColumnRenamed(key, "_key")
    steps = F.explode(F.array(*[F.struct(F.lit(k).alias("step"), F.lit(float(d)).alias("drop")) for k, d in enumerate(drops)])).alias("s")
    flagged = frames.join(means, F.col(key).eqNullSafe(F.col("_key"))).select(key, pos, level, *mean_level(level), steps).select(key, pos, F.col("s.step").alias("step"), near_mean(F.col(level), F.col("s.drop")).alias("loud"))
    keys = [key, "step"]
    runs = cut(scan_runs(flagged, keys, pos, "loud", blocks=blocks).withColumnsRenamed({"class": "loud"}).select(*keys, "loud", (F.col("first") * frame).alias("a"), ((F.col("last") + 1) * frame).alias("b"), (F.col("n") * frame).alias("total")), "silence")
    ends = runs.groupBy(*keys).agg(F.min(F.when(F.col("loud"), F.col("a"))).alias("_lo"), F.max(F.when(F.col("loud"), F.col("b"))).alias("_hi"), F.max("total").alias("_total")).withColumnsRenamed({key: "_key", "step": "_step"})
    # runs that are heard side by side are one isle
    heard = runs.withColumn("heard", F.col("loud") | (F.col("b") - F.col("a") < least_silence))
    isles = scan_runs(heard, keys, "a", "heard", "a", "b", blocks).where("class")
    inner = isles.join(ends, _same(keys, ["_key", "_step"])).select(*keys, "_total", F.greatest("first", "_lo").alias("a"), F.least("last", "_hi").alias("b")).where("_lo IS NOT NULL AND a < b")
    return inner.select(*keys, F.greatest(F.lit(0.0), F.col("a") - pad).alias("start_time"), F.least("_total", F.col("b") + pad).alias("end_time"))


def nonsilent_scan(frames: DataFrame, key: str, pos: str, level: str, frame: float, drop: float = 16.0, least_silence: float = 1.0, pad: float = 0.1, blocks: int | None = None) -> DataFrame:
    """As ``segments.nonsilent``, by two segmented scans: one over frames, one over the runs that it finds."""
    return _nonsilent(frames, key, pos, level, frame, [drop], least_silence, pad, blocks).drop("step")


def ladder_split_scan(frames: DataFrame, key: str, pos: str, level: str, frame: float, longest: float, drops: list[float], least_silence: float = 1.0, pad: float = 0.1, blocks: int | None = None) -> DataFrame:
    """As ``segments.ladder_split``, by segmented scans; the threshold of a key is chosen from one row for each step."""
    pieces = cut(_nonsilent(frames, key, pos, level, frame, drops, least_silence, pad, blocks), "ladder")
    worst = pieces.groupBy(key, "step").agg(F.max(F.col("end_time") - F.col("start_time")).alias("worst"))
    chosen = worst.groupBy(key).agg(F.coalesce(F.min(F.when(F.col("worst") <= longest, F.col("step"))), F.max("step")).alias("_step")).withColumnRenamed(key, "_key")
    return pieces.join(chosen, F.col(key).eqNullSafe(F.col("_key")) & (F.col("step") == F.col("_step"))).select(key, "step", "start_time", "end_time")
