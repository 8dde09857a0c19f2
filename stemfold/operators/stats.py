"""Aggregates over manifests."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemfold.functions import scalars as S


def value_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def split_distribution(df: DataFrame, speaker: str, gender: str, variant: str) -> DataFrame:
    """Files and distinct speakers for each (split, gender, variant), for each split and over all.

    Speakers are first reduced to one row each, so the distinct count is a
    plain sum that aggregates before its shuffle.
    """
    per = df.groupBy("split", gender, variant, speaker).agg(F.count("*").alias("files"))
    return per.groupingSets([["split", gender, variant], ["split"], []], "split", gender, variant).agg(F.sum("files").alias("n_files"), F.count("*").alias("n_speakers")).select("split", gender, variant, "n_files", "n_speakers")


def hours(df: DataFrame, *by: str | Column, usable: Column | None = None, seconds: str = "duration") -> DataFrame:
    """Total hours by columns or derived keys and, in the same pass, those of usable files."""
    good = F.col(seconds) if usable is None else F.when(usable, F.col(seconds)).otherwise(0.0)
    return df.groupBy(*by).agg((F.sum(seconds) / 3600).alias("hours"), (F.sum(good) / 3600).alias("usable_hours"))


def speaker_durations(df: DataFrame, gender: str, speaker: str, seconds: str = "duration") -> DataFrame:
    return df.groupBy(gender, speaker).agg(F.sum(seconds).alias("duration"), F.count("*").alias("n_files")).orderBy(F.desc("duration"), gender, speaker)


def distinct_speakers(df: DataFrame, speaker: str, *by: str) -> DataFrame:
    return df.select(*by, speaker).distinct().groupBy(*by).agg(F.count(speaker).alias("n_speakers"))


ORDER = {"Y": 0, "N": 1, "?": 2}


def license_summary(df: DataFrame, family: str = "license_family") -> DataFrame:
    """Files of each family with their share in percent; commercial, then derivative, in the order Y, N, ?, then the family.

    ``place`` is the rank in that order. There are as many rows as families.
    """
    counts = df.groupBy(family).agg(F.count("*").alias("n"))
    state = S.tri_state(F.col(family))
    rank = lambda c: F.element_at(F.create_map(*[F.lit(x) for p in ORDER.items() for x in p]), c)
    out = counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total")))).select(family, state["commercial"].alias("commercial"), state["derivative"].alias("derivative"), "n", (100.0 * F.col("n") / F.col("total")).alias("percent"))
    return out.orderBy(rank(F.col("commercial")), rank(F.col("derivative")), family)


#: Values that a block of a group is meant to hold, and blocks at least and at most.
BLOCK_VALUES, LEAST_BLOCKS, MOST_BLOCKS = 250_000, 64, 4096


def quantiles(df: DataFrame, col: Column, by: list[str], shares: list[float], blocks: int | None = None) -> DataFrame:
    """(by, q0, q1, ...): exact interpolated quantiles of each group.

    No task holds a group, nor the copies of a value: approximate quantiles cut a group's values into ``blocks``
    (one for BLOCK_VALUES rows, within bounds), counts of the blocks say in which of them the wanted ranks are, and only
    those blocks become pairs of a value and how often it occurs, counted before the shuffle. Ranks are
    running sums over these pairs, so a value that most rows have is one row. Nulls and NaN do not count; a null key is a group.
    """
    names = [f"_{x}" for x in by]
    values = df.select(*by, col.cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    n_blocks = blocks or min(max(LEAST_BLOCKS, df.count() // BLOCK_VALUES), MOST_BLOCKS)
    cuts = values.groupBy(*by).agg(F.percentile_approx("v", F.array(*[F.lit((i + 1) / n_blocks) for i in range(n_blocks - 1)]), 16 * n_blocks).alias("_cuts")).toDF(*names, "_cuts")
    same = lambda xs, ys: reduce(and_, (F.col(x).eqNullSafe(F.col(y)) for x, y in zip(xs, ys, strict=True)), F.lit(True))
    ranged = values.join(cuts, same(by, names)).select(*by, "v", F.size(F.filter("_cuts", lambda x: x < F.col("v"))).alias("block"))
    w = Window.partitionBy(*by)  # as many rows as blocks
    sums = ranged.groupBy(*by, "block").agg(F.count("*").alias("c"))
    spans = sums.select(*by, "block", "c", (F.sum("c").over(w.orderBy("block")) - F.col("c")).alias("before"), F.sum("c").over(w).alias("n"))
    asked = F.array(*[F.struct(F.lit(k).alias("q"), (F.lit(p) * (F.col("n") - 1)).alias("at")) for k, p in enumerate(shares)])
    ranks = spans.select("*", F.explode(asked).alias("a")).where((F.ceil("a.at") >= F.col("before")) & (F.floor("a.at") < F.col("before") + F.col("c")))
    wanted = ranks.groupBy(*by, "block").agg(F.first("before").alias("before"), F.collect_list("a").alias("asked")).toDF(*names, "_block", "before", "asked")
    pairs = value_pairs(ranged, by).join(wanted, same([*by, "block"], [*names, "_block"]))
    run = F.sum("c").over(Window.partitionBy(*by, "block").orderBy("v"))
    placed = pairs.select(*by, "v", "asked", (F.col("before") + run - F.col("c")).alias("from"), (F.col("before") + run - 1).alias("to"))
    covers = lambda at: (at >= F.col("from")) & (at <= F.col("to"))
    low, high = F.floor("a.at"), F.ceil("a.at")
    hits = placed.select(*by, "v", "from", "to", F.explode("asked").alias("a")).where(covers(low) | covers(high))
    part = F.col("a.at") - low
    weight = F.when(covers(low), 1 - part).otherwise(0.0) + F.when(covers(high), part).otherwise(0.0)
    return hits.groupBy(*by).agg(*(F.sum(F.when(F.col("a.q") == k, F.col("v") * weight)).alias(f"q{k}") for k in range(len(shares))))


def value_pairs(ranged: DataFrame, by: list[str]) -> DataFrame:
    """(by, block, v, c): each value of a block once, with how often it occurs."""
    return ranged.groupBy(*by, "block", "v").agg(F.count("*").alias("c"))


def describe(df: DataFrame, col: Column, *by: str) -> DataFrame:
    """Count, mean, sample deviation, least, interpolated quartiles and greatest."""
    out = df.groupBy(*by).agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"), F.min(col).alias("min"), F.max(col).alias("max"))
    q = quantiles(df, col, list(by), [0.25, 0.5, 0.75]).toDF(*(f"_{x}" for x in by), "q25", "q50", "q75")
    on = reduce(and_, (F.col(x).eqNullSafe(F.col(f"_{x}")) for x in by), F.lit(True))
    return out.join(q, on, "left").select(*by, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def failure_rate(df: DataFrame, col: str, *by: str) -> DataFrame:
    """Share of rows without a result."""
    return df.groupBy(*by).agg(F.avg(F.col(col).isNull().cast("double")).alias("failure_rate"), F.count("*").alias("n"))


def rounded_histogram(df: DataFrame, col: str, step: int = 1000) -> DataFrame:
    """Counts of values rounded, half to even, to a multiple of ``step``."""
    return df.groupBy((F.bround(F.col(col) / step) * step).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def stem_tree(df: DataFrame, file: str, group: str, stem: str, path: str) -> DataFrame:
    """One row for each file: stem group to stem to sorted paths, as nested maps. A file's components are few."""
    stems = df.groupBy(file, group, stem).agg(F.array_sort(F.collect_list(path)).alias("paths"))
    groups = stems.groupBy(file, group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(stem, "paths")))).alias("stems"))
    return groups.groupBy(file).agg(F.map_from_entries(F.collect_list(F.struct(group, "stems"))).alias("tree"))


def flat_tree(tree: DataFrame, file: str) -> DataFrame:
    """The rows of a stem tree again: file, stem group, stem, paths joined by commas."""
    groups = tree.select(file, F.explode("tree").alias("stem_group", "stems"))
    return groups.select(file, "stem_group", F.explode("stems").alias("stem", "paths")).withColumn("paths", F.array_join("paths", ","))


def substems(df: DataFrame, group: str, stem: str) -> DataFrame:
    return df.groupBy(group).agg(F.array_sort(F.collect_set(stem)).alias("substems"))


def present_stems(stems: Column, combination: list[str]) -> Column:
    """The members of a combination that a file has, in the combination's order."""
    return F.array_intersect(F.array(*[F.lit(c) for c in combination]), stems)


def gender_ratio(df: DataFrame, gender: str, seconds: str, *by: str) -> DataFrame:
    """Female share of duration, for each group and over all (null group)."""
    share = F.sum(F.when(F.col(gender) == "female", F.col(seconds)).otherwise(0.0)) / F.sum(seconds)
    return df.groupingSets([list(by), []], *by).agg(share.alias("female_ratio"), F.sum(seconds).alias("duration"))


def combine_licenses(df: DataFrame, key: str) -> DataFrame:
    """Several licences of one item: attribution and share-alike if any asks for it, commercial and derivative if all allow it; an unclear flag is the strict one."""
    yes, no = F.lit(True), F.lit(False)
    out = df.groupBy(key).agg(
        F.bool_or(F.coalesce("attribution", yes)).alias("attribution"), F.bool_and(F.coalesce("commercial", no)).alias("commercial"),
        F.bool_and(F.coalesce("derivative", no)).alias("derivative"), F.bool_or(F.coalesce("share_alike", yes)).alias("share_alike"), F.count("*").alias("n_licenses"),
    )
    return out.withColumn("license_usage", S.usage_class(F.col("commercial"), F.col("derivative")))


def long_parameters(df: DataFrame, ids: list[str], values: list[str]) -> DataFrame:
    return df.unpivot(ids, values, "parameter", "value")
