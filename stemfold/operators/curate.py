"""Curation of manifests: projections, filters, joins and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemfold.functions import scalars as S
from stemfold.sources.scratch import cut

#: A dimension of at most this many rows is broadcast after it has been counted.
BROADCAST_ROWS = 100_000


def small(dim: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``dim`` with a broadcast hint if it is found to have at most ``most`` rows, else as it is."""
    return F.broadcast(dim) if dim.limit(most + 1).count() <= most else dim


# --- projections and filters ------------------------------------------------


def clean_annotations(df: DataFrame, root: str, token: str) -> DataFrame:
    """Rename event annotations to their published names and strip the root from paths."""
    return df.select(
        S.tokenize_root(F.col("file"), root, token).alias("raw_path"), F.col("start_sample").alias("start_time_sample"), F.col("length_sample").alias("segment_duration_sample"),
        F.col("segment_start_sample").alias("segment_start_offset_sample"), F.col("lufs").alias("event_premaster_lufs"), F.col("submix_lufs").alias("track_premaster_lufs"),
    )


def select_subset(df: DataFrame, subset: str, full_source: str = "full/48k") -> DataFrame:
    """Rows of one subset. A missing subset is filled with ``subset`` for sources of ``full_source`` only; other rows without one are errors, which without_subset lists."""
    filled = F.coalesce("subset", F.when(F.col("source") == full_source, subset))
    return df.withColumn("subset", filled).where(F.col("subset") == subset)


def without_subset(df: DataFrame, full_source: str = "full/48k") -> DataFrame:
    """Rows that name no subset and whose source does not imply one."""
    return df.where(F.col("subset").isNull() & ~F.col("source").eqNullSafe(full_source))


SIZES = ("small", "medium", "large", "full")


def size_at_most(df: DataFrame, size: str, col: str = "size") -> DataFrame:
    """Sizes are cumulative: a larger one takes in all smaller ones."""
    return df.where(F.col(col).isin(*SIZES[: SIZES.index(size) + 1]))


def keep(df: DataFrame, col: str, values: list, exclude: list = ()) -> DataFrame:
    """Rows whose value is in ``values`` (all, if empty) and not in ``exclude``."""
    chosen = df.where(F.col(col).isin(*values)) if values else df
    return chosen.where(~F.col(col).isin(*exclude)) if exclude else chosen


def min_rate(df: DataFrame, least: int = 44_100, col: str = "sampling_rate") -> DataFrame:
    """Unreadable files have a rate of -1 or null and fail."""
    return df.where(F.col(col) >= least)


def min_bitrate(df: DataFrame, least: int = 64, col: str = "bit_rate") -> DataFrame:
    """At least ``least`` kb/s after rounding to whole kb/s."""
    return df.where(F.bround(F.col(col) / 1000) >= least)


def duration_gate(df: DataFrame, low: float, high: float, bypass: float, accepted: Column, col: str = "duration") -> DataFrame:
    """Rows in [low, high]. Those shorter than ``bypass`` pass without the classifier's ``accepted`` and are put back."""
    inside = df.where(F.col(col).between(low, high))
    return inside.where((F.col(col) >= bypass) & accepted).unionByName(inside.where(F.col(col) < bypass))


def class_filter(segments: DataFrame, cls: str, col: str = "class") -> DataFrame:
    return segments.where(F.col(col) == cls)


def drop_majority_active(frames: DataFrame, key: str, activations: list[str], threshold: float = 0.5) -> DataFrame:
    """(key, active): clips of which at most half the frames have any activation above the threshold."""
    active = F.greatest(*[F.col(a) for a in activations]) if len(activations) > 1 else F.col(activations[0])
    return frames.groupBy(key).agg(F.avg((active > threshold).cast("double")).alias("active")).where("active <= 0.5")


def drop_bleed(df: DataFrame) -> DataFrame:
    return df.where(~F.col("has_bleed"))


def flag_blocked(df: DataFrame, blocked: DataFrame, key: str) -> DataFrame:
    """Rows on the list move to the split ``<split>_blocked``."""
    hit = small(blocked.select(F.col(key).alias("b_key")).distinct())
    return df.join(hit, F.col(key) == F.col("b_key"), "left").withColumn("split", F.concat("split", F.when(F.col("b_key").isNotNull(), "_blocked").otherwise(""))).drop("b_key")


def drop_hidden(df: DataFrame, col: str) -> DataFrame:
    return df.where(~S.basename(F.col(col)).startswith("."))


def drop_failed(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(subset=list(cols))


# --- joins -------------------------------------------------------------------


def enrich(df: DataFrame, dim: DataFrame, key: str, how: str = "left", fill: dict | None = None) -> DataFrame:
    out = df.join(dim, key, how)
    return out.fillna(fill) if fill else out


def unmatched_keys(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """The keys that an enrichment would leave without a match; complete if empty."""
    return df.join(dim, key, "left_anti").select(key).distinct()


def resolve_license(df: DataFrame, urls: DataFrame, families: DataFrame, col: str = "license_url") -> DataFrame:
    """URL to licence and family to flags to usage class. Both lookups take ``https`` as ``http``. An unknown URL gives ``missing`` and nd; of several entries for a URL or a family the least counts."""
    url = F.regexp_replace(F.col(col), "^https://", "http://")
    u = small(urls.select(F.regexp_replace("url", "^https://", "http://").alias("l_url"), F.struct("license", "license_family").alias("l")).groupBy("l_url").agg(F.min("l").alias("l")).select("l_url", "l.*"))
    f = small(families.select(F.col("license_family").alias("l_family"), F.struct("attribution", "commercial", "derivative", "share_alike").alias("l")).groupBy("l_family").agg(F.min("l").alias("l")).select("l_family", "l.*"))
    out = df.join(u, url == F.col("l_url"), "left").join(f, F.col("license_family") == F.col("l_family"), "left").drop("l_url", "l_family")
    return out.fillna({"license": "missing", "license_family": "missing"}).withColumn("license_usage", S.usage_class(F.col("commercial"), F.col("derivative")))


def missing_outputs(inventory: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    return inventory.join(outputs, key, "left_anti")


def known_only(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys, key, "left_semi")


def with_precomputed(df: DataFrame, table: DataFrame) -> DataFrame:
    """Precomputed draws by (split, idx), never by position."""
    return df.join(table, ["split", "idx"], "left")


def sampling_probability(df: DataFrame, families: DataFrame, least_users: float = 1e6) -> DataFrame:
    """Language-balanced weights: each family's share follows its number of users (``least_users`` at least) and is split evenly over its files.

    ``families``: language_family, members (array of codes), users. A code
    without a family counts as one of its own with the least users, and so do
    all rows without a code together. Files are counted by an aggregate
    (n_files) that is written, counted and joined back: one row for each family or code. Few of
    them, as there are languages, are broadcast, and files are not shuffled; a column of dirty
    codes makes a plain join.
    """
    members = small(families.select("language_family", "users", F.explode("members").alias("langcode")).dropDuplicates(["langcode"]))
    tagged = df.join(members, "langcode", "left").withColumns({"language_family": F.coalesce("language_family", "langcode"), "sample_users": F.greatest(F.coalesce(F.col("users").cast("double"), F.lit(0.0)), F.lit(least_users))}).drop("users")
    files = tagged.groupBy("language_family", "sample_users").agg(F.count("*").alias("n_files"))
    total = files.agg(F.sum("sample_users").alias("all_users"))
    weights = files.crossJoin(F.broadcast(total)).select(F.col("language_family").alias("w_family"), "n_files", (F.col("sample_users") / F.col("n_files") / F.col("all_users")).alias("sample_prob"))
    return tagged.join(small(cut(weights, "weights")), F.col("language_family").eqNullSafe(F.col("w_family"))).drop("w_family")


def uniform_probability(df: DataFrame) -> DataFrame:
    return df.crossJoin(F.broadcast(df.agg((1 / F.count("*")).alias("sample_prob"))))


def assign_split(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    return df.join(table.select(key, "split"), key)


def correct_names(df: DataFrame, table: DataFrame, col: str) -> DataFrame:
    """Replace names by a map (wrong, right); others stay."""
    m = small(table.select("wrong", "right").dropDuplicates(["wrong"]))
    return df.join(m, F.col(col) == F.col("wrong"), "left").withColumn(col, F.coalesce("right", F.col(col))).drop("wrong", "right")


def clone_submix(plan: DataFrame, prior: DataFrame, submix: str) -> tuple[DataFrame, DataFrame]:
    """Annotations of a submix taken over from an earlier dataset, and the plan rows for which it has none."""
    key = ["subset", "split", "idx"]
    wanted, there = plan.select(*key).distinct(), prior.where(F.col("submix") == submix)
    return there.join(wanted, key), wanted.join(there, key, "left_anti")


def subset_or_default(df: DataFrame, subsets: DataFrame, key: list[str], value: str, default: str = "default") -> DataFrame:
    """For each key and subset the row of that subset, else the ``default`` one. ``subsets`` is a short list."""
    wide = df.select(*key).distinct().crossJoin(small(subsets.select("subset")))
    own = df.select(*key, "subset", F.col(value).alias("own"))
    base = df.where(F.col("subset") == default).select(*key, F.col(value).alias("base"))
    return wide.join(own, [*key, "subset"], "left").join(base, key, "left").select(*key, "subset", F.coalesce("own", "base").alias(value))


# --- sets ----------------------------------------------------------------------


def union_manifests(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def subset_names(*dfs: DataFrame) -> DataFrame:
    """Distinct subset names without ``default``; ``default`` alone if there are no others."""
    names = union_manifests(*[d.select("subset") for d in dfs]).where("subset IS NOT NULL AND subset <> 'default'").distinct()
    none = names.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("default").alias("subset"))
    return names.unionByName(none)


def unsupported(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct().join(dim.select(key), key, "left_anti")


# --- order -----------------------------------------------------------------------


def by_duration(df: DataFrame, col: str = "duration") -> DataFrame:
    return df.orderBy(F.desc(col))


def nearest(df: DataFrame, by: list[str], target: Column, value: str, key: str) -> DataFrame:
    """In each group the row whose value is nearest to the target, the smaller key on ties: an aggregate, not a sort."""
    return df.groupBy(*by).agg(F.min(F.struct(F.abs(F.col(value) - target).alias("gap"), F.col(key), F.col(value))).alias("m")).select(*by, f"m.{key}", f"m.{value}", "m.gap")


def seeded_shuffle(df: DataFrame, draw: Column, key: str) -> DataFrame:
    return df.orderBy(draw, key)


def pick(xs: Column, draw: Column) -> Column:
    """The element of a list that a uniform draw points to; null for an empty list."""
    return F.when(F.size(xs) > 0, F.get(xs, F.floor(draw * F.size(xs)).cast("int")))


def number_segments(df: DataFrame, key: str, order: list[str], name: str, width: int = 4) -> DataFrame:
    """Number the segments of a file from 0 and write the number into a padded name."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1
    return df.withColumn("segment", n).withColumn(name, F.concat(F.col(key).cast("string"), F.lit("_"), F.lpad(F.col("segment").cast("string"), width, "0")))
