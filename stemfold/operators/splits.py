"""Train, validation and test splits."""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemfold.functions.draws import u
from stemfold.operators.curate import small


def _ceil_share(n: Column, percent: Column | int) -> Column:
    return F.floor((n * percent + 99) / 100)


def _ranked(groups: DataFrame, strata: list[str], group: str, seed: int, blocks: int | None = None) -> DataFrame:
    """``groups`` with the rank of each group's draw within its stratum, and the number n of groups in it.

    Ranks come from two levels, so that no task holds a stratum: the draw
    cuts it into blocks of even width (as many as shuffle partitions), each
    ranked alone, and each block starts at the number of groups before it.
    """
    n = blocks or max(64, int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    drawn = groups.withColumn("draw", u(seed, "split", F.col(group))).withColumn("block", F.floor(F.col("draw") * n).cast("int"))
    w = Window.partitionBy(*strata)  # as many rows as blocks
    sums = drawn.groupBy(*strata, "block").agg(F.count("*").alias("c"))
    before = sums.select(*(F.col(x).alias(f"_{x}") for x in strata), F.col("block").alias("_block"), (F.sum("c").over(w.orderBy("block")) - F.col("c")).alias("before"), F.sum("c").over(w).alias("n"))
    on = F.col("block") == F.col("_block")
    for x in strata:
        on = F.col(x).eqNullSafe(F.col(f"_{x}")) & on
    placed = drawn.withColumn("place", F.row_number().over(Window.partitionBy(*strata, "block").orderBy("draw", group)))
    return placed.join(before, on).withColumn("rank", F.col("before") + F.col("place")).drop("draw", "block", "_block", "before", "place", *(f"_{x}" for x in strata))


def group_split(df: DataFrame, group: str, strata: list[str], seed: int, hold: int = 30, test_of_hold: tuple[int, int] = (2, 3), forced: Column | None = None, singletons_to_test: bool = False) -> DataFrame:
    """(group, split): whole groups go to train, val or test, stratified; 70/10/20 as given.

    Groups are ranked by a keyed draw within their stratum. Of n groups,
    ceil(hold % of n) are held out and ceil(2/3) of those are test. Groups for
    which ``forced`` holds are test and count towards nothing. With
    ``singletons_to_test``, groups alone in their stratum are test too, and
    the share held out of the others falls by as many. A null stratum is one
    like any other.
    """
    flag = F.lit(False) if forced is None else forced
    groups = df.groupBy(group, *strata).agg(F.bool_or(flag).alias("forced"))
    rest = _ranked(groups.where("NOT forced"), strata, group, seed)
    percent: Column = F.lit(hold)
    alone = F.lit(False)
    if singletons_to_test:
        alone = F.col("n") == 1
        totals = groups.where("NOT forced").groupBy(*strata).agg(F.count("*").alias("k")).agg(F.sum("k").alias("all_n"), F.sum(F.when(F.col("k") == 1, 1).otherwise(0)).alias("all_single"))
        rest = rest.crossJoin(F.broadcast(totals))
        left = F.col("all_n") - F.col("all_single")
        percent = F.when(left > 0, F.greatest(F.lit(0), F.floor((F.col("all_n") * hold - F.col("all_single") * 100) / left))).otherwise(0)
    held = _ceil_share(F.col("n"), percent)
    a, b = test_of_hold
    test = F.floor((held * a + b - 1) / b)
    split = F.when(alone, "test").when(F.col("rank") <= test, "test").when(F.col("rank") <= held, "val").otherwise("train")
    return rest.select(group, split.alias("split")).unionByName(groups.where("forced").select(group, F.lit("test").alias("split")))


def threshold_split(df: DataFrame, group: str, seed: int, hold: int = 30, test_of_hold: tuple[int, int] = (2, 3)) -> DataFrame:
    """Whole groups by rank of their draw, without strata: (group, split)."""
    return group_split(df, group, [], seed, hold, test_of_hold)


def merged_split(df: DataFrame, group: str, stratum: str, merged: DataFrame, seed: int, val: int = 10) -> DataFrame:
    """Split the groups that are not in test already into train and val by merged strata; the original test stays.

    ``merged``: (stratum, merged), for sparse strata; others stay as they are.
    """
    groups = df.groupBy(group, stratum).agg(F.bool_or(F.col("split") == "test").alias("is_test"))
    named = groups.join(small(merged.select(F.col("stratum").alias(stratum), "merged")), stratum, "left").withColumn("merged", F.coalesce("merged", stratum))
    ranked = _ranked(named.where("NOT is_test"), ["merged"], group, seed)
    return ranked.select(group, F.when(F.col("rank") <= _ceil_share(F.col("n"), val), "val").otherwise("train").alias("split")).unionByName(named.where("is_test").select(group, F.lit("test").alias("split")))


def row_split(df: DataFrame, key: str, seed: int, val: float) -> DataFrame:
    """Rows of train move to val by a keyed threshold; test stays. No shuffle."""
    moved = (F.col("split") == "train") & (u(seed, "row", F.col(key)) < val)
    return df.withColumn("split", F.when(moved, "val").otherwise(F.col("split")))


def fixed_split(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Splits from a table (key, split); where a key is listed more than once, val goes before test before train."""
    rank = F.when(F.col("split") == "val", 0).when(F.col("split") == "test", 1).otherwise(2)
    one = table.groupBy(key).agg(F.min_by("split", rank).alias("split"))
    return df.join(one, key)


class _Free:
    """Places of a sorted list that are still free, with the nearest free place at or after and before any place.

    Taken places point on to their neighbours, and each search shortens the
    paths it walks (disjoint sets), so a search costs next to nothing however many are taken.
    """

    def __init__(self, n: int) -> None:
        # place k of the list is node k + 1; nodes 0 and n + 1 end it
        self.up, self.down = list(range(n + 2)), list(range(n + 2))

    @staticmethod
    def _find(to: list[int], k: int) -> int:
        root = k
        while to[root] != root:
            root = to[root]
        while to[k] != root:
            to[k], k = root, to[k]
        return root

    def at_or_after(self, k: int) -> int:
        """The length of the list if there is none."""
        return self._find(self.up, k + 1) - 1

    def before(self, k: int) -> int:
        """-1 if there is none."""
        return self._find(self.down, k) - 1

    def take(self, k: int) -> None:
        self.up[k + 1], self.down[k + 1] = k + 2, k


def assign_nearest(durations: list[float], need: dict[str, float]) -> list[str]:
    """A split for each duration: again and again the split that lacks most (of equal ones the last by name) takes the duration nearest to what it needs, the first of equally near ones."""
    order = sorted((d, k) for k, d in enumerate(durations))
    values = [d for d, _ in order]
    free, need, out = _Free(len(order)), dict(need), [""] * len(order)
    for _ in order:
        name = max(need, key=lambda s: (need[s], s))
        at = bisect_left(values, need[name])
        near = [j for j in (free.at_or_after(at), free.before(at)) if 0 <= j < len(order)]
        # of equal durations the first drawn
        near = [free.at_or_after(bisect_left(values, values[j])) for j in near]
        j = min(near, key=lambda j: (abs(values[j] - need[name]), order[j][1]))
        d, k = order[j]
        free.take(j)
        out[k] = name
        need[name] -= d
    return out


def _tries(speakers: DataFrame, seeds: int) -> DataFrame:
    return speakers.select("corpus", "speaker", "gender", "duration").withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))))


def _best(tried: DataFrame) -> DataFrame:
    """Of the tries of a corpus the least accepted seed, else the one that strays least, to nine digits, of equal ones the least."""
    order = F.struct((~F.col("accepted")).alias("no"), F.when(F.col("accepted"), 0.0).otherwise(F.round("stray", 9)).alias("stray"), "seed")
    return tried.groupBy("corpus").agg(F.min(order).alias("best")).select("corpus", F.col("best.seed").alias("seed"))


def balanced_split(speakers: DataFrame, proportions: dict[str, float], tolerance: float, seeds: int) -> DataFrame:
    """(corpus, speaker, split, seed, accepted): duration- and gender-balanced whole-speaker splits.

    ``speakers``: corpus, speaker, gender, duration, one row for each speaker.
    For each candidate seed, speakers in a drawn order of splits: the split
    that lacks most takes the speaker whose duration is nearest to what it
    needs. A seed is accepted when each split's female ratio is within
    ``tolerance`` of the corpus's; the least accepted seed wins, else the one
    that strays least. Seeds are tried as parallel groups; a group is the
    list of one corpus's speakers with their durations, and takes time in
    proportion to a sort of it. For corpora that fit no task there is ``balanced_split_binned``.
    """
    tries = _tries(speakers, seeds).withColumn("draw", u(0, "balance", F.col("seed"), F.col("speaker")))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["draw", "speaker"]).reset_index(drop=True)
        total = pdf["duration"].sum()
        pdf["split"] = assign_nearest(pdf["duration"].tolist(), {s: p * total for s, p in proportions.items()})
        female = pdf["duration"].where(pdf["gender"] == "female", 0.0)
        ratio = (female.groupby(pdf["split"]).sum() / pdf.groupby("split")["duration"].sum()).reindex(list(proportions))
        stray = (ratio - female.sum() / total).abs().max()
        pdf["stray"] = float("inf") if pd.isna(stray) else float(stray)
        pdf["accepted"] = pdf["stray"] <= tolerance
        return pdf[["corpus", "speaker", "split", "seed", "stray", "accepted"]]

    tried = tries.groupBy("corpus", "seed").applyInPandas(one, "corpus string, speaker string, split string, seed int, stray double, accepted boolean")
    return tried.join(_best(tried), ["corpus", "seed"]).select("corpus", "speaker", "split", "seed", "accepted")


def shares_of_bins(sizes: list[int], means: list[float], proportions: dict[str, float]) -> list[list[int]]:
    """How many speakers of each bin every split takes, bins of long durations first.

    Each split's share of a bin is in proportion to the duration that it still
    needs; whole numbers come by largest remainder, of equal ones to the last by name.
    """
    total = sum(n * d for n, d in zip(sizes, means, strict=True))
    need = {s: p * total for s, p in proportions.items()}
    out = []
    for n, d in zip(sizes, means, strict=True):
        lack = {s: max(x, 0.0) for s, x in need.items()}
        whole = sum(lack.values())
        quota = {s: n * (lack[s] / whole if whole > 0 else p / sum(proportions.values())) for s, p in proportions.items()}
        got = {s: int(q) for s, q in quota.items()}
        for s in sorted(quota, key=lambda s: (quota[s] - got[s], s), reverse=True)[: n - sum(got.values())]:
            got[s] += 1
        for s in need:
            need[s] -= got[s] * d
        out.append([got[s] for s in proportions])
    return out


def balanced_split_binned(speakers: DataFrame, proportions: dict[str, float], tolerance: float, seeds: int, per_octave: int = 8) -> DataFrame:
    """(corpus, speaker, split, seed, accepted): balanced whole-speaker splits of corpora of any size.

    Speakers fall into bins of gender and of the logarithm of their duration,
    ``per_octave`` to a doubling; Spark counts and sums them. A corpus has some
    hundreds of bins however many speakers it has, and only these are in one group: there each split's share of
    every bin is found, the longest durations first, so that shorter ones make up for what
    rounding leaves. Within a bin speakers go to splits by the rank of their draw, in two levels, so that no
    task holds a bin. Genders are shared out alike, and the ratios are then measured as for
    ``balanced_split``: an aggregate over all speakers decides which seed is accepted.
    A null gender is one like any other; durations of 0 or below share a bin.
    """
    splits = list(proportions)
    width = F.when(F.col("duration") > 0, F.floor(F.log2("duration") * per_octave)).otherwise(-(1 << 20)).cast("int")
    rows = _tries(speakers, seeds).withColumns({"bin": width, "sex": F.coalesce("gender", F.lit("")), "who": F.concat_ws("|", F.col("seed").cast("string"), "speaker")})
    bins = rows.where("seed = 0").groupBy("corpus", "sex", "bin").agg(F.count("*").alias("size"), F.avg("duration").alias("mean"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin", ascending=False)
        pdf["upto"] = [[sum(x[: k + 1]) for k in range(len(x))] for x in shares_of_bins(pdf["size"].tolist(), pdf["mean"].tolist(), proportions)]
        return pdf[["corpus", "sex", "bin", "upto"]]

    shares = bins.groupBy("corpus", "sex").applyInPandas(one, "corpus string, sex string, bin int, upto array<bigint>")
    ranked = _ranked(rows, ["corpus", "sex", "bin", "seed"], "who", 0)
    place = F.size(F.filter("upto", lambda x: x < F.col("rank")))  # how many splits end before this rank
    dealt = ranked.join(shares, ["corpus", "sex", "bin"]).select("corpus", "seed", "speaker", "gender", "duration", F.element_at(F.array(*map(F.lit, splits)), place + 1).alias("split"))
    female = F.sum(F.when(F.col("gender") == "female", F.col("duration")).otherwise(0.0))
    own = dealt.groupBy("corpus", "seed", "split").agg(female.alias("f"), F.sum("duration").alias("d"))
    whole = own.groupBy("corpus", "seed").agg((F.sum("f") / F.sum("d")).alias("ratio"))
    strays = own.join(whole, ["corpus", "seed"]).groupBy("corpus", "seed").agg(F.max(F.abs(F.try_divide("f", "d") - F.col("ratio"))).alias("stray"))
    judged = strays.select("corpus", "seed", F.coalesce("stray", F.lit(float("inf"))).alias("stray")).withColumn("accepted", F.col("stray") <= tolerance)
    chosen = judged.join(_best(judged), ["corpus", "seed"]).select("corpus", "seed", "accepted")
    return dealt.join(chosen, ["corpus", "seed"]).select("corpus", "speaker", "split", "seed", "accepted")
