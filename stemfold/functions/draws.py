"""Keyed draws: uniforms that depend on a seed, a tag and a key only, and the distributions made from them.

``u`` is the first 13 hexadecimal digits of an MD5 over 16**13, so results do
not depend on partitioning, order or retries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: 16**13.
SPAN = float(16**13)
TINY = 1e-12

#: Coefficients of Acklam's rational approximation of the normal quantile.
A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0)
C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)
LOW = 0.02425
#: The Zelen-Severo polynomial of the normal distribution function.
P = 0.2316419
BS = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
ROOT_2PI = 2.5066282746310002


def u(seed: int, tag: str, *key: Column) -> Column:
    """Uniform in [0, 1) for a key."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(tag), *[k.cast("string") for k in key])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / SPAN


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _poly(coefficients: tuple[float, ...], x: Column) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + c
    return out


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function; p is clamped to [1e-12, 1 - 1e-12]."""
    tail = lambda q: _poly(C, q) / _poly(D, q)
    mid = lambda m: let(m * m, lambda r: _poly(A, r) * m / _poly(B, r))
    body = lambda p: F.when(p < LOW, let(F.sqrt(-2 * F.ln(p)), tail)).when(p > 1 - LOW, -let(F.sqrt(-2 * F.ln(1 - p)), tail)).otherwise(let(p - 0.5, mid))
    return let(F.greatest(F.lit(TINY), F.least(F.lit(1 - TINY), p)), body)


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution function by a polynomial good to about 1e-7."""

    def body(x: Column) -> Column:
        tail = lambda t: F.exp(-x * x / 2) / ROOT_2PI * (_poly(tuple(reversed(BS)), t) * t)
        return let(let(1 / (1 + P * F.abs(x)), tail), lambda v: F.when(x >= 0, 1 - v).otherwise(v))

    return let(x, body)


def normal(p: Column, loc: Column | float, scale: Column | float) -> Column:
    return normal_quantile(p) * scale + loc


def uniform(p: Column, loc: Column | float, scale: Column | float) -> Column:
    """Uniform on loc plus or minus scale."""
    return (2 * p - 1) * scale + loc


def skew_start(p0: Column, p1: Column, loc: Column, scale: float = 2.0, shape: float = 5.0) -> Column:
    """Skew-normal draw from two uniforms, not below 0."""
    delta = shape / (1 + shape * shape) ** 0.5
    return F.greatest(F.lit(0.0), loc + scale * (delta * F.abs(normal_quantile(p0)) + (1 - delta * delta) ** 0.5 * normal_quantile(p1)))


def trunc_length(p: Column, loc: Column, scale: Column, low: Column, high: Column) -> Column:
    """Normal truncated to [low, high]; high where high is not above low."""
    edges = F.struct(normal_cdf((low - loc) / scale).alias("a"), normal_cdf((high - loc) / scale).alias("b"))
    drawn = let(edges, lambda e: loc + scale * normal_quantile(e["a"] + p * (e["b"] - e["a"])))
    return F.when(high <= low, high).otherwise(F.greatest(low, F.least(high, drawn)))


def segment_offset(p: Column, available: Column, length: Column) -> Column:
    """A whole start in [0, available - length); 0 if nothing is left over."""
    return F.when(available > length, F.floor(p * (available - length))).otherwise(F.lit(0)).cast("long")


#: Parts of [0, 1) under which a distribution's steps are listed.
PARTS = 1024


def poisson_steps(means: DataFrame, mu: str, low: int, high: int | None) -> DataFrame:
    """(mu, k, lo, hi): the share of [0, 1) that each count has in the Poisson distribution of each mean, truncated to [low, high].

    No table end: for each mean the counts go from ten deviations and 40 below its likeliest
    count in [low, high] to as many above, beyond which less than 1e-20 is left.
    Probabilities are products of ratios of neighbours from that count on, so
    no factorial is formed and a truncation far out in a tail is as exact as one
    at the centre. A window holds the counts of one mean, some 20 roots of it.
    """
    top = F.lit(float("inf")) if high is None else F.lit(float(high))
    likely = F.least(F.greatest(F.floor(mu).cast("double"), F.lit(float(low))), top)
    reach = F.ceil(10 * F.sqrt(F.greatest(F.col(mu), F.col("likely"))) + 40)
    rows = means.select(mu).where(F.col(mu) > 0).distinct().withColumn("likely", likely).withColumn("reach", reach)
    first, last = F.greatest(F.col("likely") - F.col("reach"), F.lit(float(low))), F.least(F.col("likely") + F.col("reach"), top)
    each = rows.select(mu, "likely", F.explode(F.sequence(first.cast("long"), last.cast("long"))).alias("k"))
    up, down = Window.partitionBy(mu).orderBy("k"), Window.partitionBy(mu).orderBy(F.desc("k"))
    log_p = F.sum(F.when(F.col("k") > F.col("likely"), F.ln(F.col(mu) / F.col("k"))).otherwise(0.0)).over(up) + F.sum(F.when(F.col("k") < F.col("likely"), F.ln((F.col("k") + 1) / F.col(mu))).otherwise(0.0)).over(down)
    weighed = each.select(mu, "k", F.exp(log_p).alias("w"))
    whole = Window.partitionBy(mu)
    shares = weighed.select(mu, "k", F.sum("w").over(up).alias("run"), "w", F.sum("w").over(whole).alias("all"), F.max("k").over(whole).alias("last"))
    return shares.select(mu, "k", ((F.col("run") - F.col("w")) / F.col("all")).alias("lo"), F.when(F.col("k") == F.col("last"), 1.0).otherwise(F.col("run") / F.col("all")).alias("hi"))


def truncated_poisson(df: DataFrame, mu: str, p: str, low: int, high: int | None, out: str) -> DataFrame:
    """Add ``out``: a Poisson count with mean ``mu`` truncated to [low, high], by inverting its distribution at ``p``.

    Steps are listed under each of the PARTS of [0, 1) that they touch, and a
    draw meets those of its mean and part in an equi-join: a few rows for
    each draw, whatever the mean. ``low = 1`` and no ``high`` is the
    zero-truncated case. A mean of 0 or below gives ``low``, a null mean or draw null.
    """
    part = F.explode(F.sequence(F.floor(F.col("lo") * PARTS), F.least(F.floor(F.col("hi") * PARTS), F.lit(PARTS - 1)))).alias("_part")
    steps = poisson_steps(df, mu, low, high).select(F.col(mu).alias("_mu"), F.col("k").alias("_k"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), part)
    asked = df.withColumn("_at", F.floor(F.col(p) * PARTS))
    on = (F.col(mu) == F.col("_mu")) & (F.col("_at") == F.col("_part")) & (F.col(p) >= F.col("_lo")) & (F.col(p) < F.col("_hi"))
    drawn = asked.join(steps, on, "left")
    return drawn.withColumn(out, F.when(F.col(mu) > 0, F.col("_k")).when(F.col(mu) <= 0, F.lit(low)).cast("int")).drop("_mu", "_k", "_lo", "_hi", "_part", "_at")


def level_hierarchy(df: DataFrame, seed: int, levels: list[tuple[str, list[str], float, float | None]]) -> DataFrame:
    """Add one column for each level (name, key columns, spread, mean or None for the level above): normal draws, each around the one before."""
    above: Column = F.lit(0.0)
    for name, key, spread, mean in levels:
        draw = normal(u(seed, name, *[F.col(k) for k in key]), above if mean is None else above + mean, spread)
        df = df.withColumn(name, draw)
        above = F.col(name)
    return df


def weighted_draw(draws: DataFrame, weighted: DataFrame, item: str, weight: str, p: str, buckets: int | None = None) -> DataFrame:
    """Give each draw the item in whose share of [0, 1) its uniform ``p`` falls: a weighted draw with replacement.

    Shares are cumulated in order of item. To avoid a nested loop, [0, 1) is
    cut into ``buckets``, by default about one for each item, so that a bucket
    has few shares at any size; each share is listed under every bucket that
    it touches, at most items and buckets together, and draws meet shares in
    an equi-join on the bucket. A null weight counts as 0.
    """
    items = weighted.select(F.col(item).alias("item"), F.col(weight).cast("double").alias("w")).where("w > 0")
    n = buckets or max(1024, items.count())
    bounds = running_share(items)
    listed = bounds.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("lo") * n).cast("long"), F.least(F.floor(F.col("hi") * n), F.lit(n - 1)).cast("long"))))
    asked = draws.withColumn("bucket", F.floor(F.col(p) * n).cast("long"))
    return asked.join(listed, "bucket").where((F.col(p) >= F.col("lo")) & (F.col(p) < F.col("hi"))).drop("bucket", "lo", "hi", "w").withColumnRenamed("item", item)


def running_sum(df: DataFrame, order: str, value: str, blocks: int | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before each (before), that over all (total), and the greatest ``order`` (last).

    Two levels: rows are cut into ``blocks`` (as many as shuffle partitions)
    by quantiles of ``order``, which is unique; sums run within a block, and each block starts at the
    sum of those before.
    """
    n = blocks or max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = df.select(F.percentile_approx(order, F.array(*[F.lit((i + 1) / n) for i in range(n - 1)]), 10_000).alias("_cuts"))
    ranged = df.crossJoin(F.broadcast(cuts)).withColumn("_block", F.size(F.filter("_cuts", lambda x: x < F.col(order)))).drop("_cuts")
    own = ranged.withColumn("_run", F.sum(value).over(Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
    sums = ranged.groupBy("_block").agg(F.sum(value).alias("_s"), F.max(order).alias("_last"))
    whole = Window.partitionBy()  # as many rows as blocks
    starts = sums.select("_block", (F.sum("_s").over(Window.orderBy("_block")) - F.col("_s")).alias("_start"), F.sum("_s").over(whole).alias("total"), F.max("_last").over(whole).alias("last"))
    return own.join(F.broadcast(starts), "_block").withColumn("before", F.col("_start") + F.col("_run") - F.col(value)).drop("_block", "_run", "_start")


def running_share(weighted: DataFrame) -> DataFrame:
    """(item, w, lo, hi): each item's share of the whole in order of item. The last share is open to 1."""
    run = running_sum(weighted.select("item", "w"), "item", "w")
    hi = F.when(F.col("item") == F.col("last"), 1.0).otherwise((F.col("before") + F.col("w")) / F.col("total"))
    return run.select("item", "w", (F.col("before") / F.col("total")).alias("lo"), hi.alias("hi"))
