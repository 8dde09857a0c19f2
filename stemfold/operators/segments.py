"""Sequence operators: runs, chunks, silence, cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemfold.functions.draws import u

CLASSES = ("none", "speech", "music", "both")
#: Levels are compared with means in whole parts of a dB, so many to one.
UNITS = 1e9
#: Levels from here on, infinite ones too, are compared as floating-point numbers.
ROUGH = 1e9


def encode_activation(speech: Column, music: Column, threshold: float = 0.5) -> Column:
    """2 for music plus 1 for speech, by thresholds."""
    return F.when(music > threshold, 2).otherwise(0) + F.when(speech > threshold, 1).otherwise(0)


def class_name(code: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in CLASSES]), code)


def run_length(frames: DataFrame, key: str | list[str], pos: str, cls: str, frame: float = 1.0) -> DataFrame:
    """(key, class, start_time, end_time): runs of equal classes; the last run of a key ends after its last frame.

    Frames are numbered within their key in order of ``pos``; a frame whose
    class differs from the one before starts a run. One shuffle on the key
    serves both windows.
    """
    keys = [key] if isinstance(key, str) else key
    order = Window.partitionBy(*keys).orderBy(pos)
    index = F.row_number().over(order) - 1
    new = F.when(F.col(cls).eqNullSafe(F.lag(cls).over(order)), 0).otherwise(1)
    numbered = frames.select(*keys, F.col(cls).alias("class"), index.alias("i"), F.when(index == 0, 1).otherwise(new).alias("new"))
    runs = numbered.withColumn("run", F.sum("new").over(Window.partitionBy(*keys).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "run").agg(F.first("class").alias("class"), (F.min("i") * frame).alias("start_time"), ((F.max("i") + 1) * frame).alias("end_time"))


def rechunk(segments: DataFrame, low: float, high: float, keep: list[str], duration: str = "duration") -> DataFrame:
    """Segments longer than ``high`` fall into equal parts, as few as possible; those shorter than ``low`` go."""
    d = F.col(duration)
    n = F.when(d > high, F.ceil(d / high)).otherwise(1).cast("int")
    parts = segments.where(d >= low).select(*keep, d.alias("_d"), n.alias("n_parts"), F.explode(F.sequence(F.lit(0), n - 1)).alias("part"))
    return parts.select(*keep, "part", (F.col("part") * F.col("_d") / F.col("n_parts")).alias("start_time"), ((F.col("part") + 1) * F.col("_d") / F.col("n_parts")).alias("end_time"))


def random_gap_chunks(df: DataFrame, key: str, size: float, seed: int, duration: str = "duration", channels: int = 2) -> DataFrame:
    """Chunks of a fixed size with random gaps: what is left over is spent chunk by chunk, anew for each channel.

    Before each chunk a draw takes that part of the slack that remains. The
    draws depend on seed, key, channel and number, and a fold over a row's
    chunks carries the end and the slack.
    """
    n = F.floor(F.col(duration) / size).cast("int")
    some = df.where(n >= 1).select(key, F.col(duration).alias("_d"), n.alias("n"), F.explode(F.sequence(F.lit(0), F.lit(channels - 1))).alias("channel"))
    zero = F.struct(F.lit(0.0).alias("end"), (F.col("_d") - F.col("n") * size).alias("slack"), F.array().cast("array<double>").alias("starts"))

    def place(s: Column, k: Column) -> Column:
        gap = u(seed, "gap", F.col(key), F.col("channel"), k) * s["slack"]
        return F.struct((s["end"] + gap + size).alias("end"), (s["slack"] - gap).alias("slack"), F.concat(s["starts"], F.array(s["end"] + gap)).alias("starts"))

    folded = some.withColumn("starts", F.aggregate(F.sequence(F.lit(0), F.col("n") - 1), zero, place)["starts"])
    out = folded.select(key, "channel", F.posexplode("starts").alias("chunk", "start_time"))
    return out.withColumn("end_time", F.col("start_time") + size)


def _units(level: Column) -> Column:
    return F.when(F.abs(level) < ROUGH, F.floor(level.cast("double") * UNITS + 0.5))


def mean_level(level: str) -> dict[str, Column]:
    """Aggregates of a key's levels, null ones left out, from which ``near_mean`` tells frames near the mean."""
    x = F.col(level).cast("double")
    return {"_avg": F.avg(x), "_rough": F.max(F.coalesce(F.abs(x) >= ROUGH, F.lit(False))), "_sum": F.sum(_units(x).cast("decimal(19,0)")), "_count": F.count(x)}


def near_mean(level: Column, drop: Column) -> Column:
    """Whether a frame is at most ``drop`` dB below the mean of its key (columns of ``mean_level``).

    Levels are added up in billionths of a dB, as whole numbers, and the mean is
    rounded up to one: a level in whole units reaches the exact mean just when it reaches this. So the answer hangs on the levels alone; a
    floating-point mean hangs on the order of its sum too, and a frame just ``drop``
    below it may fall on either side. Only keys with levels beyond ROUGH use that one.
    """
    n = F.col("_count").cast("decimal(19,0)")
    floor = F.expr("_sum div _count") + F.when(F.col("_sum") % n > 0, 1).otherwise(0)
    exact = _units(level) >= floor - F.floor(drop * UNITS + 0.5)
    return F.when(F.col("_rough") | (F.col("_count") == 0), level >= F.col("_avg") - drop).otherwise(exact)


def nonsilent(frames: DataFrame, key: str, pos: str, level: str, frame: float, drop: float = 16.0, least_silence: float = 1.0, pad: float = 0.1) -> DataFrame:
    """(key, start_time, end_time): stretches without a silence of ``least_silence`` seconds or more, padded and clamped.

    Silent is a frame more than ``drop`` dB below the mean level of its key;
    one that is just so far below is not (see ``near_mean``).
    Shorter silences belong to the sound around them.
    """
    return _nonsilent(frames, key, pos, level, frame, [drop], least_silence, pad).drop("step")


def _nonsilent(frames: DataFrame, key: str, pos: str, level: str, frame: float, drops: list[float], least_silence: float = 1.0, pad: float = 0.1) -> DataFrame:
    """nonsilent for several thresholds at once: (key, step, start_time, end_time).

    Frames are shuffled on the key once; thresholds multiply them after that,
    and all that follows is grouped by key and step, which that shuffle serves.
    """
    whole = Window.partitionBy(key)
    leveled = frames.select(key, pos, F.col(level).alias("_level"), *(c.over(whole).alias(n) for n, c in mean_level(level).items()), (F.count("*").over(whole) * frame).alias("_total"))
    steps = F.array(*[F.struct(F.lit(k).alias("step"), F.lit(float(d)).alias("drop")) for k, d in enumerate(drops)])
    flagged = leveled.withColumn("s", F.explode(steps)).select(key, pos, "s.step", F.struct(near_mean(F.col("_level"), F.col("s.drop")).alias("loud"), "_total").alias("c"))
    keys = [key, "step"]
    runs = run_length(flagged, keys, pos, "c", frame).select(*keys, F.col("class.loud").alias("loud"), F.col("class._total").alias("_total"), "start_time", "end_time")
    one, order = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("start_time")
    edges = {"_lo": F.min(F.when(F.col("loud"), F.col("start_time"))).over(one), "_hi": F.max(F.when(F.col("loud"), F.col("end_time"))).over(one)}
    heard = runs.withColumns(edges).withColumn("heard", F.col("loud") | (F.col("end_time") - F.col("start_time") < least_silence))
    marked = heard.withColumn("new", F.when(F.col("heard") & ~F.coalesce(F.lag("heard").over(order), F.lit(False)), 1).otherwise(0)).withColumn("isle", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    isles = marked.where("heard").groupBy(*keys, "isle").agg(F.min("start_time").alias("a"), F.max("end_time").alias("b"), *(F.first(c).alias(c) for c in ("_lo", "_hi", "_total")))
    # silences at the edges are no part of the sound, however short
    inner = isles.select(*keys, "_total", F.greatest("a", "_lo").alias("a"), F.least("b", "_hi").alias("b")).where("_lo IS NOT NULL AND a < b")
    return inner.select(*keys, F.greatest(F.lit(0.0), F.col("a") - pad).alias("start_time"), F.least("_total", F.col("b") + pad).alias("end_time"))


def trim(frames: DataFrame, key: str, pos: str, level: str, db: float, hop: float = 0.01, width: float = 0.04) -> DataFrame:
    """(key, start_time, end_time): from the first to the last frame within ``db`` of the key's peak."""
    peak = frames.groupBy(key).agg(F.max(level).alias("_peak"))
    index = F.row_number().over(Window.partitionBy(key).orderBy(pos)) - 1
    loud = frames.select(key, index.alias("i"), level).join(peak, key).where(F.col(level) > F.col("_peak") - db)
    return loud.groupBy(key).agg((F.min("i") * hop).alias("start_time"), (F.max("i") * hop + width).alias("end_time"))


def ladder_split(frames: DataFrame, key: str, pos: str, level: str, frame: float, longest: float, drops: list[float], **how: float) -> DataFrame:
    """Split by the first threshold of a ladder that leaves no piece over ``longest``, else by the last: (key, step, start_time, end_time)."""
    pieces = _nonsilent(frames, key, pos, level, frame, drops, **how)
    worst = F.max(F.col("end_time") - F.col("start_time")).over(Window.partitionBy(key, "step"))
    whole = Window.partitionBy(key)
    chosen = F.coalesce(F.min(F.when(F.col("worst") <= longest, F.col("step"))).over(whole), F.max("step").over(whole))
    return pieces.withColumn("worst", worst).withColumn("chosen", chosen).where("step = chosen").select(key, "step", "start_time", "end_time")


def sample_bounds(df: DataFrame, rate: int, mode: str = "cut") -> DataFrame:
    """Seconds to samples: ``cut`` widens to whole samples, ``truncate`` drops fractions on both sides."""
    a, b = F.col("start_time") * rate, F.col("end_time") * rate
    start, end = (F.floor(a), F.ceil(b)) if mode == "cut" else (a.cast("bigint"), b.cast("bigint"))
    return df.withColumns({"start_sample": start.cast("long"), "end_sample": end.cast("long")})
