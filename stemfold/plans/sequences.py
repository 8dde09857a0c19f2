"""Queries of sequences, draws, splits, placement, levels, expectations, sources and the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemfold.functions import draws as D
from stemfold.functions import scalars as S
from stemfold.operators import curate as C
from stemfold.operators import expect as Q
from stemfold.operators import levels as L
from stemfold.operators import scans as N
from stemfold.operators import segments as W
from stemfold.operators import splits as P
from stemfold.operators import timeline as T
from stemfold.plans.curation import FLAGS, URLS
from stemfold.plans.registry import CLIPS, SQL, cdf_sql, clips, quantile_sql, query, table, u_sql
from stemfold.sources import manifests as M
from stemfold.sources.scratch import fresh
from stemfold.streaming.ingest import ingest

# --- runs and chunks -----------------------------------------------------------

RUNS = """fr AS (SELECT user_id, event_id, {cls} AS cls, {extra} row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events {join}),
 fl AS (SELECT *, CASE WHEN i > 0 AND cls = lag(cls) OVER (PARTITION BY user_id ORDER BY i) THEN 0 ELSE 1 END AS new FROM fr),
 rn AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY i) AS run FROM fl),
 runs AS (SELECT user_id, run, any_value(cls) AS cls, min(i) * {frame}::DOUBLE AS a, (max(i) + 1) * {frame}::DOUBLE AS b FROM rn GROUP BY user_id, run)"""


@query("run_length", "WITH " + RUNS.format(cls="(CASE WHEN event_type IN ('click', 'purchase') THEN 2 ELSE 0 END + CASE WHEN event_type IN ('view', 'purchase') THEN 1 ELSE 0 END)", extra="", join="", frame="0.5") + " SELECT user_id, CASE cls WHEN 0 THEN 'none' WHEN 1 THEN 'speech' WHEN 2 THEN 'music' ELSE 'both' END AS class, round(a, 6) AS start_time, round(b, 6) AS end_time FROM runs")
def run_length(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    t = F.col("event_type")
    frames = e.select("user_id", "event_id", W.encode_activation(t.isin("view", "purchase").cast("double"), t.isin("click", "purchase").cast("double")).alias("code"))
    out = W.run_length(frames, "user_id", "event_id", "code", 0.5)
    return out.select("user_id", W.class_name(F.col("class")).alias("class"), F.round("start_time", 6).alias("start_time"), F.round("end_time", 6).alias("end_time"))


@query(
    "rechunk",
    "WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS d, CASE WHEN l_quantity > 12 THEN ceil(l_quantity / 12) ELSE 1 END::BIGINT AS n FROM lineitem WHERE l_quantity >= 3), p AS (SELECT *, unnest(range(0, n)) AS part FROM s) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, part::INT AS part, round(part * d / n, 6) AS start_time, round((part + 1) * d / n, 6) AS end_time FROM p",
)
def rechunk(spark: SparkSession, sf: str) -> DataFrame:
    out = W.rechunk(table(spark, sf, "lineitem"), 3, 12, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "l_quantity")
    return out.withColumns({c: F.round(c, 6) for c in ("start_time", "end_time")})


@query(
    "gap_chunks",
    f"""WITH RECURSIVE {CLIPS}, s AS (SELECT doc_id, duration AS d, floor(duration / 5)::BIGINT AS n, unnest([0, 1]) AS channel FROM clips WHERE duration >= 5),
 f AS (SELECT doc_id, channel, n, 0 AS k, {u_sql(7, 'gap', 'doc_id', 'channel', '0')} * (d - n * 5.0::DOUBLE) AS start, (d - n * 5.0::DOUBLE) AS slack FROM s UNION ALL
 SELECT doc_id, channel, n, k + 1, (start + 5.0::DOUBLE) + {u_sql(7, 'gap', 'doc_id', 'channel', 'k + 1')} * (slack - {u_sql(7, 'gap', 'doc_id', 'channel', 'k')} * slack), slack - {u_sql(7, 'gap', 'doc_id', 'channel', 'k')} * slack FROM f WHERE k + 1 < n)
 SELECT doc_id, channel, k AS chunk, round(start, 6) AS start_time, round(start + 5.0::DOUBLE, 6) AS end_time FROM f""",
)
def gap_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return W.random_gap_chunks(clips(spark, sf), "doc_id", 5.0, 7).withColumns({c: F.round(c, 6) for c in ("start_time", "end_time")})


def _levels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("user_id", "event_id", "value")


def _nonsilent_sql(drop: float, name: str) -> str:
    # the mean as a fraction of whole numbers, billionths of a dB: no sum of floating-point numbers decides whether a frame is just so far below it
    part = "floor(value * 1e9 + 0.5::DOUBLE)::HUGEINT"
    near = f"(CASE WHEN rough THEN value >= m - {drop} ELSE ({part} + {round(drop * 1e9)}) * n >= total_parts END)"
    means = f"JOIN (SELECT user_id AS mu, avg(value) AS m, coalesce(bool_or(NOT abs(value) < 1e9), false) AS rough, count(value) AS n, sum(CASE WHEN abs(value) < 1e9 THEN {part} END) AS total_parts FROM events GROUP BY 1) ON user_id = mu"
    return RUNS.format(cls=near, extra="", join=means, frame="0.5").replace("fr AS", f"fr{name} AS").replace("FROM fr)", f"FROM fr{name})").replace("fl AS", f"fl{name} AS").replace("FROM fl)", f"FROM fl{name})").replace("rn AS", f"rn{name} AS").replace("FROM rn ", f"FROM rn{name} ").replace("runs AS", f"runs{name} AS") + f""",
 ed{name} AS (SELECT user_id, min(a) AS lo, max(b) AS hi FROM runs{name} WHERE cls GROUP BY 1),
 hd{name} AS (SELECT user_id, a, b, cls OR (b - a < 1) AS cls FROM runs{name}),
 il{name} AS (SELECT *, sum(CASE WHEN cls AND NOT coalesce(p, false) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a) AS isle FROM (SELECT *, lag(cls) OVER (PARTITION BY user_id ORDER BY a) AS p FROM hd{name})),
 tt{name} AS (SELECT user_id, count(*) * 0.5::DOUBLE AS total FROM events GROUP BY 1),
 ns{name} AS (SELECT g.user_id, greatest(0.0::DOUBLE, greatest(a, lo) - 0.1::DOUBLE) AS start_time, least(total, least(b, hi) + 0.1::DOUBLE) AS end_time FROM (SELECT user_id, isle, min(a) AS a, max(b) AS b FROM il{name} WHERE cls GROUP BY 1, 2) g JOIN ed{name} e ON e.user_id = g.user_id JOIN tt{name} t ON t.user_id = g.user_id WHERE greatest(a, lo) < least(b, hi))"""


@query("nonsilent", "WITH " + _nonsilent_sql(16.0, "") + " SELECT user_id, round(start_time, 6) AS start_time, round(end_time, 6) AS end_time FROM ns")
def nonsilent(spark: SparkSession, sf: str) -> DataFrame:
    return W.nonsilent(_levels(spark, sf), "user_id", "event_id", "value", 0.5).withColumns({c: F.round(c, 6) for c in ("start_time", "end_time")})


@query("trim_silence", "WITH f AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, max(value) OVER (PARTITION BY user_id) AS peak FROM events) SELECT user_id, round(min(i) * 0.01::DOUBLE, 6) AS start_time, round(max(i) * 0.01::DOUBLE + 0.04::DOUBLE, 6) AS end_time FROM f WHERE value > peak - 40 GROUP BY 1")
def trim_silence(spark: SparkSession, sf: str) -> DataFrame:
    return W.trim(_levels(spark, sf), "user_id", "event_id", "value", 40).withColumns({c: F.round(c, 6) for c in ("start_time", "end_time")})


_ladder = (60.0, 40.0, 20.0, 10.0)


@query(
    "ladder_split",
    "WITH " + ", ".join(_nonsilent_sql(d, str(k)) for k, d in enumerate(_ladder)) + ", l AS (" + " UNION ALL ".join(f"SELECT *, {k} AS step FROM ns{k}" for k in range(4)) + ") , w AS (SELECT user_id, step, max(end_time - start_time) AS worst FROM l GROUP BY 1, 2), c AS (SELECT user_id, coalesce(min(CASE WHEN worst <= 8 THEN step END), max(step)) AS step FROM w GROUP BY 1) SELECT user_id, step, round(start_time, 6) AS start_time, round(end_time, 6) AS end_time FROM l JOIN c USING (user_id, step)",
)
def ladder_split(spark: SparkSession, sf: str) -> DataFrame:
    return W.ladder_split(_levels(spark, sf), "user_id", "event_id", "value", 0.5, 8.0, list(_ladder)).withColumns({c: F.round(c, 6) for c in ("start_time", "end_time")})


_SECONDS = ("start_time", "end_time")


@query("run_length_scan", SQL["run_length"])
def run_length_scan(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("event_type")
    frames = table(spark, sf, "events").select("user_id", "event_id", W.encode_activation(t.isin("view", "purchase").cast("double"), t.isin("click", "purchase").cast("double")).alias("code"))
    return N.run_length_scan(frames, "user_id", "event_id", "code", 0.5).select("user_id", W.class_name(F.col("class")).alias("class"), *(F.round(c, 6).alias(c) for c in _SECONDS))


@query("nonsilent_scan", SQL["nonsilent"])
def nonsilent_scan(spark: SparkSession, sf: str) -> DataFrame:
    return N.nonsilent_scan(_levels(spark, sf), "user_id", "event_id", "value", 0.5).withColumns({c: F.round(c, 6) for c in _SECONDS})


@query("ladder_split_scan", SQL["ladder_split"])
def ladder_split_scan(spark: SparkSession, sf: str) -> DataFrame:
    return N.ladder_split_scan(_levels(spark, sf), "user_id", "event_id", "value", 0.5, 8.0, list(_ladder)).withColumns({c: F.round(c, 6) for c in _SECONDS})


@query(
    "segment_names",
    "WITH s AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS segment, turn * 1.25::DOUBLE AS a, turn * 1.25::DOUBLE + length(text) / 37.0::DOUBLE AS b FROM conversations) SELECT conv_id, turn, segment, conv_id || '_' || lpad(segment::VARCHAR, 4, '0') AS name, floor(a * 44100)::BIGINT AS start_sample, ceil(b * 44100)::BIGINT AS end_sample, trunc(a * 44100)::BIGINT AS start_truncated, trunc(b * 44100)::BIGINT AS end_truncated FROM s",
)
def segment_names(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", (F.col("turn") * 1.25).alias("start_time"), (F.col("turn") * 1.25 + F.length("text") / 37.0).alias("end_time"))
    numbered = C.number_segments(turns, "conv_id", ["turn"], "name")
    wide = W.sample_bounds(numbered, 44_100)
    both = W.sample_bounds(wide.withColumnsRenamed({"start_sample": "start_wide", "end_sample": "end_wide"}), 44_100, "truncate")
    return both.select("conv_id", "turn", F.col("segment").cast("bigint").alias("segment"), "name", F.col("start_wide").alias("start_sample"), F.col("end_wide").alias("end_sample"), F.col("start_sample").alias("start_truncated"), F.col("end_sample").alias("end_truncated"))


# --- draws ------------------------------------------------------------------------


@query(
    "weighted_draw",
    f"""WITH w AS (SELECT p_partkey AS item, p_size::DOUBLE AS w FROM part), b AS (SELECT item, (sum(w) OVER (ORDER BY item) - w) / (SELECT sum(w) FROM w) AS lo, CASE WHEN item = (SELECT max(item) FROM w) THEN 1.0 ELSE sum(w) OVER (ORDER BY item) / (SELECT sum(w) FROM w) END AS hi FROM w),
 d AS (SELECT o_orderkey, {u_sql(3, 'pick', 'o_orderkey')} AS p FROM orders) SELECT o_orderkey, item AS p_partkey FROM d ASOF JOIN b ON d.p >= b.lo""",
)
def weighted_draw(spark: SparkSession, sf: str) -> DataFrame:
    drawn = table(spark, sf, "orders").select("o_orderkey", D.u(3, "pick", F.col("o_orderkey")).alias("p"))
    return D.weighted_draw(drawn, table(spark, sf, "part"), "p_partkey", "p_size", "p").select("o_orderkey", "p_partkey")


@query("draw_normal", f"SELECT o_orderkey, round({quantile_sql(u_sql(1, 'n', 'o_orderkey'))} * 2.0::DOUBLE + -27.0::DOUBLE, 6) AS normal, round((2 * {u_sql(1, 'v', 'o_orderkey')} - 1) * 3.0::DOUBLE + 5.0::DOUBLE, 6) AS uniform FROM orders")
def draw_normal(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", F.round(D.normal(D.u(1, "n", k), -27.0, 2.0), 6).alias("normal"), F.round(D.uniform(D.u(1, "v", k), 5.0, 3.0), 6).alias("uniform"))


def _poisson_sql(low: int, high: int | None, mu: str) -> str:
    top = "" if high is None else f" AND k <= {high}"
    return f"""ps AS (SELECT m.mu, k, exp(k * ln(m.mu) - m.mu - sum(CASE WHEN k > 0 THEN ln(k) ELSE 0 END) OVER (PARTITION BY m.mu ORDER BY k)) AS p FROM (SELECT DISTINCT {mu} AS mu FROM lineitem) m, (SELECT unnest(range(0, 201))::DOUBLE AS k)),
 pc AS (SELECT mu, k, sum(p) OVER (PARTITION BY mu ORDER BY k) - p AS lo, sum(p) OVER (PARTITION BY mu ORDER BY k) AS hi FROM ps), pb AS (SELECT mu, min(lo) AS c0, max(hi) AS c1 FROM pc WHERE k >= {low}{top} GROUP BY mu), pt AS (SELECT pc.mu, k, (lo - c0) / (c1 - c0) AS lo FROM pc JOIN pb ON pc.mu = pb.mu WHERE k >= {low}{top})"""


@query(
    "draw_counts",
    f"WITH {_poisson_sql(1, None, '(l_linenumber + 1)::DOUBLE')}, d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_linenumber + 1)::DOUBLE AS mu, {u_sql(2, 'zt', 'l_orderkey', 'l_linenumber', 'l_partkey')} AS p FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(k, 1)::INT AS n FROM d ASOF LEFT JOIN pt ON d.mu = pt.mu AND d.p >= pt.lo",
)
def draw_counts(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    rows = table(spark, sf, "lineitem").select(*keys, "l_suppkey", (F.col("l_linenumber") + 1).cast("double").alias("mu"), D.u(2, "zt", *[F.col(k) for k in keys]).alias("p"))
    return D.truncated_poisson(rows, "mu", "p", 1, None, "n").drop("mu", "p")


@query(
    "draw_bounded_counts",
    f"WITH {_poisson_sql(1, 4, '(l_linenumber + 1)::DOUBLE')}, d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_linenumber + 1)::DOUBLE AS mu, {u_sql(2, 'tp', 'l_orderkey', 'l_linenumber', 'l_partkey')} AS p FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(k, 1)::INT AS n FROM d ASOF LEFT JOIN pt ON d.mu = pt.mu AND d.p >= pt.lo",
)
def draw_bounded_counts(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    rows = table(spark, sf, "lineitem").select(*keys, "l_suppkey", (F.col("l_linenumber") + 1).cast("double").alias("mu"), D.u(2, "tp", *[F.col(k) for k in keys]).alias("p"))
    return D.truncated_poisson(rows, "mu", "p", 1, 4, "n").drop("mu", "p")


_LARGE = (0.1, 12.0, 200.0, 5000.0)


@query(
    "draw_large_counts",
    f"""WITH m AS (SELECT unnest({list(_LARGE)!r}::DOUBLE[]) AS mu), k AS (SELECT mu, unnest(range(1, (mu + 14 * sqrt(mu) + 60)::BIGINT)) AS k FROM m),
 w AS (SELECT mu, k, k * ln(mu) - sum(ln(k)) OVER (PARTITION BY mu ORDER BY k) AS l FROM k), e AS (SELECT mu, k, exp(l - max(l) OVER (PARTITION BY mu)) AS w FROM w),
 pt AS (SELECT mu, k, (sum(w) OVER (PARTITION BY mu ORDER BY k) - w) / sum(w) OVER (PARTITION BY mu) AS lo FROM e),
 d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ({list(_LARGE)!r}::DOUBLE[])[1 + l_linenumber % 4] AS mu, {u_sql(2, 'large', 'l_orderkey', 'l_linenumber', 'l_partkey')} AS p FROM lineitem)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, d.mu, coalesce(k, 1)::INT AS n FROM d ASOF LEFT JOIN pt ON d.mu = pt.mu AND d.p >= pt.lo""",
)
def draw_large_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Zero-truncated counts with means from 0.1 to 5,000."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    means = F.get(F.array(*map(F.lit, _LARGE)), F.col("l_linenumber") % 4)
    rows = table(spark, sf, "lineitem").select(*keys, "l_suppkey", means.alias("mu"), D.u(2, "large", *[F.col(k) for k in keys]).alias("p"))
    return D.truncated_poisson(rows, "mu", "p", 1, None, "n").drop("p")


def _skew_sql(p0: str, p1: str, loc: str, scale: float = 2.0, shape: float = 5.0) -> str:
    delta = shape / (1 + shape * shape) ** 0.5
    return f"greatest(0.0::DOUBLE, {loc} + {scale!r}::DOUBLE * ({delta!r}::DOUBLE * abs({quantile_sql(p0)}) + {(1 - delta * delta) ** 0.5!r}::DOUBLE * {quantile_sql(p1)}))"


def _trunc_sql(p: str, loc: str, scale: str, low: str, high: str) -> str:
    a, b = cdf_sql(f"(({low} - {loc}) / {scale})"), cdf_sql(f"(({high} - {loc}) / {scale})")
    return f"CASE WHEN {high} <= {low} THEN {high} ELSE greatest({low}, least({high}, {loc} + {scale} * {quantile_sql(f'({a} + {p} * ({b} - {a}))')})) END"


_lk = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "draw_times",
    f"""WITH d AS (SELECT {', '.join(_lk)}, l_quantity AS len, {u_sql(4, 'a', *_lk)} AS p0, {u_sql(4, 'b', *_lk)} AS p1, {u_sql(4, 'c', *_lk)} AS p2, {u_sql(4, 'd', *_lk)} AS p3 FROM lineitem),
 e AS (SELECT *, {_trunc_sql('p2', '(len * 0.8::DOUBLE)', '(len * 0.25::DOUBLE)', '2.0::DOUBLE', 'len')} AS length FROM d)
 SELECT {', '.join(_lk)}, round({_skew_sql('p0', 'p1', '1.5::DOUBLE')}, 6) AS start, round(length, 6) AS length, CASE WHEN trunc(len * 1000) > trunc(length * 1000) THEN floor(p3 * (trunc(len * 1000) - trunc(length * 1000))) ELSE 0 END::BIGINT AS segment_start FROM e""",
)
def draw_times(spark: SparkSession, sf: str) -> DataFrame:
    draw = lambda tag: D.u(4, tag, *[F.col(k) for k in _lk])
    size = F.col("len")
    rows = table(spark, sf, "lineitem").select(*_lk, F.col("l_quantity").alias("len"), draw("a").alias("p0"), draw("b").alias("p1"), draw("c").alias("p2"), draw("d").alias("p3"))
    rows = rows.withColumn("length", D.trunc_length(F.col("p2"), size * 0.8, size * 0.25, F.lit(2.0), size))
    return rows.select(*_lk, F.round(D.skew_start(F.col("p0"), F.col("p1"), F.lit(1.5)), 6).alias("start"), F.round("length", 6).alias("length"), D.segment_offset(F.col("p3"), (size * 1000).cast("bigint"), (F.col("length") * 1000).cast("bigint")).alias("segment_start"))


@query(
    "draw_components",
    f"""WITH f AS (SELECT DISTINCT l_orderkey AS track, l_returnflag || l_linestatus AS stem, l_partkey::VARCHAR AS path FROM lineitem),
 o AS (SELECT track, stem, path FROM (SELECT *, row_number() OVER (PARTITION BY track, stem ORDER BY {u_sql(5, 'file', 'track', 'stem', 'path')}, path) AS r FROM f) WHERE r = 1),
 k AS (SELECT *, row_number() OVER (PARTITION BY track ORDER BY {u_sql(5, 'component', 'track', 'stem')}, stem) AS rank FROM o)
 SELECT track, stem, path FROM k WHERE rank <= 1 + track % 3""",
)
def draw_components(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("track"), F.concat("l_returnflag", "l_linestatus").alias("stem"), F.col("l_partkey").cast("string").alias("path")).distinct()
    counts = files.select("track").distinct().withColumn("n", 1 + F.col("track") % 3)
    return T.draw_components(files, "track", "stem", "path", counts, 5)


@query(
    "precompute_table",
    f"""WITH k AS (SELECT o_orderstatus AS split, o_orderkey AS idx FROM orders), ps AS (SELECT k, exp(k * ln(12.0::DOUBLE) - 12.0::DOUBLE - sum(CASE WHEN k > 0 THEN ln(k) ELSE 0 END) OVER (ORDER BY k)) AS p FROM (SELECT unnest(range(0, 201))::DOUBLE AS k)),
 pc AS (SELECT k, sum(p) OVER (ORDER BY k) - p AS lo, sum(p) OVER (ORDER BY k) AS hi FROM ps), pt AS (SELECT k, (lo - (SELECT min(lo) FROM pc WHERE k >= 1)) / ((SELECT max(hi) FROM pc WHERE k >= 1) - (SELECT min(lo) FROM pc WHERE k >= 1)) AS lo FROM pc WHERE k >= 1),
 d AS (SELECT split, idx, {quantile_sql(u_sql(9, 'speech', 'split', 'idx'))} * 2.0::DOUBLE + -17.0::DOUBLE AS speech_lufs, {quantile_sql(u_sql(9, 'master', 'split', 'idx'))} * 1.0::DOUBLE + -27.0::DOUBLE AS master_lufs, {u_sql(9, 'segments', 'split', 'idx')} AS p FROM k),
 e AS (SELECT *, {quantile_sql(u_sql(9, 'submix', 'split', 'idx'))} * 2.0::DOUBLE + (0.0::DOUBLE + -5.0::DOUBLE) AS submix FROM d)
 SELECT split, idx, round(speech_lufs, 6) AS speech_lufs, round(master_lufs, 6) AS master_lufs, coalesce(k, 1)::INT AS speech_segments, round(submix, 6) AS submix, round({quantile_sql(u_sql(9, 'clip', 'split', 'idx'))} * 1.0::DOUBLE + submix, 6) AS clip FROM e ASOF LEFT JOIN pt ON e.p >= pt.lo""",
)
def precompute_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("split"), F.col("o_orderkey").alias("idx"))
    made = T.precomputed_draws(rows, 9, -17.0, 2.0, -27.0, 1.0, 12.0)
    made = D.level_hierarchy(made, 9, [("submix", ["split", "idx"], 2.0, -5.0), ("clip", ["split", "idx"], 1.0, None)])
    return made.select("split", "idx", *[F.round(c, 6).alias(c) for c in ("speech_lufs", "master_lufs")], "speech_segments", *[F.round(c, 6).alias(c) for c in ("submix", "clip")])


@query("seeded_shuffle", f"SELECT o_orderkey, row_number() OVER (ORDER BY {u_sql(6, 'shuffle', 'o_orderkey')}, o_orderkey)::BIGINT AS place, (['x', 'y', 'z'])[1 + floor({u_sql(6, 'pick', 'o_orderkey')} * 3)::BIGINT] AS pick FROM orders")
def seeded_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey")
    counts = o.agg(F.count("*").alias("n")).select(F.lit(0).cast("bigint").alias("idx"), F.col("n"))
    numbered = T.exhaust(o.withColumnRenamed("o_orderkey", "key"), "key", counts, 6, tag="shuffle", keyed_by_loop=False)
    return numbered.select(F.col("key").alias("o_orderkey"), (F.col("slot") + 1).alias("place"), C.pick(F.array(F.lit("x"), F.lit("y"), F.lit("z")), D.u(6, "pick", F.col("key"))).alias("pick"))


@query(
    "exhaust",
    f"""WITH f AS (SELECT doc_id, l.loop, row_number() OVER (ORDER BY l.loop, {u_sql(8, 'exhaust', 'l.loop', 'doc_id')}, doc_id) - 1 AS slot FROM documents, (VALUES (0), (1)) l(loop)),
 c AS (SELECT c_custkey AS idx, 1 + c_custkey % 4 AS n, sum(1 + c_custkey % 4) OVER (ORDER BY c_custkey) - (1 + c_custkey % 4) AS lo FROM customer)
 SELECT f.loop, doc_id, slot::BIGINT AS slot, idx, (slot - lo)::BIGINT AS event FROM f JOIN c ON slot >= lo AND slot < lo + n""",
)
def exhaust(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "customer").select(F.col("c_custkey").alias("idx"), (1 + F.col("c_custkey") % 4).alias("n"))
    return T.exhaust(table(spark, sf, "documents"), "doc_id", counts, 8, 2)


# --- placement ----------------------------------------------------------------------

_cfg = T.Placement(hop_seconds=1.0, min_prop=0.4, min_seconds=2.0, end_seconds=1.0, end_prop=0.1, length_loc=0.7, length_scale=0.3, overlap=0.25)
_TRIALS = 3


HOPS_SQL = "hops AS (SELECT file, pos, CASE WHEN file % 11 = 0 OR (pos // 16) % 3 = file % 3 THEN 0 ELSE x * x END::DOUBLE AS power FROM (SELECT vec_id AS file, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings WHERE vec_id < 500))"
ENERGY_SQL = """hb AS (SELECT *, CASE WHEN count(*) OVER w = 4 AND avg(power) OVER w > 0 THEN 10 * log10(CASE WHEN avg(power) OVER w > 0 THEN avg(power) OVER w ELSE 1 END) - 0.691::DOUBLE > -70 ELSE false END AS is_loud FROM hops WINDOW w AS (PARTITION BY file ORDER BY pos ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)),
 hs AS (SELECT file, pos, sum(power) OVER w AS e, sum(is_loud::INT) OVER w AS l FROM hb WINDOW w AS (PARTITION BY file ORDER BY pos)), en AS (SELECT file, list_concat([0.0::DOUBLE], list(e ORDER BY pos)) AS energy, list_concat([0::BIGINT], list(l::BIGINT ORDER BY pos)) AS loud FROM hs GROUP BY file)"""


def _timeline_sql() -> str:
    c, end, rate = _cfg, f"{_cfg.length!r}::DOUBLE", _cfg.rate
    least = f"greatest(len * {c.min_prop}::DOUBLE, {c.min_seconds}::DOUBLE)"
    last = f"least({end} - least_, {end} - {c.end_seconds}::DOUBLE, {end} - {c.end_prop}::DOUBLE * len)"
    start = f"greatest(t, least({_skew_sql('p0', 'p1', f'(t + {c.offset}::DOUBLE)', c.scale, c.shape)}, last_))"
    length = f"CASE WHEN len <= least_ THEN len ELSE {_trunc_sql('p2', f'(most * {c.length_loc}::DOUBLE)', f'(most * {c.length_scale}::DOUBLE)', 'least_', 'most')} END"
    hop = c.hop
    return f"""WITH RECURSIVE {HOPS_SQL}, {ENERGY_SQL},
 ev AS (SELECT l_orderkey AS k, l_quantity AS len, l_partkey % 500 AS file, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS event FROM lineitem),
 ca AS (SELECT k, event, trial, len, loud, energy, event * {_TRIALS} + trial AS step, {u_sql(11, 's0', 'k', 'event', 'trial')} AS p0, {u_sql(11, 's1', 'k', 'event', 'trial')} AS p1, {u_sql(11, 'len', 'k', 'event', 'trial')} AS p2, {u_sql(11, 'next', 'k', 'event', 'trial')} AS p3, {u_sql(11, 'offset', 'k', 'event', 'trial')} AS p4 FROM ev LEFT JOIN en ON en.file = ev.file, (SELECT unnest(range(0, {_TRIALS})) AS trial)),
 st AS (SELECT k, -1::BIGINT AS step, 0.0::DOUBLE AS t, -1::BIGINT AS last, NULL::BIGINT AS event, NULL::BIGINT AS trial, NULL::BIGINT AS a, NULL::BIGINT AS n, NULL::BIGINT AS off FROM (SELECT DISTINCT k FROM ev)
 UNION ALL SELECT k, step, CASE WHEN ok THEN ((a + n * {1 - c.overlap!r}::DOUBLE) + floor(p3 * greatest(least({int(c.length * rate)}::DOUBLE, (a + n)::DOUBLE) - (a + n * {1 - c.overlap!r}::DOUBLE), 0.0::DOUBLE))) / {rate}::DOUBLE ELSE t END, CASE WHEN ok THEN event ELSE last END, CASE WHEN ok THEN event END, CASE WHEN ok THEN trial END, CASE WHEN ok THEN a END, CASE WHEN ok THEN n END, CASE WHEN ok THEN o END
 FROM (SELECT *, event <> last AND fits AND n > 0 AND coalesce(CASE WHEN (o + n) // {hop} - ceil(o / {hop}) < 4 THEN energy[least(ceil((o + n) / {hop})::BIGINT, len(energy) - 1) + 1] - energy[least(o // {hop}, len(energy) - 1) + 1] > {10 ** -6.9309!r}::DOUBLE * (ceil((o + n) / {hop}) - o // {hop})
 ELSE loud[least((o + n) // {hop} - 3, len(loud) - 1) + 1] - loud[least(ceil(o / {hop})::BIGINT, len(loud) - 1) + 1] > 0 END, false) AS ok FROM (SELECT *, CASE WHEN trunc(len_ * {rate}) > n THEN floor(p4 * (trunc(len_ * {rate}) - n)) ELSE 0 END::BIGINT AS o FROM (SELECT *, len AS len_, trunc(start * {rate})::BIGINT AS a, trunc(length * {rate})::BIGINT AS n, {end} - t >= least_ AND last_ >= t AND start + length <= {end} + 1e-9::DOUBLE AS fits
 FROM (SELECT *, {length} AS length FROM (SELECT *, least(len, {end} - start) AS most FROM (SELECT *, {start} AS start FROM (SELECT *, {last} AS last_ FROM (SELECT ca.*, st.t, st.last, {least.replace('len', 'ca.len')} AS least_ FROM st JOIN ca ON ca.k = st.k AND ca.step = st.step + 1))))))))
 )
 SELECT k AS l_orderkey, event, trial::INT AS trial, a AS start_sample, n AS length_sample, off AS segment_start_sample FROM st WHERE a IS NOT NULL"""


def _hops(spark: SparkSession, sf: str) -> DataFrame:
    """The components of vectors as the hops of source files: of each file a third of the stretches of 16 hops is silent, and one file in 11 is wholly so."""
    e = table(spark, sf, "embeddings").where("vec_id < 500").select(F.col("vec_id").alias("file"), F.posexplode("embedding").alias("pos", "x"))
    silent = (F.col("file") % 11 == 0) | (F.floor(F.col("pos") / 16) % 3 == F.col("file") % 3)
    return e.select("file", "pos", F.when(silent, 0.0).otherwise(F.col("x").cast("double") * F.col("x").cast("double")).alias("power"))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    ordered = C.number_segments(table(spark, sf, "lineitem"), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"], "name")
    return ordered.select("l_orderkey", F.col("segment").cast("bigint").alias("event"), F.col("l_quantity").alias("len"), (F.col("l_partkey") % 500).alias("file"))


def _placed(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    return T.place_events(_events(spark, sf), "l_orderkey", _cfg, _TRIALS, 11, T.energy_table(_hops(spark, sf), "file", "pos", "power"), keep)


@query("timeline", _timeline_sql())
def timeline(spark: SparkSession, sf: str) -> DataFrame:
    return _placed(spark, sf)


def _annotation_sql() -> str:
    hop, rate = _cfg.hop, _cfg.rate
    gate = "CASE WHEN p > 0 THEN 10 * log10(p) - 0.691::DOUBLE ELSE '-Infinity'::DOUBLE END"

    def gated(name: str, key: str, hops: str, pos: str) -> str:
        on = " AND ".join(f"x.{k} = y.{k}" for k in key.split(", "))
        return f"""{name}0 AS (SELECT {key}, {pos} AS spot, p, min({pos}) OVER (PARTITION BY {key}) AS lo, max({pos}) OVER (PARTITION BY {key}) AS hi FROM {hops}),
 {name}1 AS (SELECT {key}, sum(p) / (max(hi) - min(lo) + 1) AS p FROM {name}0 WHERE hi - lo < 3 GROUP BY {key} UNION ALL SELECT {key}, sum(p) / 4 FROM (SELECT *, unnest(range(spot - 3, spot + 1)) AS b FROM {name}0) WHERE hi - lo >= 3 AND b >= lo AND b + 3 <= hi GROUP BY {key}, b),
 {name}2 AS (SELECT *, {gate} AS l FROM {name}1), {name}3 AS (SELECT {key}, avg(p) AS p FROM {name}2 WHERE l > -70 GROUP BY {key}),
 {name} AS (SELECT {key}, {gate} AS level FROM (SELECT {', '.join('x.' + k for k in key.split(', '))}, avg(x.p) AS p FROM {name}2 x JOIN (SELECT {key}, {gate} AS f FROM {name}3) y ON {on} WHERE x.l > -70 AND x.l > f - 10 GROUP BY ALL))"""

    return _timeline_sql().replace(" )\n SELECT k AS l_orderkey, event,", " ),\n pl AS (SELECT k AS l_orderkey, event,", 1) + f"""),
 pf AS (SELECT pl.*, ev.file FROM pl JOIN ev ON ev.k = pl.l_orderkey AND ev.event = pl.event),
 hp AS (SELECT l_orderkey, event, u - segment_start_sample // {hop} AS hop, start_sample // {hop} + u - segment_start_sample // {hop} AS spot, hops.power AS p FROM (SELECT *, unnest(range(segment_start_sample // {hop}, (segment_start_sample + length_sample - 1) // {hop} + 1)) AS u FROM pf) q JOIN hops ON hops.file = q.file AND hops.pos = u),
 mx AS (SELECT l_orderkey, spot, sum(p) AS p FROM hp GROUP BY ALL), {gated('lv', 'l_orderkey, event', 'hp', 'hop')}, {gated('ml', 'l_orderkey', 'mx', 'spot')},
 al AS (SELECT pf.*, coalesce(lv.level, '-Infinity'::DOUBLE) AS own, coalesce(ml.level, '-Infinity'::DOUBLE) AS measured, -20.0::DOUBLE - pf.l_orderkey % 7 AS target FROM pf LEFT JOIN lv ON lv.l_orderkey = pf.l_orderkey AND lv.event = pf.event LEFT JOIN ml ON ml.l_orderkey = pf.l_orderkey)
 SELECT l_orderkey, event, file, start_sample, length_sample, segment_start_sample, round(start_sample / {rate}, 9) AS start_seconds, round(length_sample / {rate}, 9) AS length_seconds, round((start_sample + length_sample) / {rate}, 9) AS end_seconds,
 round(own + g, 5) AS lufs, round(measured + g, 5) AS submix_lufs, target AS submix_lufs_target FROM (SELECT *, CASE WHEN isinf(measured) THEN 0 ELSE target - measured END AS g FROM al)"""


@query("event_annotations", _annotation_sql())
def event_annotations(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf)
    targets = events.select("l_orderkey").distinct().withColumn("target", -20.0 - F.col("l_orderkey") % 7)
    out = T.annotate(_placed(spark, sf, "file"), None, _hops(spark, sf), targets, "l_orderkey", _cfg)
    rounded = {c: F.round(c, 9) for c in ("start_seconds", "length_seconds", "end_seconds")} | {c: F.round(c, 5) for c in ("lufs", "submix_lufs")}
    return out.withColumns(rounded)


def _stem_sql() -> str:
    e, rate = ("l_orderkey", "event"), _cfg.rate
    return _timeline_sql().replace(" )\n SELECT k AS l_orderkey, event,", " ),\n pl AS (SELECT k AS l_orderkey, event,", 1) + f"""),
 fs AS (SELECT DISTINCT l_orderkey AS track, l_returnflag AS stem, l_linestatus || (l_linenumber % 3)::VARCHAR AS component, l_partkey AS file FROM lineitem),
 tn AS (SELECT track, row_number() OVER (ORDER BY {u_sql(21, 'tracks', 'track')}, track) - 1 AS slot, count(*) OVER () AS n FROM (SELECT DISTINCT track FROM fs)),
 dr AS (SELECT *, floor({u_sql(21, 'track', *e)} * (SELECT count(*) FROM tn))::BIGINT AS slot FROM pl),
 ch AS (SELECT dr.*, fs.* FROM dr JOIN tn ON tn.slot = dr.slot JOIN fs ON fs.track = tn.track QUALIFY row_number() OVER (PARTITION BY l_orderkey, event, stem, component ORDER BY {u_sql(21, 'file', *e, 'stem', 'component', 'file')}, file) = 1),
 ac AS (SELECT *, -20.0::DOUBLE - l_orderkey % 7 AS target FROM ch QUALIFY row_number() OVER (PARTITION BY l_orderkey, event, stem ORDER BY {u_sql(21, 'component', *e, 'stem', 'component')}, component) <= 1 + floor({u_sql(21, 'active', *e, 'stem')} * count(*) OVER (PARTITION BY l_orderkey, event, stem))),
 cl AS (SELECT *, {quantile_sql(u_sql(21, 'clip', *e))} * 2.0::DOUBLE + target AS clip_lufs FROM ac)
 SELECT l_orderkey, event, track, stem, component, file, start_sample, length_sample, segment_start_sample, round(start_sample / {rate}, 9) AS start_seconds, round(length_sample / {rate}, 9) AS length_seconds, round((start_sample + length_sample) / {rate}, 9) AS end_seconds,
 round(clip_lufs, 6) AS clip_lufs, round({quantile_sql(u_sql(21, 'stem', *e, 'stem', 'component'))} * 1.0::DOUBLE + clip_lufs, 6) AS lufs, target AS submix_lufs_target FROM cl"""


@query("stem_annotations", _stem_sql())
def stem_annotations(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as tracks, their line items as files of stems and components."""
    files = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("track"), F.col("l_returnflag").alias("stem"), F.concat("l_linestatus", (F.col("l_linenumber") % 3).cast("string")).alias("component"), F.col("l_partkey").alias("file"))
    targets = files.select(F.col("track").alias("l_orderkey")).distinct().withColumn("target", -20.0 - F.col("l_orderkey") % 7)
    out = T.stem_events(timeline(spark, sf), files, targets, "l_orderkey", _cfg, 21, 2.0, 1.0)
    rounded = {c: F.round(c, 9) for c in ("start_seconds", "length_seconds", "end_seconds")} | {c: F.round(c, 6) for c in ("clip_lufs", "lufs")}
    return out.withColumns(rounded)


# --- levels ---------------------------------------------------------------------------

SIGNALS = "sg AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)"


def _signals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("x"))


@query("stem_mix", f"WITH {SIGNALS} SELECT label, pos::INT AS pos, round(sum(x), 6) AS x FROM sg GROUP BY ALL")
def stem_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = L.mix(_signals(spark, sf), ["label"], "x", "signal")
    return mixed.select("label", F.posexplode("signal").alias("pos", "x")).withColumn("x", F.round("x", 6))


@query("overlap_add", f"WITH {SIGNALS}, g AS (SELECT DISTINCT label FROM sg), a AS (SELECT label, pos + (vec_id * 7) % 100 AS pos, sum(x) AS x FROM sg GROUP BY ALL) SELECT g.label, p.pos::INT AS pos, round(coalesce(a.x, 0), 6) AS x FROM g CROSS JOIN (SELECT unnest(range(0, 200)) AS pos) p LEFT JOIN a ON a.label = g.label AND a.pos = p.pos")
def overlap_add(spark: SparkSession, sf: str) -> DataFrame:
    placed = _signals(spark, sf).withColumn("start", ((F.col("vec_id") * 7) % 100).cast("int"))
    return L.overlap_add(placed, ["label"], "start", "x", 200).withColumn("x", F.round("x", 6))


@query(
    "peak_rms",
    f"WITH {SIGNALS}, s AS (SELECT vec_id, max(abs(x)) AS m, sum(x * x) / count(*) AS p, sum(CASE WHEN pos < 32 THEN x * x END) / 32 AS p0, sum(CASE WHEN pos >= 32 THEN x * x END) / 32 AS p1 FROM sg GROUP BY vec_id) SELECT vec_id, round(20 * log10(m + 1e-8::DOUBLE), 6) AS peak, round(10 * log10(p + 1e-8::DOUBLE), 6) AS rms, round(10 * log10(p0 + 1e-8::DOUBLE) - 10 * log10(p1 + 1e-8::DOUBLE), 6) AS ratio FROM s",
)
def peak_rms(spark: SparkSession, sf: str) -> DataFrame:
    x = F.col("x")
    return _signals(spark, sf).select("vec_id", F.round(S.peak_db(x), 6).alias("peak"), F.round(S.rms_db(x), 6).alias("rms"), F.round(S.level_ratio_db(F.slice(x, 1, 32), F.slice(x, 33, 32)), 6).alias("ratio"))


#: At 64 samples and 40 a second a clip lasts 1.6 s: blocks of 16 samples in steps of 4.
RATE = 40
GATED = """blk AS (SELECT vec_id, b, sum(x * x) / 16 AS p FROM sg, (SELECT unnest(range(0, 49, 4)) AS b) WHERE pos >= b AND pos < b + 16 GROUP BY ALL),
 ld AS (SELECT *, CASE WHEN p > 0 THEN 10 * log10(p) - 0.691::DOUBLE ELSE '-Infinity'::DOUBLE END AS l FROM blk), g1 AS (SELECT vec_id, avg(p) AS m FROM ld WHERE l > -70 GROUP BY vec_id),
 g2 AS (SELECT ld.vec_id, avg(p) AS m2 FROM ld JOIN g1 ON g1.vec_id = ld.vec_id WHERE l > -70 AND l > 10 * log10(m) - 0.691::DOUBLE - 10 GROUP BY ld.vec_id),
 gl AS (SELECT e.vec_id, CASE WHEN m2 > 0 THEN 10 * log10(m2) - 0.691::DOUBLE ELSE '-Infinity'::DOUBLE END AS level FROM embeddings e LEFT JOIN g2 ON g2.vec_id = e.vec_id)"""


@query("gated_level", f"WITH {SIGNALS}, {GATED} SELECT vec_id, round(level, 6) AS level FROM gl")
def gated_level(spark: SparkSession, sf: str) -> DataFrame:
    return _signals(spark, sf).select("vec_id", F.round(S.gated_level(F.col("x"), RATE), 6).alias("level"))


@query("gated_level_long", f"WITH {SIGNALS}, {GATED} SELECT vec_id, round(level, 6) AS level FROM gl")
def gated_level_long(spark: SparkSession, sf: str) -> DataFrame:
    samples = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "x"))
    return L.gated_levels(samples, ["vec_id"], "pos", "x", RATE).select("vec_id", F.round("level", 6).alias("level"))


@query("gain_scalars", "SELECT vec_id, round(embedding[1]::DOUBLE * pow(10, -6.0::DOUBLE / 20), 9) AS gained, round((embedding[1]::DOUBLE + embedding[2]::DOUBLE) / 2, 9) AS mid, greatest(-70.0::DOUBLE, least(-5.0::DOUBLE, label * 10.0::DOUBLE - 80)) AS clamped FROM embeddings")
def gain_scalars(spark: SparkSession, sf: str) -> DataFrame:
    x = F.col("x")
    mid = S.downmix(x, F.slice(x, 2, 63), "mid")
    return _signals(spark, sf).select("vec_id", F.round(F.get(S.apply_gain(x, F.lit(-6.0)), F.lit(0)), 9).alias("gained"), F.round(F.get(mid, F.lit(0)), 9).alias("mid"), S.clamp_level(F.col("label") * 10.0 - 80).alias("clamped"))


@query("normalize", f"WITH {SIGNALS}, {GATED} SELECT gl.vec_id, round(level, 6) AS measured, round(CASE WHEN level = '-Infinity'::DOUBLE THEN 0 ELSE -23.0::DOUBLE - level END, 6) AS gain, round(embedding[5]::DOUBLE * pow(10, CASE WHEN level = '-Infinity'::DOUBLE THEN 0 ELSE -23.0::DOUBLE - level END / 20), 6) AS fifth FROM gl JOIN embeddings e ON e.vec_id = gl.vec_id")
def normalize(spark: SparkSession, sf: str) -> DataFrame:
    out = L.normalize(_signals(spark, sf), "x", -23.0, RATE)
    return out.select("vec_id", F.round("measured", 6).alias("measured"), F.round("gain", 6).alias("gain"), F.round(F.get("x", F.lit(4)), 6).alias("fifth"))


@query("propagate_gain", "SELECT l_orderkey, l_linenumber, l_partkey, round(-l_discount * 100 + CASE WHEN o_totalprice > 200000 THEN -3 ELSE 2 END, 6) AS lufs FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def propagate_gain(spark: SparkSession, sf: str) -> DataFrame:
    gains = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_totalprice") > 200_000, -3.0).otherwise(2.0).alias("gain"))
    events = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (-F.col("l_discount") * 100).alias("lufs"))
    known = C.known_only(events, gains, "l_orderkey")
    return L.propagate_gain(known, gains, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_partkey", F.round("lufs", 6).alias("lufs"))


@query(
    "master",
    f"""WITH s0 AS (SELECT vec_id, vec_id % 50 AS mixture, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings), sg AS (SELECT mixture AS vec_id, pos, sum(x) AS x FROM s0 GROUP BY ALL), {GATED.replace('embeddings e', '(SELECT DISTINCT vec_id % 50 AS vec_id FROM embeddings) e')}
 SELECT e.vec_id, round(-27.0::DOUBLE - level, 6) AS gain, round(embedding[1]::DOUBLE * pow(10, (-27.0::DOUBLE - level) / 20), 6) AS first FROM embeddings e JOIN gl ON gl.vec_id = e.vec_id % 50""",
)
def master(spark: SparkSession, sf: str) -> DataFrame:
    stems = _signals(spark, sf).withColumn("mixture", F.col("vec_id") % 50)
    return L.master(stems, ["mixture"], "x", -27.0, RATE).select("vec_id", F.round("gain", 6).alias("gain"), F.round(F.get("x", F.lit(0)), 6).alias("first"))


@query("duck", f"WITH {SIGNALS}, p AS (SELECT vec_id, 20 * log10(max(abs(x)) + 1e-8::DOUBLE) AS peak FROM sg GROUP BY vec_id) SELECT p.vec_id, round(least(0.0::DOUBLE, -12.0::DOUBLE - peak), 6) AS duck_gain, round(embedding[1]::DOUBLE * pow(10, least(0.0::DOUBLE, -12.0::DOUBLE - peak) / 20), 6) AS first FROM p JOIN embeddings e ON e.vec_id = p.vec_id")
def duck(spark: SparkSession, sf: str) -> DataFrame:
    return L.duck(_signals(spark, sf), "x", -12.0).select("vec_id", F.round("duck_gain", 6).alias("duck_gain"), F.round(F.get("x", F.lit(0)), 6).alias("first"))


@query("clip_report", f"WITH {SIGNALS}, p AS (SELECT vec_id, label, 20 * log10(max(abs(x)) + 1e-8::DOUBLE) AS peak FROM sg GROUP BY ALL) SELECT vec_id, label, round(peak, 6) AS peak FROM p WHERE peak > -10")
def clip_report(spark: SparkSession, sf: str) -> DataFrame:
    return L.clip_report(_signals(spark, sf), "x", ["vec_id", "label"], -10.0).withColumn("peak", F.round("peak", 6))


# --- splits -----------------------------------------------------------------------------


def _split_sql(forced: str, singles: bool) -> str:
    percent = "CASE WHEN n_all > n_single THEN greatest(0, (n_all * 30 - n_single * 100) // (n_all - n_single)) ELSE 0 END" if singles else "30"
    alone = "n = 1" if singles else "false"
    return f"""WITH g AS (SELECT c_custkey AS speaker, c_mktsegment AS variant, CASE WHEN c_nationkey % 2 = 0 THEN 'f' ELSE 'm' END || CASE WHEN c_custkey % 97 = 0 THEN c_custkey::VARCHAR ELSE '' END AS gender, {forced} AS forced FROM customer),
 s AS (SELECT gender, variant, count(*) AS n FROM g WHERE NOT forced GROUP BY ALL), t AS (SELECT sum(n)::BIGINT AS n_all, sum(CASE WHEN n = 1 THEN 1 ELSE 0 END)::BIGINT AS n_single FROM s),
 r AS (SELECT speaker, n, {alone} AS alone, ({percent}) AS pct, row_number() OVER (PARTITION BY gender, variant ORDER BY {u_sql(13, 'split', 'speaker')}, speaker) AS rank FROM g JOIN s USING (gender, variant), t WHERE NOT forced),
 h AS (SELECT *, (n * pct + 99) // 100 AS held FROM r)
 SELECT speaker, CASE WHEN alone THEN 'test' WHEN rank <= (held * 2 + 2) // 3 THEN 'test' WHEN rank <= held THEN 'val' ELSE 'train' END AS split FROM h UNION ALL SELECT speaker, 'test' FROM g WHERE forced"""


def _speakers(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf, "customer").select(c.alias("speaker"), F.col("c_mktsegment").alias("variant"), F.concat(F.when(F.col("c_nationkey") % 2 == 0, "f").otherwise("m"), F.when(c % 97 == 0, c.cast("string")).otherwise("")).alias("gender"))


@query("split_stratified", _split_sql("false", False))
def split_stratified(spark: SparkSession, sf: str) -> DataFrame:
    return P.group_split(_speakers(spark, sf), "speaker", ["gender", "variant"], 13)


@query("split_forced", _split_sql("c_mktsegment = 'BUILDING'", True))
def split_forced(spark: SparkSession, sf: str) -> DataFrame:
    return P.group_split(_speakers(spark, sf), "speaker", ["gender", "variant"], 13, forced=F.col("variant") == "BUILDING", singletons_to_test=True)


@query("split_unstratified", f"WITH g AS (SELECT c_custkey AS speaker, row_number() OVER (ORDER BY {u_sql(13, 'split', 'c_custkey')}, c_custkey) AS rank, count(*) OVER () AS n FROM customer), h AS (SELECT *, (n * 30 + 99) // 100 AS held FROM g) SELECT speaker, CASE WHEN rank <= (held * 2 + 2) // 3 THEN 'test' WHEN rank <= held THEN 'val' ELSE 'train' END AS split FROM h")
def split_unstratified(spark: SparkSession, sf: str) -> DataFrame:
    return P.threshold_split(_speakers(spark, sf).select("speaker"), "speaker", 13)


@query(
    "split_merged",
    f"""WITH g AS (SELECT o_custkey AS speaker, c_mktsegment AS stratum, bool_or(o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') AS is_test FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
 m AS (SELECT *, CASE stratum WHEN 'FURNITURE' THEN 'rest' WHEN 'MACHINERY' THEN 'rest' ELSE stratum END AS merged FROM g),
 r AS (SELECT speaker, row_number() OVER (PARTITION BY merged ORDER BY {u_sql(14, 'split', 'speaker')}, speaker) AS rank, count(*) OVER (PARTITION BY merged) AS n FROM m WHERE NOT is_test)
 SELECT speaker, CASE WHEN rank <= (n * 10 + 99) // 100 THEN 'val' ELSE 'train' END AS split FROM r UNION ALL SELECT speaker, 'test' FROM m WHERE is_test""",
)
def split_merged(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("speaker"), F.col("c_mktsegment").alias("stratum"))
    files = table(spark, sf, "orders").select(F.col("o_custkey").alias("speaker"), F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P"), "test").otherwise("train").alias("split")).join(c, "speaker")
    return P.merged_split(files, "speaker", "stratum", spark.createDataFrame([("FURNITURE", "rest"), ("MACHINERY", "rest")], "stratum string, merged string"), 14)


@query("split_rows", f"WITH {CLIPS} SELECT doc_id, CASE WHEN split = 'train' AND {u_sql(15, 'row', 'doc_id')} < 0.1::DOUBLE THEN 'val' ELSE split END AS split FROM clips")
def split_rows(spark: SparkSession, sf: str) -> DataFrame:
    return P.row_split(clips(spark, sf), "doc_id", 15, 0.1).select("doc_id", "split")


@query("split_folds", "WITH t AS (SELECT n_nationkey, CASE WHEN bool_or(f = 'val') THEN 'val' WHEN bool_or(f = 'test') THEN 'test' ELSE 'train' END AS split FROM (SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN 'test' ELSE 'train' END AS f FROM nation UNION ALL SELECT n_nationkey, 'val' FROM nation WHERE n_nationkey % 6 = 0) GROUP BY 1) SELECT s_suppkey, split FROM supplier JOIN t ON s_nationkey = n_nationkey")
def split_folds(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    t = n.select("s_nationkey", F.when(F.col("n_regionkey") == 0, "test").otherwise("train").alias("split")).unionByName(n.where("s_nationkey % 6 = 0").select("s_nationkey", F.lit("val").alias("split")))
    return P.fixed_split(table(spark, sf, "supplier"), t, "s_nationkey").select("s_suppkey", "split")


#: The lowest bit of the CRC-32 of a text, bit by bit: each byte is followed by eight shifts.
_ODD_CRC = "list_reduce(list_concat([4294967295], flatten(list_transform(string_split({0}, ''), lambda c: list_concat([ascii(c)::BIGINT], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))), lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END) & 1"
_PROPORTIONS = {"train": 0.7, "val": 0.1, "test": 0.2}
_SPEAKERS = f"""sp AS (SELECT concat_ws('-', c_nationkey::VARCHAR, c_mktsegment) AS corpus, o_custkey::VARCHAR AS speaker, CASE WHEN {_ODD_CRC.format('any_value(c_name)')} = 1 THEN 'female' ELSE 'male' END AS gender, round(sum(o_totalprice), 2) AS duration
 FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_nationkey, c_mktsegment, o_custkey)"""


def _balanced_speakers(spark: SparkSession, sf: str) -> DataFrame:
    """One corpus for each nation and segment, so that each speaker list is short."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.concat_ws("-", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("corpus"), F.when(F.crc32(F.col("c_name")) % 2 == 0, "female").otherwise("male").alias("gender"))
    return table(spark, sf, "orders").join(c, "o_custkey").groupBy("corpus", F.col("o_custkey").cast("string").alias("speaker"), "gender").agg(F.round(F.sum("o_totalprice"), 2).alias("duration"))


@query(
    "split_balanced",
    f"""WITH RECURSIVE {_SPEAKERS}, d AS (SELECT *, row_number() OVER (PARTITION BY corpus, seed ORDER BY {u_sql(0, 'balance', 'seed', 'speaker')}, speaker) AS k, sum(duration) OVER (PARTITION BY corpus, seed) AS total FROM sp, (SELECT unnest(range(0, 8)) AS seed)),
 st AS (SELECT DISTINCT corpus, seed, 0::BIGINT AS k, '' AS split, [{', '.join(f'{p} * total' for p in _PROPORTIONS.values())}]::DOUBLE[] AS need, []::BIGINT[] AS taken FROM d
 UNION ALL SELECT corpus, seed, k, name, list_transform(need, lambda x, i: CASE WHEN i = spot THEN x - duration ELSE x END), list_append(taken, k) FROM (SELECT q.corpus, q.seed, d.k, q.name, q.spot, q.need, q.taken, d.duration,
 row_number() OVER (PARTITION BY q.corpus, q.seed ORDER BY abs(d.duration - q.need[q.spot]), d.k) AS r FROM (SELECT *, ({list(_PROPORTIONS)!r})[spot] AS name FROM (SELECT *, CASE WHEN need[1] >= need[2] AND need[1] >= need[3] THEN CASE WHEN need[2] = need[1] THEN 2 ELSE 1 END WHEN need[2] >= need[3] THEN 2 ELSE 3 END AS spot FROM st)) q
 JOIN d ON d.corpus = q.corpus AND d.seed = q.seed AND NOT list_contains(q.taken, d.k)) WHERE r = 1),
 a AS (SELECT d.*, st.split FROM st JOIN d ON d.corpus = st.corpus AND d.seed = st.seed AND d.k = st.k), own AS (SELECT corpus, seed, split, sum(CASE WHEN gender = 'female' THEN duration ELSE 0 END) AS f, sum(duration) AS t FROM a GROUP BY ALL),
 w AS (SELECT corpus, seed, max(abs(f / t - whole)) AS stray FROM (SELECT *, sum(f) OVER (PARTITION BY corpus, seed) / sum(t) OVER (PARTITION BY corpus, seed) AS whole FROM own) GROUP BY ALL),
 best AS (SELECT corpus, seed, stray <= 0.15 AS accepted FROM w QUALIFY row_number() OVER (PARTITION BY corpus ORDER BY stray > 0.15, CASE WHEN stray <= 0.15 THEN 0 ELSE round(stray, 9) END, seed) = 1)
 SELECT corpus, speaker, split, seed::INT AS seed, accepted FROM a JOIN best USING (corpus, seed)""",
)
def split_balanced(spark: SparkSession, sf: str) -> DataFrame:
    return P.balanced_split(_balanced_speakers(spark, sf), _PROPORTIONS, 0.15, 8)


@query("split_balanced_binned")
def split_balanced_binned(spark: SparkSession, sf: str) -> DataFrame:
    """All customers as one corpus, as large as the table."""
    return P.balanced_split_binned(_balanced_speakers(spark, sf).withColumn("corpus", F.lit("all")), _PROPORTIONS, 0.15, 4)


# --- expectations -------------------------------------------------------------------------


@query(
    "violations",
    f"""WITH {CLIPS} SELECT 'langcode' AS rule, doc_id::VARCHAR AS key, 'subset' AS detail FROM clips WHERE subset IS NULL
 UNION ALL SELECT 'speaker', o_custkey::VARCHAR, count(DISTINCT o_orderpriority)::VARCHAR FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority) > 1
 UNION ALL SELECT 'license', doc_id::VARCHAR, source FROM documents WHERE source NOT IN (SELECT 'src' || n_nationkey FROM nation WHERE n_nationkey < 15)
 UNION ALL SELECT 'size', w.s, coalesce(n, 0)::VARCHAR FROM (VALUES ('F', 86), ('O', 14), ('X', 50)) w(s, want) LEFT JOIN (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1) g ON g.o_orderstatus = w.s WHERE coalesce(n, 0) <> want
 UNION ALL SELECT 'inside', l_orderkey::VARCHAR, (l_linenumber * 10 + l_quantity::BIGINT)::VARCHAR FROM lineitem WHERE l_linenumber * 10 + l_quantity > 100
 UNION ALL SELECT 'finite', doc_id::VARCHAR, NULL FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL
 UNION ALL SELECT 'length', p_partkey::VARCHAR, p_size::VARCHAR FROM part WHERE p_size <> 11
 UNION ALL SELECT 'subset', doc_id::VARCHAR, 'subset' FROM clips WHERE subset IS NULL AND source <> 'src3'
 UNION ALL SELECT 'disjoint', source, count(DISTINCT split)::VARCHAR FROM clips GROUP BY source HAVING count(DISTINCT split) > 1""",
)
def violations(spark: SparkSession, sf: str) -> DataFrame:
    """Each table is scanned once for all of its rules."""
    known = table(spark, sf, "nation").where("n_nationkey < 15").select(F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("source"), F.lit(True).alias("known"))
    c = C.enrich(C.enrich(clips(spark, sf), table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("quality")), "doc_id"), C.small(known), "source")
    no_subset = Q.missing_value("subset", "doc_id", "subset")
    documents = Q.check(
        c, Q.missing_value("subset", "doc_id", "langcode"), Q.RowRule("license", F.col("known").isNull() & F.col("source").isNotNull(), F.col("doc_id"), F.col("source")), Q.not_finite("quality", "doc_id"),
        Q.RowRule("subset", no_subset.fails & ~F.col("source").eqNullSafe("src3"), no_subset.key, no_subset.detail), Q.OneRule("disjoint", F.col("source"), F.col("split")),
    )
    orders = Q.check(table(spark, sf, "orders"), Q.OneRule("speaker", F.col("o_custkey"), F.col("o_orderpriority")), Q.SizeRule("size", F.col("o_orderstatus"), {"F": 86, "O": 14, "X": 50}))
    lines = Q.check(table(spark, sf, "lineitem"), Q.not_inside("l_orderkey", F.col("l_linenumber") * 10, F.col("l_quantity").cast("bigint"), 100))
    return Q.violations(documents, orders, lines, Q.check(table(spark, sf, "part"), Q.other_length("p_size", 11, "p_partkey")))


# --- sources and sinks ------------------------------------------------------------------------


@query("json_props", "SELECT event_id, event_type, (props::JSON ->> 'k')::INT AS k FROM events")
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_type", F.concat(F.lit('{"'), F.col("event_id").cast("string"), F.lit('": '), "props", F.lit("}")).alias("keyed"))
    typed = e.select("event_type", "keyed")
    out = M.explode_keyed_json(typed.select("keyed"), "keyed", "k: int", "event_id").withColumn("event_id", F.col("event_id").cast("bigint"))
    return out.join(table(spark, sf, "events").select("event_id", "event_type"), "event_id").select("event_id", "event_type", "k")


@query("stem_json", "SELECT l_orderkey AS track, l_returnflag AS stem, l_partkey::VARCHAR AS component, l_linestatus = 'O' AS has_bleed FROM lineitem")
def stem_json(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.collect_list(F.struct(F.col("l_partkey").cast("string").alias("id"), (F.col("l_linestatus") == "O").alias("has_bleed"))).alias("tracks"))
    nested = rows.groupBy(F.col("l_orderkey").alias("track")).agg(F.to_json(F.collect_list(F.struct(F.col("l_returnflag").alias("stemName"), "tracks"))).alias("j"))
    parsed = nested.select("track", F.from_json("j", "array<struct<stemName: string, tracks: array<struct<id: string, has_bleed: boolean>>>>").alias("stems"))
    return M.explode_stems(parsed)


@query("path_columns", "WITH p AS (SELECT page_id, string_split(url, '/') AS parts FROM pages) SELECT page_id, CASE WHEN len(parts) >= 3 THEN parts[-3] END AS host, CASE WHEN len(parts) >= 2 THEN parts[-2] END AS lang, parts[-1] AS page FROM p")
def path_columns(spark: SparkSession, sf: str) -> DataFrame:
    return M.path_columns(table(spark, sf, "pages").select("page_id", "url"), "url", ["host", "lang", "page"]).drop("url")


@query("failed_split", f"WITH {CLIPS} SELECT doc_id, coalesce(subset, 'none') AS subset, split || CASE WHEN quality IS NULL THEN '_failed' ELSE '' END AS split FROM clips LEFT JOIN labels USING (doc_id)")
def failed_split(spark: SparkSession, sf: str) -> DataFrame:
    """Written by subset and split and read back."""
    c = C.enrich(clips(spark, sf).select("doc_id", F.coalesce("subset", F.lit("none")).alias("subset"), "split"), table(spark, sf, "labels"), "doc_id")
    folder = fresh(spark, "manifest")
    M.write_manifest(M.split_failed(c, "quality"), folder)
    return spark.read.schema("doc_id bigint, quality int, toxic int, subset string, split string").parquet(folder).select("doc_id", "subset", "split")


_submix = "CASE l_returnflag WHEN 'N' THEN 'mixture' WHEN 'R' THEN 'music_sfx' ELSE 'speech' END"


@query(
    "annotation_sink",
    f"""SELECT 'annotation' AS kind, l_orderkey AS idx, {_submix} AS submix, l_partkey AS file, 'default' AS subset, l_linestatus AS split FROM lineitem WHERE l_returnflag = 'A'
 UNION ALL SELECT DISTINCT 'signal', l_orderkey, {_submix}, NULL::BIGINT, 'default', l_linestatus FROM lineitem WHERE l_returnflag <> 'N'""",
)
def annotation_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Annotations written by subset and split and read back, and the signals that are put out without the mixture."""
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("idx"), F.expr(_submix).alias("submix"), F.col("l_partkey").alias("file"), F.lit("default").alias("subset"), F.col("l_linestatus").alias("split"))
    folder = fresh(spark, "annotations")
    M.write_annotations(rows, folder, ["music_sfx"])
    stems = spark.read.schema("idx bigint, submix string, file bigint, subset string, split string").parquet(folder).withColumn("kind", F.lit("annotation"))
    signals = M.outputs(rows, ["idx", "subset", "split"], output_mixture=False).withColumns({"kind": F.lit("signal"), "file": F.lit(None).cast("bigint")})
    return stems.unionByName(signals)


@query("file_inventory", f"WITH {CLIPS} SELECT coalesce(subset, 'none') AS subset, split, 'clips' AS corpus, count(*) AS n FROM clips GROUP BY ALL")
def file_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Clips by folder of a written manifest: the files that are listed, with the rows that should be in them."""
    c = clips(spark, sf).select("doc_id", F.coalesce("subset", F.lit("none")).alias("subset"), "split")
    folder = fresh(spark, "inventory")
    M.write_manifest(c, folder)
    found = M.path_columns(M.inventory(spark, folder, "*.parquet", {"corpus": "clips"}).where("length > 0"), "path", ["subset", "split", "file"])
    part = lambda name: F.regexp_replace(name, f"^{name}=", "").alias(name)
    return c.groupBy("subset", "split").agg(F.count("*").alias("n")).join(found.select(part("subset"), part("split"), "corpus").distinct(), ["subset", "split"])


@query("csv_dialects", "SELECT c_custkey AS id, c_name AS name, c_nationkey AS region, d AS dialect FROM customer, (VALUES ('csv'), ('pipe'), ('semicolon'), ('space'), ('tab')) t(d)")
def csv_dialects(spark: SparkSession, sf: str) -> DataFrame:
    """The customer table written and read in each dialect; each tab file carries three header rows that are skipped."""
    n = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("region"))
    # as many files as the session has shuffle partitions
    out, parts = None, int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, options in M.DIALECTS.items():
        folder = fresh(spark, f"csv-{name}")
        skipped = 3 if name == "tab" else 0
        if skipped:
            lines = n.select(F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("place"), F.concat_ws("\t", F.col("id").cast("string"), "name", F.col("region").cast("string")).alias("value"))
            head = spark.range(parts).select(F.col("id").cast("int").alias("part"), F.lit(0).alias("place"), F.explode(F.array(F.lit("# speakers"), F.lit("# made by us"), F.lit("id\tname\tregion"))).alias("value"))
            head.unionByName(lines).repartitionById(parts, F.col("part")).sortWithinPartitions("place").select("value").write.text(folder)
        else:
            n.write.options(**options).csv(folder)
        one = M.read_manifest(spark, folder, "id bigint, name string, region int", name, skipped).withColumn("dialect", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("stream_ingest", f"WITH {CLIPS} SELECT file AS cleaned_path, CASE WHEN doc_id % 2 = 0 THEN 'CC BY 4.0' ELSE 'CC BY-NC 4.0' END AS license, CASE WHEN doc_id % 2 = 0 THEN 'com' ELSE 'nc' END AS license_usage, split FROM clips")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """A table that holds the validation rows, then two batches of manifest files that repeat them and each other: each path is stored once."""
    source, target, checkpoint = (fresh(spark, f"stream-{k}") for k in ("in", "out", "checkpoint"))
    urls = spark.createDataFrame(URLS, "url string, license string, license_family string")
    flags = spark.createDataFrame(FLAGS, "license_family string, attribution boolean, commercial boolean, derivative boolean, share_alike boolean")
    rows = clips(spark, sf).select(F.col("file").alias("cleaned_path"), F.when(F.col("doc_id") % 2 == 0, URLS[0][0]).otherwise(URLS[1][0]).alias("license_url"), "split")
    M.store_new(C.resolve_license(rows.where("split = 'val'"), urls, flags), target, "cleaned_path")
    for part in (rows.where("split <> 'test'"), rows.where("split <> 'train'")):
        part.write.mode("append").option("header", "true").csv(source)
        ingest(spark, source, "cleaned_path string, license_url string, split string", urls, flags, target, checkpoint).awaitTermination()
    return spark.read.parquet(target).select("cleaned_path", "license", "license_usage", "split")
