"""Queries of curation, joins, sets and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemfold.functions import scalars as S
from stemfold.operators import curate as C
from stemfold.operators import stats as A
from stemfold.plans.registry import CLIPS, SQL, clips, query, table
from stemfold.sources.scratch import bucketed

# --- fixed values: the small dimensions that queries look things up in ---
FAMILIES = [("germanic", ["eng", "deu"], 500_000_000), ("romance", ["fra", "spa"], 700_000)]
URLS = [
    ("http://example.org/by/4.0", "CC BY 4.0", "CC-BY"), ("http://example.org/by-nc/4.0", "CC BY-NC 4.0", "CC-BY-NC"), ("https://example.org/by-nc-nd/4.0", "CC BY-NC-ND 4.0", "CC-BY-NC-ND"),
    ("http://example.org/sa/1.0", "CC BY-SA 1.0", "CC-BY-SA"), ("http://example.org/sampling", "Sampling+", "unclear"),
]
FLAGS = [("CC-BY", True, True, True, False), ("CC-BY-NC", True, False, True, False), ("CC-BY-NC-ND", True, False, False, False), ("CC-BY-SA", True, True, True, True), ("unclear", None, None, None, None)]
LABELS = {"click": "foreground", "purchase": "foreground", "view": "background", "error": "unusable"}


def _values(rows: list[tuple]) -> str:
    one = lambda v: "NULL" if v is None else str(v).upper() if isinstance(v, bool) else repr(v)
    return "(VALUES " + ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows) + ")"


MEMBERS = _values([(f, m, n) for f, ms, n in FAMILIES for m in ms])


@query(
    "language_balance",
    f"""WITH {CLIPS}, m AS (SELECT * FROM {MEMBERS} t(language_family, langcode, users)), k AS (SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN langcode END AS langcode FROM clips),
 tagged AS (SELECT doc_id, c.langcode, coalesce(m.language_family, c.langcode) AS language_family, greatest(coalesce(users::DOUBLE, 0.0), 1000000.0::DOUBLE) AS sample_users FROM k c LEFT JOIN m ON c.langcode = m.langcode),
 f AS (SELECT language_family, sample_users, count(*) AS n_files FROM tagged GROUP BY ALL)
 SELECT doc_id, langcode, tagged.language_family, tagged.sample_users, n_files, round(f.sample_users / n_files / (SELECT sum(sample_users) FROM f), 12) AS sample_prob FROM tagged JOIN f ON tagged.language_family IS NOT DISTINCT FROM f.language_family""",
)
def language_balance(spark: SparkSession, sf: str) -> DataFrame:
    """Every eleventh clip has no language code."""
    families = spark.createDataFrame(FAMILIES, "language_family string, members array<string>, users bigint")
    coded = clips(spark, sf).select("doc_id", F.when(F.col("doc_id") % 11 != 0, F.col("langcode")).alias("langcode"))
    out = C.sampling_probability(coded, families)
    return out.select("doc_id", "langcode", "language_family", "sample_users", "n_files", F.round("sample_prob", 12).alias("sample_prob"))


@query("uniform_probability", "SELECT c_custkey, round(1.0::DOUBLE / (SELECT count(*) FROM customer), 12) AS sample_prob FROM customer")
def uniform_probability(spark: SparkSession, sf: str) -> DataFrame:
    return C.uniform_probability(table(spark, sf, "customer").select("c_custkey")).withColumn("sample_prob", F.round("sample_prob", 12))


@query("by_duration", f"WITH {CLIPS} SELECT doc_id, duration FROM clips ORDER BY duration DESC")
def by_duration(spark: SparkSession, sf: str) -> DataFrame:
    return C.by_duration(clips(spark, sf).select("doc_id", "duration"))


@query(
    "clean_annotations",
    """SELECT '$CLEANED_DATA_ROOT/' || p_type || '/' || p_partkey || '.flac' AS raw_path, l_orderkey * 7 AS start_time_sample, (l_quantity * 48000)::BIGINT AS segment_duration_sample, l_suppkey AS segment_start_offset_sample,
 -l_discount AS event_premaster_lufs, -l_tax AS track_premaster_lufs FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def clean_annotations(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("/mnt/cleaned/"), "p_type", F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".flac")).alias("file"))
    rows = table(spark, sf, "lineitem").join(files, F.col("l_partkey") == F.col("p_partkey"))
    made = rows.select("file", (F.col("l_orderkey") * 7).alias("start_sample"), (F.col("l_quantity") * 48000).cast("bigint").alias("length_sample"), F.col("l_suppkey").alias("segment_start_sample"), (-F.col("l_discount")).alias("lufs"), (-F.col("l_tax")).alias("submix_lufs"))
    return C.clean_annotations(made, "/mnt/cleaned", "$CLEANED_DATA_ROOT")


@query(
    "subset_filters",
    f"""WITH {CLIPS}, s AS (SELECT *, CASE doc_id % 4 WHEN 0 THEN 'small' WHEN 1 THEN 'medium' WHEN 2 THEN 'large' ELSE 'full' END AS size FROM clips)
 SELECT doc_id, source, size, coalesce(subset, 'nc') AS subset FROM s WHERE size IN ('small', 'medium', 'large') AND coalesce(subset, CASE WHEN source = 'src3' THEN 'nc' END) = 'nc' AND source NOT IN ('src1')
 UNION ALL SELECT doc_id, source, size, coalesce(subset, 'nd') FROM s WHERE size IN ('small', 'medium', 'large', 'full') AND coalesce(subset, CASE WHEN source = 'src3' THEN 'nd' END) = 'nd' AND source NOT IN ('src1')""",
)
def subset_filters(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("doc_id") % 4
    s = clips(spark, sf).withColumn("size", F.when(d == 0, "small").when(d == 1, "medium").when(d == 2, "large").otherwise("full"))
    one = lambda subset, size: C.keep(C.size_at_most(C.select_subset(s, subset, "src3"), size), "source", [], ["src1"]).select("doc_id", "source", "size", "subset")
    return one("nc", "large").unionByName(one("nd", "full"))


@query(
    "duration_gate",
    f"""WITH {CLIPS}, g AS (SELECT c.doc_id, duration, quality, toxic FROM clips c LEFT JOIN labels l ON c.doc_id = l.doc_id WHERE duration BETWEEN 2 AND 60 AND round_even(duration * 25.0 / 1000.0 * 100, 0) >= 10 AND c.doc_id % 5 IN (0, 4))
 SELECT doc_id, duration FROM g WHERE duration < 5 OR (duration >= 5 AND quality = 1)""",
)
def duration_gate(spark: SparkSession, sf: str) -> DataFrame:
    tagged = C.enrich(clips(spark, sf).select("doc_id", "duration"), table(spark, sf, "labels"), "doc_id")
    # rates as the files' headers would give them: unreadable, unknown, low, and two that pass
    rate = F.element_at(F.array(F.lit(44_100), F.lit(-1), F.lit(None).cast("int"), F.lit(22_050), F.lit(48_000)), (F.col("doc_id") % 5 + 1).cast("int"))
    rated = C.min_rate(tagged.withColumn("sampling_rate", rate)).withColumn("bit_rate", F.col("duration") * 25.0 * 100)
    passed = C.min_bitrate(rated, 10)
    return C.duration_gate(passed, 2, 60, 5, F.col("quality") == 1).select("doc_id", "duration")


@query(
    "majority_active",
    """WITH a AS (SELECT user_id, avg(CASE WHEN greatest(CASE WHEN event_type = 'click' THEN value / 100 ELSE 0 END, CASE WHEN event_type = 'view' THEN value / 60 ELSE 0 END) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS active FROM events GROUP BY user_id)
 SELECT user_id, round(active, 9) AS active FROM a WHERE active <= 0.5""",
)
def majority_active(spark: SparkSession, sf: str) -> DataFrame:
    frames = table(spark, sf, "events").select("user_id", F.when(F.col("event_type") == "click", F.col("value") / 100).otherwise(0.0).alias("speech"), F.when(F.col("event_type") == "view", F.col("value") / 60).otherwise(0.0).alias("music"))
    return C.drop_majority_active(frames, "user_id", ["speech", "music"]).select("user_id", F.round("active", 9).alias("active"))


@query("class_filter", "SELECT event_id, event_type AS class, value FROM events WHERE event_type = 'purchase'")
def class_filter(spark: SparkSession, sf: str) -> DataFrame:
    return C.class_filter(table(spark, sf, "events").select("event_id", F.col("event_type").alias("class"), "value"), "purchase")


@query(
    "blocklist_split",
    f"""WITH {CLIPS}, b AS (SELECT DISTINCT source FROM documents WHERE n_chars > 15000)
 SELECT doc_id, CASE WHEN c.source IN (SELECT source FROM b) THEN split || '_blocked' ELSE split END AS split, length(c.text) > 300 AS has_bleed FROM clips c WHERE NOT (length(c.text) <= 300) AND subset IS NOT NULL AND doc_id % 6 <> 1""",
)
def blocklist_split(spark: SparkSession, sf: str) -> DataFrame:
    blocked = table(spark, sf, "documents").where("n_chars > 15000").select("source")
    c = clips(spark, sf).withColumn("has_bleed", F.length("text") <= 300)
    c = c.withColumn("file", F.when(F.col("doc_id") % 6 == 1, F.regexp_replace("file", "/clip_", "/.clip_")).otherwise(F.col("file")))  # some are hidden
    c = C.drop_failed(C.drop_hidden(C.drop_bleed(c), "file"), "subset")
    return C.flag_blocked(c, blocked, "source").select("doc_id", "split", (~F.col("has_bleed")).alias("has_bleed"))


@query("enrich_left", "SELECT o_orderkey, o_custkey, c_mktsegment, coalesce(c_mktsegment, 'missing') AS segment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey")
def enrich_left(spark: SparkSession, sf: str) -> DataFrame:
    dim = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return C.enrich(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), dim, "o_custkey").select("o_orderkey", "o_custkey", "c_mktsegment", F.coalesce("c_mktsegment", F.lit("missing")).alias("segment"))


@query("enrich_inner", "SELECT doc_id, source, quality, toxic FROM documents JOIN labels USING (doc_id)")
def enrich_inner(spark: SparkSession, sf: str) -> DataFrame:
    return C.enrich(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), "doc_id", "inner")


@query("unmatched_keys", "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unmatched_keys(spark: SparkSession, sf: str) -> DataFrame:
    return C.unmatched_keys(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


_url_sql = "CASE doc_id % 6 WHEN 0 THEN 'https://example.org/by/4.0' WHEN 1 THEN 'http://example.org/by-nc/4.0' WHEN 2 THEN 'http://example.org/by-nc-nd/4.0' WHEN 3 THEN 'https://example.org/sa/1.0' WHEN 4 THEN 'http://example.org/sampling' ELSE 'http://example.org/none' END"
LICENSED = f"""u AS (SELECT replace(url, 'https://', 'http://') AS url, license, license_family FROM {_values(URLS)} t(url, license, license_family)), f AS (SELECT * FROM {_values(FLAGS)} t(license_family, attribution, commercial, derivative, share_alike)),
 x AS (SELECT doc_id, source, {_url_sql} AS license_url FROM documents),
 licensed AS (SELECT doc_id, source, license_url, coalesce(license, 'missing') AS license, coalesce(u.license_family, 'missing') AS license_family, attribution, commercial, derivative, share_alike,
 CASE WHEN NOT coalesce(derivative, false) THEN 'nd' WHEN NOT coalesce(commercial, false) THEN 'nc' ELSE 'com' END AS license_usage FROM x LEFT JOIN u ON replace(license_url, 'https://', 'http://') = u.url LEFT JOIN f ON u.license_family = f.license_family)"""


def licensed(spark: SparkSession, sf: str) -> DataFrame:
    urls = ["https://example.org/by/4.0", "http://example.org/by-nc/4.0", "http://example.org/by-nc-nd/4.0", "https://example.org/sa/1.0", "http://example.org/sampling", "http://example.org/none"]
    d = table(spark, sf, "documents").select("doc_id", "source", F.get(F.array(*[F.lit(x) for x in urls]), (F.col("doc_id") % 6).cast("int")).alias("license_url"))
    return C.resolve_license(d, spark.createDataFrame(URLS, "url string, license string, license_family string"), spark.createDataFrame(FLAGS, "license_family string, attribution boolean, commercial boolean, derivative boolean, share_alike boolean"))


@query("license_usage", f"WITH {LICENSED} SELECT doc_id, license, license_family, license_usage, commercial, derivative FROM licensed")
def license_usage(spark: SparkSession, sf: str) -> DataFrame:
    return licensed(spark, sf).select("doc_id", "license", "license_family", "license_usage", "commercial", "derivative")


_names = ["CC BY-NC 4.0", "MIT License", "Licence Art Libre", "CC BY-SA-ND 3.0", "All rights reserved", "Creative Commons BY (attribution) NC (Pas de commerce)", "Creative Commons NC (Pas de commerce)", "CC0 1.0", "com", None]


@query(
    "license_names",
    f"""WITH x AS (SELECT doc_id, ({_names!r})[1 + doc_id % {len(_names)}] AS name FROM documents), n AS (SELECT *, '-' || regexp_replace(upper(coalesce(name, '')), '[^A-Z0-9.]+', '-', 'g') || '-' AS n FROM x),
 k AS (SELECT *, CASE WHEN contains(n, '-CC-') OR contains(n, '-CREATIVE-COMMONS-') THEN CASE WHEN contains(n, '-BY-') THEN 'cc' ELSE 'unclear' END WHEN contains(n, '-ART-LIBRE-') THEN 'free' END AS kind FROM n),
 g AS (SELECT doc_id, name, kind, CASE kind WHEN 'free' THEN true WHEN 'cc' THEN true END AS attribution, CASE kind WHEN 'free' THEN true WHEN 'cc' THEN NOT contains(n, '-NC-') END AS commercial, CASE kind WHEN 'free' THEN true WHEN 'cc' THEN NOT contains(n, '-ND-') END AS derivative, CASE kind WHEN 'free' THEN true WHEN 'cc' THEN contains(n, '-SA-') END AS share_alike FROM k)
 SELECT doc_id, name, attribution, commercial, derivative, share_alike, CASE kind WHEN 'free' THEN 'Art Libre' WHEN 'unclear' THEN 'Unclear CC License' WHEN 'cc' THEN concat_ws('-', 'CC', 'BY', CASE WHEN NOT commercial THEN 'NC' END, CASE WHEN NOT derivative THEN 'ND' END, CASE WHEN share_alike THEN 'SA' END) END AS canonical,
 CASE WHEN NOT coalesce(derivative, false) THEN 'nd' WHEN NOT coalesce(commercial, false) THEN 'nc' ELSE 'com' END AS license_usage FROM g""".replace("None", "NULL"),
)
def license_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names that are of no open licence, or do not say enough, grant nothing."""
    name = F.element_at(F.array(*[F.lit(x) for x in _names]), (F.col("doc_id") % len(_names) + 1).cast("int"))
    named = table(spark, sf, "documents").select("doc_id", name.alias("name"))
    flags = named.withColumn("f", S.license_flags(F.col("name")))
    return flags.select("doc_id", "name", "f.*", S.license_name(F.col("name")).alias("canonical"), S.usage_class(F.col("f.commercial"), F.col("f.derivative")).alias("license_usage"))


@query("missing_outputs", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def missing_outputs(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return C.missing_outputs(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), done, "l_orderkey")


@query("semi_known", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def semi_known(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return C.known_only(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), keys, "l_orderkey")


@query("resume_antijoin", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def resume_antijoin(spark: SparkSession, sf: str) -> DataFrame:
    from stemfold.sources.manifests import todo

    return todo(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").where("quality = 1").select("doc_id"), "doc_id")


@query("precomputed_lookup", "SELECT o_orderstatus AS split, o_orderkey AS idx, p.n_lines, p.total FROM orders LEFT JOIN (SELECT o_orderstatus AS split, l_orderkey AS idx, count(*) AS n_lines, round(sum(l_quantity), 6) AS total FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL) p ON p.split = o_orderstatus AND p.idx = o_orderkey")
def precomputed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    plan = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("split"), F.col("o_orderkey").alias("idx"))
    made = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("idx"), "l_quantity").join(plan, "idx").groupBy("split", "idx").agg(F.count("*").alias("n_lines"), F.round(F.sum("l_quantity"), 6).alias("total"))
    return C.with_precomputed(plan, made)


@query("bucketed_lookup", SQL["precomputed_lookup"])
def bucketed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """precomputed_lookup on tables that were written in buckets of (split, idx): the join shuffles neither."""
    key, buckets = ["split", "idx"], int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = bucketed(table(spark, sf, "orders").select(F.col("o_orderstatus").alias("split"), F.col("o_orderkey").alias("idx")), key, buckets, "plan")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("idx"), "l_quantity").join(plan, "idx")
    made = bucketed(lines.groupBy(*key).agg(F.count("*").alias("n_lines"), F.round(F.sum("l_quantity"), 6).alias("total")), key, buckets, "precomputed")
    return C.with_precomputed(plan, made.hint("merge"))


@query(
    "assign_split",
    "WITH m AS (SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN 'test' WHEN n_regionkey = 1 THEN 'val' ELSE 'train' END AS split FROM nation) SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'CONSTRUCTION' WHEN 'HOUSEHOLD' THEN 'HOME' ELSE c_mktsegment END AS c_mktsegment, split FROM customer JOIN m ON c_nationkey = n_nationkey",
)
def assign_split(spark: SparkSession, sf: str) -> DataFrame:
    r = F.col("n_regionkey")
    m = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.when(r == 0, "test").when(r == 1, "val").otherwise("train").alias("split"))
    wrong = spark.createDataFrame([("BUILDING", "CONSTRUCTION"), ("HOUSEHOLD", "HOME")], "wrong string, right string")
    return C.correct_names(C.assign_split(table(spark, sf, "customer"), m, "c_nationkey"), wrong, "c_mktsegment").select("c_custkey", "c_mktsegment", "split")


@query(
    "clone_submix",
    """WITH plan AS (SELECT 'default' AS subset, o_orderstatus AS split, o_orderkey AS idx FROM orders WHERE o_orderpriority < '3'), prior AS (SELECT 'default' AS subset, o_orderstatus AS split, l_orderkey AS idx, l_returnflag AS submix, l_partkey AS file, l_quantity AS len FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
 SELECT subset, split, idx, submix, file, len FROM prior JOIN plan USING (subset, split, idx) WHERE submix = 'A' UNION ALL SELECT subset, split, idx, NULL, NULL, NULL FROM plan WHERE NOT EXISTS (SELECT 1 FROM prior WHERE prior.submix = 'A' AND prior.idx = plan.idx AND prior.split = plan.split)""",
)
def clone_submix(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    base = [F.lit("default").alias("subset"), F.col("o_orderstatus").alias("split"), F.col("o_orderkey").alias("idx")]
    plan = o.where("o_orderpriority < '3'").select(*base)
    prior = table(spark, sf, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(*base, F.col("l_returnflag").alias("submix"), F.col("l_partkey").alias("file"), F.col("l_quantity").alias("len"))
    found, missing = C.clone_submix(plan, prior, "A")
    return C.union_manifests(found, missing)


@query(
    "subset_fallback",
    """WITH v AS (SELECT o_custkey AS idx, CASE o_orderpriority WHEN '1-URGENT' THEN 'com' WHEN '2-HIGH' THEN 'nc' ELSE 'default' END AS subset, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL), s AS (SELECT * FROM (VALUES ('com'), ('nc')) t(subset))
 SELECT k.idx, s.subset, coalesce(own.total, base.total) AS total FROM (SELECT DISTINCT idx FROM v) k CROSS JOIN s LEFT JOIN v own ON own.idx = k.idx AND own.subset = s.subset LEFT JOIN v base ON base.idx = k.idx AND base.subset = 'default'""",
)
def subset_fallback(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("o_orderpriority")
    v = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("idx"), F.when(p == "1-URGENT", "com").when(p == "2-HIGH", "nc").otherwise("default").alias("subset")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    names = C.subset_names(v)
    return C.subset_or_default(v, names, ["idx"], "total")


@query("value_counts", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return A.value_counts(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query(
    "split_grouping_sets",
    "WITH f AS (SELECT o_orderstatus AS split, c_mktsegment AS variant, CASE WHEN c_nationkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender, o_custkey FROM orders JOIN customer ON o_custkey = c_custkey) SELECT split, gender, variant, count(*) AS n_files, count(DISTINCT o_custkey) AS n_speakers FROM f WHERE split IS NOT NULL GROUP BY split, gender, variant UNION ALL SELECT split, NULL, NULL, count(*), count(DISTINCT (gender, variant, o_custkey)) FROM f GROUP BY split UNION ALL SELECT NULL, NULL, NULL, count(*), (SELECT count(*) FROM (SELECT DISTINCT split, gender, variant, o_custkey FROM f)) FROM f",
)
def split_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("variant"), F.when(F.col("c_nationkey") % 2 == 0, "female").otherwise("male").alias("gender"))
    files = table(spark, sf, "orders").select("o_custkey", F.col("o_orderstatus").alias("split")).join(c, "o_custkey")
    return A.split_distribution(files, "o_custkey", "gender", "variant")


@query("hours_usable", f"WITH {CLIPS} SELECT source, round(sum(duration) / 3600, 9) AS hours, round(sum(CASE WHEN duration >= 10 THEN duration ELSE 0 END) / 3600, 9) AS usable_hours FROM clips GROUP BY source")
def hours_usable(spark: SparkSession, sf: str) -> DataFrame:
    return A.hours(clips(spark, sf), "source", usable=F.col("duration") >= 10).select("source", F.round("hours", 9).alias("hours"), F.round("usable_hours", 9).alias("usable_hours"))


@query(
    "hours_by_accent",
    "WITH p AS (SELECT '/data/' || CASE WHEN doc_id % 3 = 0 THEN 'esw' ELSE 'esa' END || '/' || lang || doc_id || '.wav' AS path, n_chars / 100.0::DOUBLE AS duration FROM documents) SELECT CASE WHEN contains(path, 'esw') THEN 'es-es' ELSE 'es-ar' END AS spanish, substr(string_split(path, '/')[-1], 1, 2) AS british, round(sum(duration) / 3600, 9) AS hours FROM p GROUP BY ALL",
)
def hours_by_accent(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat(F.lit("/data/"), F.when(F.col("doc_id") % 3 == 0, "esw").otherwise("esa"), F.lit("/"), "lang", F.col("doc_id").cast("string"), F.lit(".wav"))
    files = table(spark, sf, "documents").select(path.alias("path"), (F.col("n_chars") / 100.0).alias("duration"))
    p = F.col("path")
    return A.hours(files, S.accent(p, "es-ar").alias("spanish"), S.accent(p, "british").alias("british")).select("spanish", "british", F.round("hours", 9).alias("hours"))


@query("speaker_durations", "SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender, o_custkey AS speaker, round(sum(o_totalprice), 4) AS duration, count(*) AS n_files FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def speaker_durations(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("speaker"), F.when(F.col("c_nationkey") % 2 == 0, "female").otherwise("male").alias("gender"))
    files = table(spark, sf, "orders").select(F.col("o_custkey").alias("speaker"), F.col("o_totalprice").alias("duration")).join(c, "speaker")
    return A.speaker_durations(files, "gender", "speaker").select("gender", "speaker", F.round("duration", 4).alias("duration"), "n_files")


@query("distinct_speakers", "SELECT c_mktsegment, count(DISTINCT o_custkey) AS n_speakers FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def distinct_speakers(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return A.distinct_speakers(files, "o_custkey", "c_mktsegment")


@query(
    "license_summary",
    f"""WITH {LICENSED} SELECT license_family, CASE WHEN license_family IN ('missing') OR contains(lower(license_family), 'unclear') THEN '?' WHEN contains(lower(license_family), 'nc') THEN 'N' ELSE 'Y' END AS commercial,
 CASE WHEN license_family IN ('missing') OR contains(lower(license_family), 'unclear') THEN '?' WHEN contains(lower(license_family), 'nd') THEN 'N' ELSE 'Y' END AS derivative, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM licensed), 9) AS percent FROM licensed GROUP BY license_family""",
)
def license_summary(spark: SparkSession, sf: str) -> DataFrame:
    return A.license_summary(licensed(spark, sf)).withColumn("percent", F.round("percent", 9))


@query("describe", "SELECT event_type, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max FROM events GROUP BY event_type")
def describe(spark: SparkSession, sf: str) -> DataFrame:
    out = A.describe(table(spark, sf, "events"), F.col("value"), "event_type")
    return out.select("event_type", "count", *[F.round(c, 6).alias(c) for c in ("mean", "std")], "min", *[F.round(c, 6).alias(c) for c in ("q25", "q50", "q75")], "max")


@query("failure_rate", f"WITH {CLIPS} SELECT split, source, round(avg(CASE WHEN quality IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 9) AS failure_rate, count(*) AS n FROM clips LEFT JOIN labels USING (doc_id) GROUP BY ALL")
def failure_rate(spark: SparkSession, sf: str) -> DataFrame:
    return A.failure_rate(C.enrich(clips(spark, sf), table(spark, sf, "labels"), "doc_id"), "quality", "split", "source").withColumn("failure_rate", F.round("failure_rate", 9))


@query("histogram", "SELECT (round_even(n_chars / 1000.0::DOUBLE, 0) * 1000)::BIGINT AS bin, count(*) AS n FROM documents GROUP BY ALL")
def histogram(spark: SparkSession, sf: str) -> DataFrame:
    return A.rounded_histogram(table(spark, sf, "documents"), "n_chars")


@query("stem_tree", "SELECT l_orderkey, l_returnflag AS stem_group, l_linestatus AS stem, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_partkey::VARCHAR COLLATE C) AS paths FROM lineitem GROUP BY ALL".replace(" COLLATE C", ""))
def stem_tree(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("grp"), F.col("l_linestatus").alias("stem"), F.col("l_partkey").cast("string").alias("path"))
    return A.flat_tree(A.stem_tree(rows, "l_orderkey", "grp", "stem", "path"), "l_orderkey")


@query("substems", "SELECT l_returnflag, array_to_string(list_sort(list(DISTINCT l_linenumber::VARCHAR)), ',') AS substems, concat_ws(',', CASE WHEN bool_or(l_linenumber = 7) THEN '7' END, CASE WHEN bool_or(l_linenumber = 2) THEN '2' END, CASE WHEN bool_or(l_linenumber = 9) THEN '9' END) AS present FROM lineitem GROUP BY ALL")
def substems(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_linenumber").cast("string").alias("stem"))
    return A.substems(rows, "l_returnflag", "stem").select("l_returnflag", F.array_join("substems", ",").alias("substems"), F.array_join(A.present_stems(F.col("substems"), ["7", "2", "9"]), ",").alias("present"))


@query("ratio_by_split", "WITH f AS (SELECT o_orderstatus AS split, CASE WHEN o_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender, o_totalprice AS d FROM orders) SELECT split, round(sum(CASE WHEN gender = 'female' THEN d ELSE 0 END) / sum(d), 9) AS female_ratio, round(sum(d), 3) AS duration FROM f GROUP BY GROUPING SETS ((split), ())")
def ratio_by_split(spark: SparkSession, sf: str) -> DataFrame:
    f = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("split"), F.when(F.col("o_custkey") % 2 == 0, "female").otherwise("male").alias("gender"), F.col("o_totalprice").alias("d"))
    return A.gender_ratio(f, "gender", "d", "split").select("split", F.round("female_ratio", 9).alias("female_ratio"), F.round("duration", 3).alias("duration"))


@query(
    "combine_licenses",
    f"""WITH {LICENSED}, g AS (SELECT source, bool_or(coalesce(attribution, true)) AS attribution, bool_and(coalesce(commercial, false)) AS commercial, bool_and(coalesce(derivative, false)) AS derivative, bool_or(coalesce(share_alike, true)) AS share_alike, count(*) AS n_licenses FROM licensed GROUP BY source)
 SELECT *, CASE WHEN NOT derivative THEN 'nd' WHEN NOT commercial THEN 'nc' ELSE 'com' END AS license_usage FROM g""",
)
def combine_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return A.combine_licenses(licensed(spark, sf), "source")


@query("unpivot_parameters", "SELECT o_orderkey, o_orderstatus AS split, 'naive_peak' AS parameter, o_totalprice AS value FROM orders UNION ALL SELECT o_orderkey, o_orderstatus, 'loudness_integrated', o_totalprice / 2 FROM orders UNION ALL SELECT o_orderkey, o_orderstatus, 'true_peak', o_totalprice * 2 FROM orders")
def unpivot_parameters(spark: SparkSession, sf: str) -> DataFrame:
    wide = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("split"), F.col("o_totalprice").alias("naive_peak"), (F.col("o_totalprice") / 2).alias("loudness_integrated"), (F.col("o_totalprice") * 2).alias("true_peak"))
    return A.long_parameters(wide, ["o_orderkey", "split"], ["naive_peak", "loudness_integrated", "true_peak"])


@query("union_manifests", "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier UNION ALL SELECT p_partkey, p_name, NULL, NULL FROM part")
def union_manifests(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return C.union_manifests(c, s, table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")))


@query("subset_names", "SELECT DISTINCT subset FROM (SELECT c_mktsegment AS subset FROM customer UNION ALL SELECT p_type FROM part) WHERE subset <> 'default' AND subset IS NOT NULL")
def subset_names(spark: SparkSession, sf: str) -> DataFrame:
    return C.subset_names(table(spark, sf, "customer").select(F.col("c_mktsegment").alias("subset")), table(spark, sf, "part").select(F.col("p_type").alias("subset")))


@query("unsupported", "SELECT DISTINCT o_custkey AS custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 5000)")
def unsupported(spark: SparkSession, sf: str) -> DataFrame:
    return C.unsupported(table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey")), table(spark, sf, "customer").where("c_acctbal < 5000").select(F.col("c_custkey").alias("custkey")), "custkey")


@query(
    "path_scalars",
    f"""WITH {CLIPS}, p AS (SELECT doc_id, string_split(file, '/') AS parts, file, source, lang, upper(' ' || lang || ' ') AS shout, CASE doc_id % 5 WHEN 0 THEN ' M ' WHEN 1 THEN 'female' WHEN 2 THEN 'male_unsure' WHEN 3 THEN 'nan' ELSE 'robot' END AS g FROM clips)
 SELECT doc_id, parts[-1] AS base, array_to_string(parts[:-2], '/') AS dir, regexp_replace(file, '\\.[^./]*$', '.flac') AS flac, replace(file, '$RAW_DATA_ROOT', '/data') AS expanded, 'clip' AS speaker, lpad(doc_id::VARCHAR, 6, '0') AS track,
 CASE WHEN doc_id % 5 IN (0, 2) THEN 'male' WHEN doc_id % 5 = 1 THEN 'female' WHEN doc_id % 5 = 3 THEN 'unknown' END AS gender, lower(trim(shout)) AS lang, substr(lpad(doc_id::VARCHAR, 6, '0'), 1, 3) AS folder, source || '/' || lang AS subset, source || '-' || lang || doc_id AS speaker_key,
 regexp_replace(regexp_replace(file, '[^A-Za-z0-9_]', '_', 'g'), '_+', '_', 'g') AS plain FROM p""",
)
def path_scalars(spark: SparkSession, sf: str) -> DataFrame:
    c = clips(spark, sf)
    f, d = F.col("file"), F.col("doc_id")
    g = F.get(F.array(*[F.lit(x) for x in (" M ", "female", "male_unsure", "nan", "robot")]), (d % 5).cast("int"))
    st = S.speaker_track(f)
    return c.select(
        "doc_id", S.basename(f).alias("base"), S.dirname(f).alias("dir"), S.swap_extension(f, ".flac").alias("flac"), S.expand_root(f, "/data", "$RAW_DATA_ROOT").alias("expanded"), st["speaker"].alias("speaker"), st["track"].alias("track"),
        S.gender(g).alias("gender"), S.langcode(F.upper(F.concat(F.lit(" "), "lang", F.lit(" ")))).alias("lang"), S.id_folder(d).alias("folder"), S.subset_name(F.col("source"), F.col("lang")).alias("subset"), S.speaker_key(F.col("source"), F.col("lang"), d.cast("string")).alias("speaker_key"), S.plain_name(f).alias("plain"),
    )


_label_rows = """ls AS (SELECT user_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS labels FROM events GROUP BY user_id, value > 100), cl AS (SELECT user_id, labels, contains(labels, 'error') AS bad, contains(labels, 'click') OR contains(labels, 'purchase') AS fg, contains(labels, 'view') AS bg FROM ls)"""


def _labels(spark: SparkSession, sf: str, version: int) -> DataFrame:
    rows = table(spark, sf, "events").groupBy("user_id", (F.col("value") > 100).alias("hi")).agg(F.array_join(F.array_sort(F.collect_set("event_type")), ", ").alias("labels"))
    classes = S.label_classes(F.col("labels"), LABELS)
    return rows.select("user_id", "labels", F.array_join(classes, ",").alias("classes"), S.one_class(classes, version).alias("class"))


_classes_sql = "concat_ws(',', CASE WHEN bg THEN 'background' END, CASE WHEN fg THEN 'foreground' END, CASE WHEN bad THEN 'unusable' END) AS classes"


@query("label_class_v2", f"WITH {_label_rows} SELECT user_id, labels, {_classes_sql}, CASE WHEN bad THEN 'unusable' WHEN fg THEN 'foreground' WHEN bg THEN 'background' END AS class FROM cl")
def label_class_v2(spark: SparkSession, sf: str) -> DataFrame:
    return _labels(spark, sf, 2)


@query("label_class_v3", f"WITH {_label_rows} SELECT user_id, labels, {_classes_sql}, CASE WHEN bad::INT + fg::INT + bg::INT > 1 THEN 'unusable' WHEN bad THEN 'unusable' WHEN fg THEN 'foreground' WHEN bg THEN 'background' END AS class FROM cl")
def label_class_v3(spark: SparkSession, sf: str) -> DataFrame:
    return _labels(spark, sf, 3)


@query("nearest_duration", "WITH r AS (SELECT o_orderstatus, o_custkey, o_orderkey, o_totalprice, abs(o_totalprice - 100000) AS gap, row_number() OVER (PARTITION BY o_orderstatus, o_custkey ORDER BY abs(o_totalprice - 100000), o_orderkey) AS rn FROM orders) SELECT o_orderstatus, o_custkey, o_orderkey, o_totalprice, round(gap, 4) AS gap FROM r WHERE rn = 1")
def nearest_duration(spark: SparkSession, sf: str) -> DataFrame:
    return C.nearest(table(spark, sf, "orders"), ["o_orderstatus", "o_custkey"], F.lit(100_000.0), "o_totalprice", "o_orderkey").withColumn("gap", F.round("gap", 4))


@query("parse_literals", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, (props::JSON ->> 'k')::BIGINT AS k FROM events")
def parse_literals(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    text = F.date_format("ts", "yyyy-MM-dd")
    return e.select("event_id", F.date_format(F.to_timestamp(text, "yyyy-MM-dd"), "yyyy-MM-dd").alias("day"), F.from_json("props", "k bigint")["k"].alias("k"))
