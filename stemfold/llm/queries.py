"""The queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemfold.llm.decontaminate import contaminated
from stemfold.llm.hardneg import hard_negatives
from stemfold.llm.html import extract_text
from stemfold.llm.images import copies_and_members, read_edited, read_vectors
from stemfold.llm.lm import cross_entropy_difference
from stemfold.llm.merkle import merkle_manifest
from stemfold.llm.neardup import near_duplicates
from stemfold.llm.packing import pack_documents
from stemfold.llm.quality import quality_scores
from stemfold.llm.secrets import scan_secrets
from stemfold.llm.sharding import assign_shards
from stemfold.llm.suffixes import drop_repeats
from stemfold.llm.tokencount import token_counts

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as images; the queries are edited crops of those whose id is divisible by 20. Pairs, and the members of both sides."""
    vectors = table(spark, sf_dir, "embeddings")
    return copies_and_members(vectors, vectors.where("vec_id % 20 = 0"), "vec_id", "embedding", read=read_vectors, read_query=read_edited)


def op2_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"), "doc_id", "text", 40)


def op4_secret_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "grammar")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), count("grammar").alias("n_grammar"), "score")


def op5_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op7_sampled_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents"), with_bytes=False)


def op8_mincut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op9_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled as good. Background: all documents."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op10_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_two_tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op12_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    relabelled = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(relabelled, F.col("vec_id") % 50 == 0)


def op13_octopus_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose decimal doc_id has an even CRC-32 lose their line feeds in the tampered copy."""
    unbroken = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    return merkle_manifest(table(spark, sf_dir, "documents"), tampered=unbroken, chosen=F.crc32(F.col("doc_id").cast("string")) % 2 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_image_copies": op1_image_copies,
    "op2_string_tiling": op2_string_tiling,
    "op3_jump_shards": op3_jump_shards,
    "op4_secret_grammar": op4_secret_grammar,
    "op5_quality_trees": op5_quality_trees,
    "op6_bbit_minhash": op6_bbit_minhash,
    "op7_sampled_suffixes": op7_sampled_suffixes,
    "op8_mincut_text": op8_mincut_text,
    "op9_cross_entropy_difference": op9_cross_entropy_difference,
    "op10_hilbert_packing": op10_hilbert_packing,
    "op11_two_tier_counts": op11_two_tier_counts,
    "op12_bond_negatives": op12_bond_negatives,
    "op13_octopus_manifest": op13_octopus_manifest,
    "pipeline": pipeline,
}

def merkle_sql() -> str:
    def leaf(text: str) -> str:
        parts = (f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END" for c in ("doc_id", "source", "lang", "n_chars", text))
        return f"sha256(concat({', '.join(parts)}))"

    # CRC-32 bit by bit: each byte is followed by eight shifts
    bits = "list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: list_concat([ascii(c)::BIGINT], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))), lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END)"

    def tree(name: str, leaves: str) -> str:
        return f"{name} AS ({leaves} UNION ALL SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 2) // 3 FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 3)"

    def fold(name: str, first: str, nodes: str) -> str:
        step = f"SELECT f.r, f.tree, f.level + 1, f.pos // 3, sha256(string_agg(CASE WHEN n.pos = f.pos THEN f.h ELSE n.h END, '' ORDER BY n.pos)), (max(n.n) + 2) // 3"
        return f"{name} AS ({first} UNION ALL {step} FROM {name} f JOIN {nodes} n ON n.tree = f.tree AND n.level = f.level AND n.pos // 3 = f.pos // 3 WHERE f.n > 1 GROUP BY f.r, f.tree, f.level, f.pos)"

    def beside(nodes: str, at: str) -> str:
        power = "(3 ** n.level)::BIGINT"
        return f"SELECT l.r, string_agg(n.h, '' ORDER BY n.level, n.pos) AS p FROM l JOIN {nodes} n ON n.tree = {'l.tree' if nodes == 'nodes' else '0'} WHERE n.n > 1 AND n.pos // 3 = {at} // {power} // 3 AND n.pos <> {at} // {power} GROUP BY l.r"

    return f"""WITH RECURSIVE d AS (SELECT *, row_number() OVER () AS r, {leaf('text')} AS leaf, CASE WHEN {bits} & 1 = 1 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS altered FROM documents),
 l AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d),
 {tree('nodes', 'SELECT tree, 0 AS level, pos, leaf AS h, n FROM l')},
 s AS (SELECT tree AS pos, h FROM nodes WHERE n = 1),
 {tree('tops', 'SELECT 0 AS tree, 0 AS level, pos, h, count(*) OVER () AS n FROM s')},
 {fold('f', 'SELECT r, tree, 0 AS level, pos, altered AS h, n FROM l', 'nodes')},
 {fold('g', 'SELECT r, 0 AS tree, 0 AS level, f.tree AS pos, h, (SELECT count(*) FROM s) AS n FROM f WHERE n = 1', 'tops')},
 low AS ({beside('nodes', 'l.pos')}), high AS ({beside('tops', 'l.tree')})
 SELECT doc_id, leaf, s.h AS subroot, root.h AS root, sha256(coalesce(low.p, '') || coalesce(high.p, '')) AS proof_sha256, g.h AS folded_root, g.h = root.h AS verified
 FROM l JOIN s ON s.pos = l.tree CROSS JOIN (SELECT h FROM tops WHERE n = 1) root JOIN g ON g.r = l.r AND g.n = 1 LEFT JOIN low ON low.r = l.r LEFT JOIN high ON high.r = l.r"""


ORACLE_SQL: dict[str, str] = {
    "op6_bbit_minhash": r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS s FROM w),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
 e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
 g AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
 r AS (SELECT a AS doc_id, a AS reached FROM g UNION SELECT r.doc_id, g.b FROM r JOIN g ON g.a = r.reached),
 c AS (SELECT doc_id, min(reached) AS c FROM r GROUP BY doc_id)
 SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.c, d.doc_id) AS component_id, coalesce(c.c, d.doc_id) = d.doc_id AS kept FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id""",
    "op12_bond_negatives": """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
 WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
 s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
 p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
 SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.id AS negative_id, positive_score, s.score AS negative_score FROM p JOIN s USING (anchor_id)
 WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) QUALIFY row_number() OVER w <= 3""",
    "op13_octopus_manifest": merkle_sql(),
}
