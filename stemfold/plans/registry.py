"""The table of queries: each binds operators to tables, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- SQL text that several queries share --------------------------------------

#: documents as a clip manifest
CLIPS = """clips AS (SELECT doc_id, source, text, lang, CASE lang WHEN 'en' THEN 'eng' WHEN 'fr' THEN 'fra' WHEN 'de' THEN 'deu' WHEN 'es' THEN 'spa' END AS langcode,
 n_chars / 100.0::DOUBLE AS duration, CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 = 7 THEN 'val' ELSE 'test' END AS split,
 CASE doc_id % 4 WHEN 0 THEN 'com' WHEN 1 THEN 'nc' WHEN 2 THEN 'nd' END AS subset,
 '$RAW_DATA_ROOT/' || source || '/' || lang || '/clip_' || lpad(doc_id::VARCHAR, 6, '0') || '.wav' AS file FROM documents)"""


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    d = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id", "source", "text", "lang", F.element_at(F.create_map(*[F.lit(x) for p in (("en", "eng"), ("fr", "fra"), ("de", "deu"), ("es", "spa")) for x in p]), F.col("lang")).alias("langcode"),
        (F.col("n_chars") / 100.0).alias("duration"), F.when(d % 10 < 7, "train").when(d % 10 == 7, "val").otherwise("test").alias("split"),
        F.when(d % 4 == 0, "com").when(d % 4 == 1, "nc").when(d % 4 == 2, "nd").alias("subset"),
        F.concat(F.lit("$RAW_DATA_ROOT/"), "source", F.lit("/"), "lang", F.lit("/clip_"), F.lpad(d.cast("string"), 6, "0"), F.lit(".wav")).alias("file"),
    )


def u_sql(seed: int, tag: str, *keys: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', '{tag}', {', '.join(f'({k})::VARCHAR' for k in keys)})), 1, 13))::BIGINT / {16**13}.0::DOUBLE)"


def _poly(coefficients: tuple[float, ...], x: str) -> str:
    out = f"({coefficients[0]!r}::DOUBLE)"
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c!r}::DOUBLE)"
    return out


#: Macros cannot be assumed, so the shared polynomials are written out on a column.
def quantile_sql(p: str) -> str:
    from stemfold.functions.draws import A, B, C, D, LOW, TINY

    p = f"greatest({TINY!r}::DOUBLE, least(1::DOUBLE - {TINY!r}::DOUBLE, {p}))"
    low, high, mid = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - {p}))", f"({p} - 0.5::DOUBLE)"
    r = f"({mid} * {mid})"
    return f"(CASE WHEN {p} < {LOW}::DOUBLE THEN {_poly(C, low)} / {_poly(D, low)} WHEN {p} > 1 - {LOW}::DOUBLE THEN -({_poly(C, high)} / {_poly(D, high)}) ELSE {_poly(A, r)} * {mid} / {_poly(B, r)} END)"


def cdf_sql(x: str) -> str:
    from stemfold.functions.draws import BS, P, ROOT_2PI

    t = f"(1 / (1 + {P!r}::DOUBLE * abs({x})))"
    tail = f"(exp(-({x}) * ({x}) / 2) / {ROOT_2PI!r}::DOUBLE * ({_poly(tuple(reversed(BS)), t)} * {t}))"
    return f"(CASE WHEN {x} >= 0 THEN 1 - {tail} ELSE {tail} END)"
