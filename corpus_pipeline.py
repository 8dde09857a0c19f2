"""A training-data pipeline over the documents table: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stemfold.llm.common import cut
from stemfold.llm.decontaminate import drop_contaminated
from stemfold.llm.neardup import drop_near_duplicates
from stemfold.llm.packing import pack_documents
from stemfold.llm.quality import keep_quality
from stemfold.llm.queries import table, tokenizer_path
from stemfold.llm.secrets import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts are scored like any others, repeated rows alike; a row with a null id
    is judged by its text. An empty table stays empty. Without labels nothing is rejected. All columns pass through.
    """
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the smallest doc_id stays.

    Rows without words are linked with nothing, and rows with a null id stay; rows that repeat an id are one
    document and stay or go together. An empty table stays empty. All columns pass through.
    """
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half a benchmark item or more go.

    A null or empty text holds nothing; ids play no part, so null and repeated ones are rows like any
    others. An empty table, or benchmark, changes nothing. All columns pass through.
    """
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; n_chars, where there is one, follows.

    Null and empty texts stay as they are, null ids and repeated rows are rows like any others.
    An empty table stays empty. Other columns pass through.
    """
    return redact_secrets(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences of 2048 ids: a row for each piece.

    A null or empty text is the closing id alone; null ids and repeated rows are packed each. An
    empty table gives no pieces. Extra columns are not read, whatever their names.
    """
    return pack_documents(docs, tokenizer_path())


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secrets", secrets), ("packing", packing)]

#: Trained scores, components and tokens are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
