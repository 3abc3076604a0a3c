"""From documents to token ids: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardgrid.llm import langid, linededup, lshjoin, mixing, queries, transducer
from hazardgrid.llm.batches import stored


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with another text and its length."""
    return docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a letter and those whose language stays open; fill in missing labels."""
    queries.prepare(spark)
    found = langid.predict(docs, langid.fit(docs))
    kept = found.where((F.col("llm_lang") != langid.UNKNOWN) & ~F.col("llm_ambiguous"))
    return kept.withColumn("lang", F.coalesce("lang", "llm_lang")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that an earlier document has; every document stays, if only with an empty text."""
    queries.prepare(spark)
    return _with_text(linededup.dedup_lines(spark, docs), F.col("llm_kept")).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of every group of near-duplicates."""
    queries.prepare(spark)
    gone = lshjoin.join_similar(spark, docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take the words that the target weights ask for: a row per pass over a document."""
    queries.prepare(spark)
    mixed = mixing.mix_documents(spark, docs)
    return _with_text(mixed, F.col("text")).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text; the ids decode to it again."""
    queries.prepare(spark)
    return transducer.encode(docs, queries.tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("source_mixing", source_mixing),
    ("sentencepiece", sentencepiece),
]

#: SQL cannot express the stages; tests/llm/test_pipeline.py has a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
