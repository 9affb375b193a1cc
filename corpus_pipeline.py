"""Training corpus pipeline: five operators in a row over ``documents``.

``run`` writes every stage's rows as Parquet in the shared scratch folder and hands
what it reads back to the next stage, so a lost executor repeats one stage at most
and no stage depends on a plan of the ones before.

Stages: documents that the quality rules reject go; later copies of lines go from
the texts (and documents left without a word); one document of every group of near
duplicates stays; documents with benchmark passages go; the rest is tokenised. All
columns of ``documents`` travel to the last stage, which returns the id, language,
source (null where the table has none) and token ids.

Null texts and empty tables pass every stage (each operator states its results);
``n_chars`` follows a text that line dedup shortens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm import bpe, decontam, line_dedup, ngram_join, quality
from lakeward.llm.common import cut, read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs, read_table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_later_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_per_component(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = [F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c)
             for c in ("lang", "source")]
    ids = bpe.encode_frame(docs.select("doc_id", *named, "text"))
    return ids.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"),
                      "token_ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("bpe_encoding", tokenise),
]

# SQL has no byte-pair merges; tests/llm/test_pipeline.py runs the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
