"""The corpus pipeline: documents through a toxicity filter, near-duplicate stages, decontamination and the tokenizer."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retrolane.llm import bpe, decontaminate, jaccard, lines, toxicity
from retrolane.llm.common import stage
from retrolane.llm.queries import VOCABULARY, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold. The model is fitted on labelled documents of docs."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.tag(docs, model, spans=False).where("predicted = 0").select(*docs.columns)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; those that lose all their text this way go, empty ones stay."""
    left = lines.dedup(docs)
    lost = (F.col("n_removed") > 0) & (F.length(F.trim("text")) == 0)
    text = F.length("text").cast("long")
    return left.where(~F.coalesce(lost, F.lit(False))).withColumn("n_chars", text).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity of at least 0.8."""
    return jaccard.without_near_copies(docs, words=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, not even with a fifth of its words edited."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens of every document that is left, with the digests of its ids and of what they decode to."""
    encoded = bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, ids=False)
    return encoded.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean_language),
    ("line dedup", distinct_lines),
    ("n-gram Jaccard join", distinct_documents),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", tokens),
]

# The toxicity model, the shingle components and the tokenizer have no SQL form; tests hold the stages
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
