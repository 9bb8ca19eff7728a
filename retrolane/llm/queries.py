"""The registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retrolane.llm import (
    bpe,
    decontaminate,
    embeddings,
    html,
    jaccard,
    lexical,
    lines,
    repeats,
    spelling,
    toolcalls,
    toxicity,
    urls,
    word_bpe,
)

VOCABULARY = "byte_bpe_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, folder, "embeddings"), least=0.95, recall=True)


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op3_toolcalls(spark: SparkSession, folder: str) -> DataFrame:
    calls, results = toolcalls.turns_as_calls(table(spark, folder, "conversations"))
    return toolcalls.link(calls, results, {"reply": toolcalls.REPLY}).drop("faults")


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.leaks(docs, table(spark, folder, "benchmark"))


def op5_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages").select("page_id", "url"), rules=urls.RULES).drop("url")


def op6_html(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    scored = toxicity.tag(docs, model)
    held_out = toxicity.held_out(F.col("doc_id")).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted", "toxic_tokens", "toxic_spans")


def op8_lines(spark: SparkSession, folder: str) -> DataFrame:
    out = lines.dedup(table(spark, folder, "documents").select("doc_id", "text"), equal_chars=lines.EQUAL_CHARS)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link(table(spark, folder, "documents"), words=3, percent=90)


def op10_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove(table(spark, folder, "documents"), min_bytes=50, kept=False)


def op11_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op13_wordbpe(spark: SparkSession, folder: str) -> DataFrame:
    return word_bpe.digests(table(spark, folder, "documents"), public_tokenizers.path(WORD_VOCABULARY))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embeddings": op1_embeddings,
    "op2_bpe": op2_bpe,
    "op3_toolcalls": op3_toolcalls,
    "op4_decontaminate": op4_decontaminate,
    "op5_urls": op5_urls,
    "op6_html": op6_html,
    "op7_toxicity": op7_toxicity,
    "op8_lines": op8_lines,
    "op9_jaccard": op9_jaccard,
    "op10_repeats": op10_repeats,
    "op11_lexical": op11_lexical,
    "op12_spelling": op12_spelling,
    "op13_wordbpe": op13_wordbpe,
}

ORACLE: dict[str, str] = {
    "op3_toolcalls": toolcalls.ORACLE,
    "op5_urls": urls.oracle_sql(),
    "op11_lexical": lexical.ORACLE,
}
