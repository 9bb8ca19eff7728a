import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from retrolane.llm import bpe, decontaminate, toxicity
from tests.llm.test_decontaminate import edits
from tests.llm.test_jaccard import brute as near_copies
from tests.llm.test_lines import brute as near_lines

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_every_stage_equals_its_brute_force_version(spark, docs, monkeypatch):
    small = docs.where("length(text) < 3000").limit(120)
    small = spark.createDataFrame([tuple(r) for r in small.collect()] + [(9001, None, None, None, None), (9002, "", "en", "s", 0)], COLUMNS)
    rows = [tuple(r) for r in small.collect()]

    got = {r[0]: r for r in map(tuple, corpus_pipeline.clean_language(spark, small, FOLDER).collect())}
    model = toxicity.train(small, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    want = {r[0]: r for r in rows if model.score(model.sums(r[1] or "")[3]) < toxicity.THRESHOLD}
    assert got == want

    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.distinct_lines(spark, small, FOLDER).collect()}
    judged = near_lines([r[:2] for r in rows], 2, 20)
    assert got == {doc: text for doc, text, _, gone in judged if not (gone and not text.strip())}

    got = sorted(r["doc_id"] for r in corpus_pipeline.distinct_documents(spark, small, FOLDER).collect())
    assert got == sorted(doc for doc, _, first in near_copies([r[:2] for r in rows], 5, 80) if doc == first)

    got = {r["doc_id"] for r in corpus_pipeline.without_benchmark(spark, small, FOLDER).collect()}
    items = [decontaminate.words(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    known = [w for item in items for w in item]
    holds = set()
    for doc, text, *_ in rows:
        mine = decontaminate.words(text)
        if set(mine) & set(known):
            holds |= {doc for item in items if len(set(item) & set(mine)) >= 0.5 * len(set(item)) and edits(item, mine) <= decontaminate.allowed(len(item), 80)}
    assert got == {r[0] for r in rows} - holds

    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        special_tokens={},
    )
    for row in corpus_pipeline.tokens(spark, small, FOLDER).collect():
        text = {r[0]: r[1] for r in rows}[row["doc_id"]] or ""
        ids = library.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_stages_take_empty_tables_and_keep_the_columns(spark, docs):
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs.limit(0), FOLDER)
        assert out.columns == docs.columns and out.count() == 0


def test_the_run_keeps_a_part_of_the_documents(spark, docs):
    out = corpus_pipeline.run(spark, FOLDER)
    kept = [r["doc_id"] for r in out.collect()]
    assert 0 < len(kept) == len(set(kept)) < docs.count()
