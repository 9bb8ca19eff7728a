"""Ranked lexical search: one automaton of all item terms reads the documents, no index is built.

Texts become UTF-8 with A-Z lower-cased and every separator turned into a space, so that a term with
a space on either side is guarded at its borders: the automaton reports whole terms only, and one
space may end a term and begin the next. It is built on the driver from a bounded block of items and
broadcast. A first reading of the documents gives the statistics (documents and terms in all,
documents that hold each item term); a second one counts each term in each text, maps the automaton's
outputs to the items that ask for them and keeps the best few of each item. Neither writes anything
about a document; only the best of each task are shuffled, first to one row group for each item and
part, then to the item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOP = 10
MOST_PAIRS = 200_000  # (item, term) pairs that one block may hold, or one item of more; more items take more blocks
PENDING = 200_000  # candidates that a task holds beside the best of each item
MERGE_PARTS = 64

# Fixed value: ASCII letters and digits and all bytes above are of terms, A-Z count as a-z, the others separate.
FOLD = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or chr(byte).isalnum() else 32 for byte in range(256)
)


def folded(text: str | None) -> bytes:
    """The terms of a text in UTF-8 with separators turned into spaces, one more at either end."""
    return b" " + text.encode().translate(FOLD) + b" " if text else b"  "


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_part(documents: int, terms: int, n: int) -> int:
    """What a document of n terms among so many documents and terms is divided by, in tenths of a count."""
    return 100 - 90 + 90 * n * documents // terms


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term) without repeats; rows of one item_id are one item, items without terms have no row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for item, text in zip(ids, terms, strict=True):
                found = sorted(set(folded(text).split()))
                if found:
                    said = pa.array([term.decode() for term in found], pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(found), batch.schema[0].type), said], ["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(rows, f"item_id {kind}, term string").distinct()


class Block:
    """The terms of some items: the automaton over them, and the items that each term counts for."""

    def __init__(self, pairs: list[tuple[object, str]]):
        self.items = list(dict.fromkeys(item for item, _ in pairs))
        self.terms = list(dict.fromkeys(term for _, term in pairs))
        places = {item: at for at, item in enumerate(self.items)}
        numbers = {term: at for at, term in enumerate(self.terms)}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for term, number in numbers.items():
            self.automaton.add_word(f" {term.encode().decode('latin-1')} ", number)
        self.automaton.make_automaton()
        term_of = np.array([numbers[term] for _, term in pairs], np.int64)
        item_of = np.array([places[item] for item, _ in pairs], np.int64)
        order = np.argsort(term_of, kind="stable")
        self.asking = item_of[order]
        self.starts = np.searchsorted(term_of[order], np.arange(len(self.terms) + 1))

    def counts(self, data: bytes) -> Counter:
        """How often each term stands in a folded text, by number."""
        return Counter([number for _, number in self.automaton.iter(data.decode("latin-1"))])


def _statistics(block: Block, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term number, documents that hold it) of a task; -1 for documents with a term, -2 for all their terms."""
    holding = np.zeros(len(block.terms), np.int64)
    documents = terms = 0
    for batch in batches:
        for text in batch.column(0):
            data = folded(text.as_py())
            n = len(data.split())
            if n:
                documents, terms = documents + 1, terms + n
                holding[list(block.counts(data))] += 1
    found = np.nonzero(holding)[0]
    number = np.concatenate([found, [-1, -2]])
    many = np.concatenate([holding[found], [documents, terms]])
    yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(many, pa.int64())], ["number", "many"])


class Best:
    """The best documents of each item so far: highest scores, equal ones by ascending id, null ids last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.least = np.ones(items, np.int64)
        self.kept: list[np.ndarray] = []
        self.pending = 0

    def offer(self, scores: np.ndarray, doc: int | None) -> None:
        """Scores of one document for all items."""
        good = np.nonzero(scores >= self.least)[0]
        if len(good):
            rows = np.empty((4, len(good)), np.int64)
            rows[0], rows[1], rows[2], rows[3] = good, scores[good], doc is None, doc or 0
            self.kept.append(rows)
            self.pending += len(good)
            if self.pending > PENDING + self.top * len(self.least):
                self.rows()

    def rows(self) -> np.ndarray:
        """(item, score, no id, id) of the best, by item and rank."""
        rows = np.concatenate(self.kept, axis=1) if self.kept else np.zeros((4, 0), np.int64)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        places = np.arange(rows.shape[1])
        firsts = np.searchsorted(rows[0], rows[0])
        rows = rows[:, places - firsts < self.top]
        item, first, many = np.unique(rows[0], return_index=True, return_counts=True)
        full = many == self.top
        self.least[item[full]] = rows[1][first[full] + self.top - 1]
        self.kept, self.pending = [rows], rows.shape[1]
        return rows


def _scores(
    block: Block, weights: np.ndarray, documents: int, terms: int, top: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """(item number, doc_id, score) of a task's best documents for each item."""
    best = Best(len(block.items), top)
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = folded(text.as_py())
            counts = block.counts(data)
            if not counts:
                continue
            divided = 8 * length_part(documents, terms, len(data.split()))
            numbers = np.fromiter(counts.keys(), np.int64, len(counts))
            often = np.fromiter(counts.values(), np.int64, len(counts))
            worth = weights[numbers] * (1_000_000_000 * often // (1000 * often + divided))
            begins = block.starts[numbers]
            many = block.starts[numbers + 1] - begins
            ends = np.cumsum(many)
            at = np.arange(ends[-1]) + np.repeat(begins - ends + many, many)
            scores = np.zeros(len(block.items), np.int64)
            np.add.at(scores, block.asking[at], np.repeat(worth, many))
            best.offer(scores, doc)
    rows = best.rows()
    docs = pa.array(rows[3], pa.int64(), mask=rows[2] == 1)
    yield pa.RecordBatch.from_arrays([pa.array(rows[0]), docs, pa.array(rows[1])], ["place", "doc_id", "score"])


def _block(docs: DataFrame, pairs: list, top: int) -> tuple[DataFrame, list]:
    """(place, doc_id, score, rank) of the best documents for a block of items, and the items by place."""
    spark = docs.sparkSession
    block = spark.sparkContext.broadcast(Block(pairs))
    whole = block.value
    read = docs.select("text").mapInArrow(lambda batches: _statistics(block.value, batches), "number long, many long")
    told = read.groupBy("number").agg(F.sum("many").alias("many")).toArrow()
    known = dict(zip(told.column("number").to_pylist(), told.column("many").to_pylist(), strict=True))
    documents, terms = known.get(-1, 0), known.get(-2, 0)
    weights = np.array([weight(documents, known.get(at, 0)) for at in range(len(whole.terms))], np.int64)
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: _scores(block.value, weights, documents, terms, top, batches),
        "place long, doc_id long, score long",
    )
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS))
    for keys in (["place", "part"], ["place"]):
        found = found.withColumn("part", part) if "part" in keys else found
        ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        found = found.withColumn("rank", ranked).where(F.col("rank") <= top)
    return found, whole.items


def search(docs: DataFrame, items: DataFrame, top: int = TOP, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """The `top` highest-scoring documents of every item: item_id, rank, doc_id, score.

    docs has doc_id and text, items has item_id and text; other columns are left out, whatever their
    names. Equal scores go by ascending doc_id. A null or empty text has no terms: such an item gets
    no rows, such a document is in none and counts in no statistic. Repeated rows of docs count and
    rank as documents of their own; rows of one item_id (null included) are one item with the terms
    of all of them. A document without id ranks after those of equal score. Empty tables give no
    rows. Texts are read whole, whatever their length.

    Items are worked off in blocks by the hash of their id, of about most_pairs terms; each block
    reads the documents twice. A task holds one block, its automaton and at most PENDING candidates
    and `top` rows for each item.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    said = T.StructType(
        [T.StructField("item_id", kind), T.StructField("rank", T.IntegerType())]
        + [T.StructField(name, T.LongType()) for name in ("doc_id", "score")]
    )
    pairs = item_terms(items)
    blocks = -(-pairs.count() // most_pairs)
    out = spark.createDataFrame([], said)
    for number in range(blocks):
        of_block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number
        rows = pairs.where(of_block).orderBy("item_id", "term").collect()
        if rows:
            found, names = _block(docs, [tuple(row) for row in rows], top)
            places = T.StructType([T.StructField("place", T.LongType()), T.StructField("item_id", kind)])
            named = spark.createDataFrame(list(enumerate(names)), places)
            found = found.join(named, "place").select("item_id", F.col("rank").cast("int"), "doc_id", "score")
            out = found if number == 0 else out.unionByName(found)
    return out


# Columns of the registered query. Terms are written as what they are made of, not as what separates them.
ORACLE = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS terms
    FROM documents
), sized AS (
    SELECT doc_id, terms, len(terms) AS n FROM docs WHERE len(terms) > 0
), totals AS (
    SELECT count(*) AS docs_n, CAST(sum(n) AS BIGINT) AS terms_n FROM sized
), items AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term
    FROM benchmark
), words AS (
    SELECT doc_id, n, unnest(terms) AS term FROM sized
), held AS (
    SELECT doc_id, any_value(n) AS n, term, count(*) AS tf
    FROM words WHERE term IN (SELECT term FROM items) GROUP BY doc_id, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs_n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, totals GROUP BY term
), scores AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf)
        // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs_n) // terms_n))))) AS BIGINT) AS score
    FROM held JOIN items USING (term) JOIN weights USING (term), totals
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, doc_id, score,
        CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
