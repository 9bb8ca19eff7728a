"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, exact edit distance.

The CGK embedding walks along a sequence and copies it to three times its length, at every step
moving on or standing still as a shared random function of step and symbol says. Sequences at a
small edit distance soon walk in step, so their images differ in few places: edit distance
becomes Hamming distance. A hash table then compares a few sampled places; several tables of
several walks find a pair at the threshold almost surely, and a banded edit distance decides.

Symbols are words. Windows have the number of words of an item. A window can only be within k
edits of an item of n words if one of k + 1 parts of the item stands in it unchanged, so a run of
ceil((n - k) / (k + 1)) words of the item does (three at most are asked for). Only windows that
such a run allows are embedded; no match is lost by that.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WALKS = 8
TABLES = 8  # of each walk
PLACES = 3  # of each table
MOST_ITEMS = 20_000  # items told to the tasks at once; more are worked off in blocks
GRAM = 3

# ASCII characters that separate words, and A-Z with their lower case.
TABLE = bytes(
    byte if byte >= 128 or chr(byte).isalnum() and not 65 <= byte <= 90 else byte + 32 if 65 <= byte <= 90 else 32
    for byte in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Lower-case words; ASCII punctuation and white space separate them."""
    return text.lower().encode().translate(TABLE).split() if text else []


def allowed(n: int, percent: int) -> int:
    """Edits that an item of n words may differ by."""
    return n * (100 - percent) // 100


def distance(item: list[int], text: list[int], most: int) -> tuple[int, int] | None:
    """Least edit distance of the item to a prefix of text and the shortest such prefix, if at most `most`."""
    far = most + 1
    row = list(range(len(text) + 1))
    for i, symbol in enumerate(item, 1):
        low, high = max(1, i - most), min(len(text), i + most)
        new = [far] * (len(text) + 1)
        if i <= most:
            new[0] = i
        for j in range(low, high + 1):
            best = row[j - 1] + (symbol != text[j - 1])
            best = min(best, row[j] + 1, new[j - 1] + 1)
            new[j] = min(best, far)
        row = [min(value, far) for value in new]
        if min(row) > most:
            return None
    value = min(row)
    return (value, row.index(value)) if value <= most else None


class Embedding:
    """Walks and sampled places; all from one seed, so that every task has the same."""

    def __init__(self, longest: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        steps = 3 * max(1, longest)
        self.factors = rng.integers(1, 1 << 62, (WALKS, steps), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.mix = rng.integers(1, 1 << 62, (TABLES, PLACES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.seed = seed

    def hashes(self, windows: np.ndarray) -> np.ndarray:
        """(table, window) hashes of windows of equal length; symbols are positive."""
        many, n = windows.shape
        padded = np.concatenate([windows, np.zeros((many, 1), windows.dtype)], axis=1).astype(np.uint64)
        at = np.zeros((WALKS, many), np.int64)
        image = np.empty((3 * n, WALKS, many), np.uint64)
        rows = np.arange(many)
        for step in range(3 * n):
            symbol = padded[rows, at]
            image[step] = symbol
            bit = ((symbol + np.uint64(step + 1)) * self.factors[:, step, None]) >> np.uint64(63)
            at = np.minimum(at + bit.astype(np.int64), n)
        rng = np.random.default_rng((self.seed, n))
        out = np.empty((WALKS, TABLES, many), np.uint64)
        for walk in range(WALKS):
            for table in range(TABLES):
                places = rng.integers(0, 3 * n, PLACES)
                value = np.full(many, walk * TABLES + table + 1, np.uint64)
                for place, factor in zip(places, self.mix[table], strict=True):
                    value = (value ^ image[place, walk]) * factor
                    value ^= value >> np.uint64(29)
                out[walk, table] = value
        return out.reshape(WALKS * TABLES, many)


class Items:
    """A block of benchmark items: vocabulary, gates and hash tables by length."""

    def __init__(self, rows: list[tuple[int, str]], percent: int):
        self.percent = percent
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[int, list[int]]] = []
        for item_id, text in rows:
            ids = [self.vocabulary.setdefault(word, len(self.vocabulary) + 1) for word in words(text)]
            if ids:
                self.items.append((item_id, ids))
        self.gates: dict[int, dict[int, list[tuple[int, int]]]] = {}
        by_length: dict[int, list[int]] = defaultdict(list)
        for number, (_, ids) in enumerate(self.items):
            n, k = len(ids), allowed(len(ids), percent)
            size = min(GRAM, -(-(n - k) // (k + 1)))
            gate = self.gates.setdefault(size, {})
            codes = self._codes(np.array(ids, np.int64), size).tolist()
            for offset, code in enumerate(codes):
                gate.setdefault(code, []).append((number, offset))
            by_length[n].append(number)
        self.members = [np.unique(np.array(ids, np.int64)) for _, ids in self.items]
        self.keys = {size: np.array(sorted(gate), np.int64) for size, gate in self.gates.items()}
        self.embedding = Embedding(max(by_length, default=1))
        self.tables = {}
        for n, numbers in by_length.items():
            hashes = self.embedding.hashes(np.array([self.items[i][1] for i in numbers], np.int64))
            owner = np.tile(np.array(numbers), len(hashes))
            flat = hashes.ravel()
            order = np.argsort(flat, kind="stable")
            self.tables[n] = (flat[order], owner[order])

    def _codes(self, ids: np.ndarray, size: int) -> np.ndarray:
        code = np.zeros(len(ids) - size + 1, np.int64)
        for i in range(size):
            code = code * (len(self.vocabulary) + 2 if size * len(self.vocabulary).bit_length() < 60 else 1_000_003)
            code += ids[i : i + len(code)]
        return code

    def _own(self, number: int, ids: np.ndarray) -> np.ndarray:
        """1 where a word is one of the item's, else 0."""
        members = self.members[number]
        at = np.minimum(np.searchsorted(members, ids), len(members) - 1)
        return (members[at] == ids).astype(np.int64)

    def starts(self, ids: np.ndarray) -> dict[int, set[int]]:
        """By item length, where windows start that share a run with an item of that length."""
        out: dict[int, set[int]] = defaultdict(set)
        for size, keys in self.keys.items():
            if len(ids) < size or not len(keys):
                continue
            known = ids > 0
            all_known = known[: len(ids) - size + 1].copy()
            for i in range(1, size):
                all_known &= known[i : i + len(all_known)]
            at = np.flatnonzero(all_known)
            codes = self._codes(ids, size)[at]
            hit = keys[np.minimum(np.searchsorted(keys, codes), len(keys) - 1)] == codes
            gate = self.gates[size]
            for place, code in zip(at[hit].tolist(), codes[hit].tolist(), strict=True):
                for number, offset in gate[code]:
                    n = len(self.items[number][1])
                    k = allowed(n, self.percent)
                    low, high = max(0, place - offset - k), min(len(ids) - 1, place - offset + k)
                    # all but k words of the item stand in a window of n + k words, or it is too far
                    own = self._own(number, ids[low : high + n + k])
                    sums = np.concatenate(([0], np.cumsum(own)))
                    begins = np.arange(high - low + 1)
                    counts = sums[np.minimum(begins + n + k, len(own))] - sums[begins]
                    out[n].update((begins[counts >= n - k] + low).tolist())
        return out

    def matches(self, docs: list[np.ndarray]) -> list[dict[int, tuple[int, int, int]]]:
        """Per document the items found: item number to (distance, first word, number of words)."""
        out: list[dict[int, tuple[int, int, int]]] = [{} for _ in docs]
        wanted: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for d, ids in enumerate(docs):
            for n, starts in self.starts(ids).items():
                wanted[n] += [(d, start) for start in sorted(starts)]
        for n, places in wanted.items():
            for first in range(0, len(places), 4096):
                self._probe(n, places[first : first + 4096], docs, out)
        return out

    def _probe(self, n: int, places: list[tuple[int, int]], docs: list[np.ndarray], out: list[dict]) -> None:
        unknown = len(self.vocabulary) + 1
        windows = np.full((len(places), n), unknown, np.int64)
        for i, (d, start) in enumerate(places):
            part = docs[d][start : start + n]
            windows[i, : len(part)] = np.where(part > 0, part, unknown)
        keys, owners = self.tables[n]
        hashes = self.embedding.hashes(windows)
        flat = hashes.ravel()
        low = np.searchsorted(keys, flat, side="left")
        counts = np.searchsorted(keys, flat, side="right") - low
        spots = np.repeat(np.arange(len(flat)), counts)
        number = owners[np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(len(spots))]
        pairs = np.unique(np.stack([number, spots % len(places)], axis=1), axis=0)
        k = allowed(n, self.percent)
        longer = np.full((len(places), n + k), unknown, np.int64)
        for i, (d, start) in enumerate(places):
            part = docs[d][start : start + n + k]
            longer[i, : len(part)] = np.where(part > 0, part, unknown)
        cuts = np.flatnonzero(np.concatenate(([True], pairs[1:, 0] != pairs[:-1, 0], [True]))) if len(pairs) else [0]
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            item = self.items[int(pairs[first, 0])][1]
            number = int(pairs[first, 0])
            words_of = Counter(item)
            found_at = pairs[first:last, 1]
            found_at = found_at[self._own(number, longer[found_at]).sum(axis=1) >= n - k]
            same = (windows[found_at] == np.array(item)).all(axis=1)
            for window in found_at[same].tolist():
                d, start = places[window]
                now = (0, start, n)
                out[d][number] = min(now, out[d].get(number, now))
            for window in found_at[~same].tolist():
                d, start = places[window]
                best = out[d].get(number)
                if best is not None and best[0] == 0:
                    continue
                text = docs[d][start : start + n + k].tolist()
                if (Counter(text) & words_of).total() < n - k:
                    continue
                found = distance(item, text, k)
                if found is not None:
                    now = (found[0], start, found[1])
                    out[d][number] = min(now, best) if best else now


def _with_block(docs: DataFrame, rows: list[tuple[int, str]], percent: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(shared.value, percent)
        known = items.vocabulary.get
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                docs = []
                for text in batch.column("text").to_pylist():
                    tokens = words(text)
                    docs.append(np.fromiter((known(token, 0) for token in tokens), np.int64, len(tokens)))
                names = batch.column("doc_id").to_pylist()
                out: list[list] = [[], [], [], [], []]
                for name, found in zip(names, items.matches(docs), strict=True):
                    for number, (edits, start, many) in found.items():
                        for values, value in zip(out, (name, items.items[number][0], edits, start, many), strict=True):
                            values.append(value)
                columns = [pa.array(values, pa.int64()) for values in out]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "edits", "first_word", "n_words"])

    schema = "doc_id long, item_id long, edits long, first_word long, n_words long"
    return docs.mapInArrow(search, schema)


def leaks(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, edits, first_word, n_words): the best place of every item that a document holds.

    A document holds an item of n words if some run of its words is within n * (100 - percent) / 100
    word edits of it (rounded down); first_word and n_words name the place with the fewest edits, the
    earliest of these. Words are lower-case and separated by ASCII punctuation or white space. Items
    without words, and items without id, are held by nothing; null and empty texts hold nothing. Rows
    with a null doc_id are searched like others. Rows that repeat a doc_id may give the same pair again
    at another place; the best one is kept, and repeated rows change nothing.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") > 0)
    items = benchmark.where("item_id is not null and length(text) > 0").select(F.col("item_id").cast("long"), "text").distinct()
    blocks = -(-items.count() // MOST_ITEMS)
    found = []
    for block in range(max(1, blocks)):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks))) == block)
        rows = [(row["item_id"], row["text"]) for row in part.collect()]
        found.append(_with_block(docs, sorted(rows), percent))
    all_ = reduce(DataFrame.unionByName, found)
    best = all_.groupBy("doc_id", "item_id").agg(F.min(F.struct("edits", "first_word", "n_words")).alias("best"))
    return best.select("doc_id", "item_id", "best.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of docs that hold no benchmark item, with all their columns.

    Rows are matched by doc_id, so all rows of an id that holds an item go, and rows without id only
    if a row without id holds one.
    """
    gone = leaks(docs, benchmark, percent).select(F.col("doc_id").alias("leaking_id")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["leaking_id"]), "left_anti")
