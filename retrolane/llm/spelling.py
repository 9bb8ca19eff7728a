"""Spelling variants: generated edits probe Bloom filters, an exact join removes what passed wrongly.

Words are counted over all documents, first in each task, then in one shuffle. Each word sets bits in
the filter of its length: two words of 64 bits, chosen by its hash within one block, so that a probe
touches one cache line. The filters are merged by Spark and broadcast; their size follows from the
number of words, and past a bound on it the words are split by hash into rounds, each with filters of
its own, so that no broadcast grows beyond it.

Two words at one edit are found from one side only: a word is probed with each of its deletions (an
insertion is the other word's deletion) and with each replacement by a later letter. Hashes are sums
over the letters of a value for letter and place, so all edits of all words of one length are hashed
in a few array operations. Only edits that a filter lets through become text and are shuffled, to a
join with the vocabulary.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrolane.llm.common import stage

LEAST_LETTERS = 6
LEAST_TIMES = 5
TIMES_MORE = 5  # how much more often a form occurs than the word
DAMAGE = 199  # one occurrence in so many loses a letter; None: none does
BITS = 16  # of a filter for each word
BLOCK = 8  # 64-bit words of a block
FILTER_BYTES = 32_000_000  # broadcast at once; a larger vocabulary takes several rounds
HELD_WORDS = 300_000  # distinct words that a task counts before it hands them on
PROBE_CELLS = 2_000_000  # hashes of edits that a task holds at once

# The letters of a word, as Latin-1; A-Z count as a-z, everything else separates.
LETTERS = bytes([*range(65, 91), *range(97, 123), *range(0xC0, 0x100)])
FOLD = bytes(byte + 32 if 65 <= byte <= 90 else byte if byte in LETTERS else 32 for byte in range(256))
EDIT_LETTERS = np.array([*range(97, 123), *range(0xC0, 0x100)], np.uint8)
OTHERS = re.compile("[^\x00-\xff]")


def runs(text: str | None) -> list[bytes]:
    """Maximal runs of letters, A-Z lower-cased, in Latin-1. Characters above U+00FF separate."""
    if not text:
        return []
    if not text.isascii():
        text = OTHERS.sub(" ", text)
    return text.encode("latin-1").translate(FOLD).split()


def damaged(doc_id: int | None, run: bytes, every: int | None) -> bytes:
    """The run, without one letter if the checksum of document and run says so. Without an id it stays whole."""
    if every is None or doc_id is None:
        return run
    said = run if run.isascii() else run.decode("latin-1").encode()
    mark = zlib.crc32(said, zlib.crc32(b"%d:" % doc_id))
    if mark % every:
        return run
    at = mark % len(run)
    return run[:at] + run[at + 1 :]


def _counts(batches: Iterator[pa.RecordBatch], letters: int, every: int | None) -> Iterator[pa.RecordBatch]:
    """(word, n) of a task; a word comes again where the table was full in between."""
    held: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        words = pa.array([word.decode("latin-1") for word in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for run, n in Counter(runs(text.as_py())).items():
                if len(run) >= letters:
                    word = damaged(doc_id, run, every)
                    if len(word) >= letters:
                        held[word] += n
            if len(held) >= HELD_WORDS:
                yield out()
                held.clear()
    yield out()


def vocabulary(
    docs: DataFrame, letters: int = LEAST_LETTERS, times: int = LEAST_TIMES, every: int | None = DAMAGE
) -> DataFrame:
    """(word, n): words of at least so many letters that occur at least so often in all texts."""
    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: _counts(batches, letters, every), "word string, n long"
    )
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def _values() -> np.ndarray:
    """Odd random value of each letter; the value of a place multiplies it."""
    return np.random.default_rng(7).integers(1, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _places(length: int) -> np.ndarray:
    """Multiplier of each place of a word: powers of one odd number."""
    factor = np.full(length + 1, 0x9E3779B97F4A7C15, np.uint64)
    factor[0] = 1
    return np.multiply.accumulate(factor)


def _mixed(sums: np.ndarray) -> np.ndarray:
    out = sums ^ (sums >> np.uint64(32))
    out = out * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def letters_of(words: list[bytes]) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def hashes(words: np.ndarray) -> np.ndarray:
    """Hash of each row of letters."""
    values, places = _values(), _places(words.shape[1])
    return _mixed((values[words] * places[: words.shape[1]]).sum(axis=1, dtype=np.uint64))


def deletions(words: np.ndarray) -> np.ndarray:
    """(row, place): hash of the word without the letter of that place."""
    values, length = _values(), words.shape[1]
    places = _places(length)
    terms = values[words] * places[:length]
    shifted = np.zeros_like(terms)
    shifted[:, 1:] = values[words[:, 1:]] * places[: length - 1]
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    after = shifted.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(shifted, axis=1, dtype=np.uint64)
    return _mixed(before + after)


def replacements(words: np.ndarray, letters: np.ndarray, low: int = 0, high: int | None = None) -> np.ndarray:
    """(row, place from low to high, letter): hash of the word with that letter in that place."""
    values, length = _values(), words.shape[1]
    places = _places(length)[:length]
    terms = values[words] * places
    whole = terms.sum(axis=1, dtype=np.uint64)
    rest = whole[:, None] - terms[:, low:high]
    return _mixed(rest[:, :, None] + places[None, low:high, None] * values[letters][None, None, :])


class Filters:
    """Blocked Bloom filters, one for each length, laid out one after the other in 64-bit words."""

    def __init__(self, sizes: dict[int, int], rounds: int):
        """sizes: number of words of each length that this round may hold."""
        self.rounds = rounds
        self.blocks = {length: max(1, -(-many * BITS // (64 * BLOCK))) for length, many in sorted(sizes.items())}
        self.starts: dict[int, int] = {}
        self.words = 0
        for length, blocks in self.blocks.items():
            self.starts[length] = self.words
            self.words += blocks * BLOCK

    def group(self, hashed: np.ndarray) -> np.ndarray:
        """The round that a hash belongs to."""
        return (hashed >> np.uint64(48)) % np.uint64(self.rounds)

    def bits(self, length: int, hashed: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each of two 64-bit words: its place and the bits (three of them) that a hash sets in it."""
        block = (hashed >> np.uint64(20)) % np.uint64(self.blocks[length]) * np.uint64(BLOCK)
        again = hashed * np.uint64(0xC2B2AE3D27D4EB4F)
        start = np.uint64(self.starts[length])
        out = []
        for shift in (0, 24):
            near = again >> np.uint64(shift)
            place = start + block + (near & np.uint64(BLOCK - 1))
            mask = np.zeros_like(near)
            for low in (3, 9, 15):
                mask |= np.uint64(1) << (near >> np.uint64(low) & np.uint64(63))
            out.append((place.astype(np.int64), mask))
        return out

    def have(self, table: np.ndarray, length: int, hashed: np.ndarray) -> np.ndarray:
        """Whether a hash may be of a word of that length."""
        (first, mask), (second, more) = self.bits(length, hashed)
        out = table[first] & mask == mask
        left = np.nonzero(out)[0]
        out[left] = table[second[left]] & more[left] == more[left]
        return out


def _by_length(words: list[bytes]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for at, word in enumerate(words):
        out.setdefault(len(word), []).append(at)
    return out


def _latin(column: pa.Array) -> list[bytes]:
    return [word.encode("latin-1") for word in column.to_pylist()]


def _filter_bits(filters: Filters, number: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, bits) that the words of a task set in the filters of one round."""
    for batch in batches:
        words = _latin(batch.column(0))
        table: dict[int, int] = {}
        for length, rows in _by_length(words).items():
            hashed = hashes(letters_of([words[at] for at in rows]))
            hashed = hashed[filters.group(hashed) == number]
            for places, masks in filters.bits(length, hashed):
                order = np.argsort(places, kind="stable")
                found, first = np.unique(places[order], return_index=True)
                if len(found):
                    for place, mask in zip(found.tolist(), np.bitwise_or.reduceat(masks[order], first).tolist(), strict=True):
                        table[place] = table.get(place, 0) | mask
        bits = np.fromiter(table.values(), np.uint64, len(table)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(table), pa.int64()), pa.array(bits)], ["place", "bits"])


def _probes(
    filters: Filters, number: int, table: np.ndarray, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """(edit, word, n): the edits of a task's words that the filters of one round let through."""
    for batch in batches:
        words, times = _latin(batch.column(0)), batch.column(1).to_numpy()
        for length, rows in _by_length(words).items():
            step = max(1, PROBE_CELLS // (length * len(EDIT_LETTERS)))
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                letters = letters_of([words[row] for row in part])
                edits: list[bytes] = []
                owners: list[int] = []
                if length - 1 in filters.blocks:
                    hashed = deletions(letters)
                    # a run of one letter gives one word, whichever letter of the run goes
                    asked = np.ones(letters.shape, bool)
                    asked[:, 1:] = letters[:, 1:] != letters[:, :-1]
                    row, place = np.nonzero(asked & (filters.group(hashed) == number))
                    good = filters.have(table, length - 1, hashed[row, place])
                    for r, p in zip(row[good].tolist(), place[good].tolist(), strict=True):
                        word = words[part[r]]
                        edits.append(word[:p] + word[p + 1 :])
                        owners.append(part[r])
                # a very long word is worked on in ranges of its places
                span = max(1, PROBE_CELLS // (len(part) * len(EDIT_LETTERS)))
                for low in range(0, length, span):
                    hashed = replacements(letters, EDIT_LETTERS, low, low + span)
                    later = EDIT_LETTERS[None, None, :] > letters[:, low : low + span, None]
                    row, place, letter = np.nonzero(later & (filters.group(hashed) == number))
                    good = filters.have(table, length, hashed[row, place, letter])
                    for r, p, c in zip(row[good].tolist(), (place[good] + low).tolist(), letter[good].tolist(), strict=True):
                        word = words[part[r]]
                        edits.append(word[:p] + EDIT_LETTERS[c : c + 1].tobytes() + word[p + 1 :])
                        owners.append(part[r])
                said = [pa.array([w.decode("latin-1") for w in edits], pa.string())]
                said.append(pa.array([words[o].decode("latin-1") for o in owners], pa.string()))
                said.append(pa.array(times[owners], pa.int64()))
                yield pa.RecordBatch.from_arrays(said, ["edit", "word", "n"])


def near(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, other, other_n): both directions of every pair of words at exactly one edit.

    words has word (a run of letters as `runs` gives, without repeats) and n, and should be a stored
    table, as it is read several times. Words of any length are compared, empty ones excepted.
    """
    spark = words.sparkSession
    sizes = {row[0]: row[1] for row in words.groupBy(F.length("word")).count().collect() if row[0]}
    rounds = max(1, -(-sum(sizes.values()) * BITS // (8 * filter_bytes)))
    filters = Filters({length: -(-many // rounds) for length, many in sizes.items()}, rounds)
    words = words.where(F.length("word") > 0).select("word", "n")
    out = spark.createDataFrame([], "word string, n long, other string, other_n long")
    for number in range(rounds if sizes else 0):
        bits = words.mapInArrow(lambda batches, number=number: _filter_bits(filters, number, batches), "place long, bits long")
        told = bits.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
        table = np.zeros(filters.words, np.uint64)
        table[told.column("place").to_numpy()] = told.column("bits").to_numpy().view(np.uint64)
        known = spark.sparkContext.broadcast(table)
        edits = words.mapInArrow(
            lambda batches, number=number, known=known: _probes(filters, number, known.value, batches),
            "edit string, word string, n long",
        )
        exact = words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
        pair = edits.join(exact, "edit")
        both = F.array(
            F.struct(F.col("word"), F.col("n"), F.col("edit").alias("other"), F.col("edit_n").alias("other_n")),
            F.struct(F.col("edit").alias("word"), F.col("edit_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")),
        )
        found = pair.select(F.inline(both))
        out = found if number == 0 else out.unionByName(found)
    return out


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following (word, form) ends. Each step joins ways of twice the length."""
    way = forms.select("word", F.col("form").alias("root"))
    while True:
        further = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        way = stage(
            way.join(further, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "roots",
        )
        if way.where("moved").isEmpty():
            return way.select("word", "root")
        way = way.select("word", "root")


def variants(
    docs: DataFrame,
    letters: int = LEAST_LETTERS,
    times: int = LEAST_TIMES,
    times_more: int = TIMES_MORE,
    every: int | None = DAMAGE,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of docs (doc_id, text).

    A word's form is its near word of largest n (equal ones: the smallest in code-point order) if that
    occurs times_more times as often at least; root is where the forms lead from the word, itself
    without a form. Other columns of docs are left out, whatever their names. A null or empty text has
    no words; a row without doc_id loses no letter; repeated rows count each time; an empty table has
    no words. Texts are read whole; a task counts in a table of at most about HELD_WORDS words.
    """
    words = stage(vocabulary(docs, letters, times, every), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    grouped = near(words, filter_bytes).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(grouped, "word", "left")
    fits = -F.col("best.less") >= F.col("n") * times_more
    told = stage(
        joined.select(
            "word",
            F.when(fits, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(told.where("form IS NOT NULL"))
    out = told.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")
