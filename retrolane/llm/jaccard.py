"""Set-similarity join of documents on word shingles, by size-banded tiles and bitmap signatures.

Copies of a set become one class first. Every class then goes to one tile per shingle of its
prefix: the first n - ceil(s * n) + 1 of its n shingles in one global order, of which any two sets
of similarity s share one. The order puts rare shingles first: a share of all shingles, chosen by hash and
larger than a prefix, is counted exactly over all documents, and its frequent ones come late. Inside a tile two sets are compared if their sizes allow the similarity and
their bitmaps do: bit b of a bitmap says whether an odd number of the shingles hash to b, so
differing bits bound the symmetric difference from below and the overlap from above. Tiles carry 128
bits, large ones 512; pairs that pass are held to bitmaps as wide as the sets are large. What still passes is decided by intersecting the exact sorted arrays.

Large tiles are compared in two rounds. The first pairs each set with the first and the next one
of the tile by size. Its links give components; the second round deals the tile out by size band
and compares only sets of different components, so a tile of k mutual near copies costs about 2 k
comparisons while no link between components can be missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrolane.llm.common import components, stage

LOWER = bytes(byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))
MOST_WORDS = 500_000  # word hashes that a task remembers
SMALL_TILE = 3  # tiles up to this size are compared whole at once
HEAVY_BATCH = 4096  # documents whose shingles are counted at once
BUCKET_ROWS = 4096  # documents for each bucket of counts, of which there are at least 1,024
MOST_HEAVY = 2_000_000  # frequent shingles told to every task, nine bytes each; the others count as rare
UNKNOWN_LEVEL = 32  # of shingles that are not counted: as if 16 documents held them
MOST_TOLD = 4_000_000  # document ids told to every task; beyond that they are joined
BLOCK = 1024
MID_BITS = 512  # of the bitmaps in large tiles


class Shingler:
    """Sorted distinct 64-bit hashes of the word n-grams of a text; of all its words if there are fewer."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}
        self.factors = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64) | 1 for i in range(words)], dtype=np.uint64)

    def _hashes(self, tokens: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > MOST_WORDS:
            known.clear()
        for token in set(tokens).difference(known):
            known[token] = int.from_bytes(hashlib.blake2b(token, digest_size=8).digest(), "little")
        return np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = text.encode().translate(LOWER).split() if text else []
        if not tokens:
            return np.zeros(0, np.uint64)
        hashes = self._hashes(tokens)
        width = min(self.words, len(tokens))
        many = len(tokens) - width + 1
        mixed = np.full(many, width, dtype=np.uint64)
        for i in range(width):
            mixed = (mixed ^ (hashes[i : i + many] * self.factors[i])) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


def least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def parity(shingles: np.ndarray) -> tuple[int, int]:
    """The bitmap of a set: 128 bits as two signed longs."""
    bits = np.bincount((shingles >> np.uint64(20)).astype(np.int64) & 127, minlength=128) & 1
    low, high = np.packbits(bits.astype(np.uint8)).view(np.int64).tolist()
    return low, high


def wide_parity(shingles: np.ndarray, width: int | None = None) -> bytes:
    """A bitmap like parity's of the given width, else with as many bits as the set has elements, a power of two."""
    width = width or (max(128, 1 << (len(shingles) - 1).bit_length()) if len(shingles) else 128)
    bits = np.bincount((shingles >> np.uint64(20)).astype(np.int64) & (width - 1), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def apart(left: bytes, right: bytes) -> int:
    """Bits in which two wide bitmaps differ; the wider one is folded, which keeps parity."""
    x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _counted_share(percent: int) -> int:
    """Of 256 classes of shingles how many are counted: two and a half times what a prefix takes, at least 1."""
    return min(256, max(1, -(-256 * 5 * (100 - percent) // 200)))


def _counted(shingles: np.ndarray, share: int) -> np.ndarray:
    return (shingles >> np.uint64(56)) < np.uint64(share)


def _names(shingles: np.ndarray, buckets: int) -> np.ndarray:
    """What a shingle is counted under: its bucket and 32 more bits, in the shingles' order. Few share a name."""
    return shingles >> np.uint64(33 - buckets.bit_length())


def _counts(docs: DataFrame, words: int, share: int, buckets: int) -> DataFrame:
    """Names of shingles that more than SMALL_TILE rows hold, with their number of rows.

    It is exact for the share that is counted; of the others only those count that are repeated in a batch
    of documents. Batches send, by bucket, the names that they hold once in four bytes each, and the others
    with their number.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in _pieces(batches, HEAVY_BATCH):
            sets = [shingler(text) for text in batch.column("text").to_pylist()]
            found, times = np.unique(np.concatenate(sets), return_counts=True)
            sent = _counted(found, share) | (times > 1)
            found, times = _names(found[sent], buckets), times[sent]
            cuts = np.searchsorted(found, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
            full = np.flatnonzero(np.diff(cuts))
            low, times = found.astype(np.uint32), times.astype(np.uint32)
            once, more = [], []
            for start, end in zip(cuts[full], cuts[full + 1], strict=True):
                many = times[start:end] > 1
                once.append(low[start:end][~many].tobytes())
                more.append(np.stack([low[start:end][many], times[start:end][many]]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int64()), pa.array(once, pa.binary()), pa.array(more, pa.binary())], ["bucket", "once", "more"]
            )

    def totals(table: pa.Table) -> pa.Table:
        once = [np.frombuffer(blob.as_buffer(), np.uint32) for blob in table.column("once")]
        more = [np.frombuffer(blob.as_buffer(), np.uint32).reshape(2, -1) for blob in table.column("more")]
        once, (low, times) = np.concatenate(once), np.concatenate(more, axis=1)
        names, place = np.unique(np.concatenate([once, low]), return_inverse=True)
        sums = np.bincount(place[: len(once)], minlength=len(names))
        sums = sums + np.bincount(place[len(once) :], weights=times, minlength=len(names)).astype(np.int64)
        often = sums > SMALL_TILE
        names = names[often].astype(np.int64) | (table.column("bucket")[0].as_py() << 32)
        return pa.table({"name": pa.array(names), "times": pa.array(sums[often].astype(np.int64))})

    sent = docs.select("text").mapInArrow(parts, "bucket long, once binary, more binary")
    return sent.groupBy("bucket").applyInArrow(totals, "name long, times long")


def _heavy(docs: DataFrame, words: int, percent: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """What orders the shingles: the share that is counted, buckets, sorted names of frequent ones, their levels.

    A level is eight times the binary logarithm of the count. The most frequent levels are told as far as
    they have at most MOST_HEAVY names. They only steer which shingles come last in the global order, which
    is right for any order.
    """
    share = _counted_share(percent)
    buckets = 1 << max(10, (docs.count() // BUCKET_ROWS).bit_length())
    level = F.least(F.floor(F.log2(F.col("times").cast("double")) * 8), F.lit(255)).cast("int")
    counts = stage(_counts(docs, words, share, buckets).select("name", level.alias("level")), "counts")
    sizes = counts.groupBy("level").count().orderBy(F.desc("level")).collect()  # at most 256 rows
    least, told = 256, 0
    for row in sizes:
        told += row["count"]
        if told > MOST_HEAVY:
            break
        least = row["level"]
    rows = counts.where(F.col("level") >= least).toArrow()
    names = rows.column("name").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(names)
    return share, buckets, names[order], rows.column("level").to_numpy().astype(np.uint8)[order]


def _in_order(found: np.ndarray, share: int, buckets: int, names: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """A set's sorted shingles in the global order: counted ones that are not frequent, the others, frequent ones."""
    if not len(names):
        return found  # those that are counted have the smallest hashes
    mine = _names(found, buckets)
    at = np.minimum(np.searchsorted(names, mine), len(names) - 1)
    told = names[at] == mine
    if not told.any():
        return found
    counted = _counted(found, share)
    weight = np.where(counted, 0, UNKNOWN_LEVEL).astype(np.uint8)
    weight[told] = np.where(counted[told], levels[at[told]], np.maximum(levels[at[told]], UNKNOWN_LEVEL + 1))
    return found[np.argsort(weight, kind="stable")]


def _marks(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Per row: its set's size, 128-bit name, bitmap and prefix."""
    heavy = docs.sparkSession.sparkContext.broadcast(_heavy(docs, words, percent))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in _pieces(batches):
            sizes, sets, bits, prefixes, wide, mid = [], [], [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingler(text)
                n = len(found)
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                sizes.append(n)
                sets.append(np.frombuffer(digest, np.int64).tolist())
                bits.append(parity(found))
                wide.append(wide_parity(found))
                mid.append(wide_parity(found, MID_BITS))
                long = n - least_overlap(n, percent) + 1 if n else 0
                found = _in_order(found, *heavy.value)
                prefixes.append(found[:long].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    *(pa.array([s[i] for s in sets], pa.int64()) for i in (0, 1)),
                    *(pa.array([b[i] for b in bits], pa.int64()) for i in (0, 1)),
                    pa.array(prefixes, pa.list_(pa.int64())),
                    pa.array(wide, pa.binary()),
                    pa.array(mid, pa.binary()),
                ],
                ["doc_id", "n", "set_a", "set_b", "bits_a", "bits_b", "prefix", "wide", "mid"],
            )

    schema = "doc_id long, n long, set_a long, set_b long, bits_a long, bits_b long, prefix array<long>, wide binary, mid binary"
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def _may_link(n: np.ndarray, bits: np.ndarray, m: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes n, m and bitmaps leave room for the similarity."""
    apart = np.bitwise_count((bits ^ other).view(np.uint64)).sum(axis=-1, dtype=np.int64)
    both = n + m
    # similarity s of sets with n + m elements: at most (1 - s) / (1 + s) of them lie in one set only
    return (apart * (100 + percent) <= (100 - percent) * both) & (
        np.minimum(n, m) * 100 >= percent * np.maximum(n, m)
    )


class _Tiles:
    """Cuts batches sorted by a key into whole runs of that key, carrying the last one over."""

    def __init__(self, names: list[str], keys: int):
        self.names, self.keys = names, keys

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
        """Columns of whole runs and where the runs begin (with the end)."""
        waiting: list[dict[str, np.ndarray]] = []
        for batch in batches:
            columns = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in self.names}
            if not batch.num_rows:
                continue
            cuts = self._cuts(columns)
            if waiting and not all(columns[k][0] == waiting[-1][k][-1] for k in self.names[: self.keys]):
                yield self._whole(waiting)
                waiting = []
            if len(cuts) > 2:
                first = {name: column[: cuts[-2]] for name, column in columns.items()}
                yield self._whole([*waiting, first])
                waiting = []
            waiting.append({name: column[cuts[-2] :] for name, column in columns.items()})
        if waiting:
            yield self._whole(waiting)

    def _cuts(self, columns: dict[str, np.ndarray]) -> np.ndarray:
        keys = [columns[name] for name in self.names[: self.keys]]
        new = np.zeros(max(0, len(keys[0]) - 1), dtype=bool)
        for key in keys:
            new |= key[1:] != key[:-1]
        return np.concatenate(([0], np.flatnonzero(new) + 1, [len(keys[0])]))

    def _whole(self, parts: list[dict[str, np.ndarray]]) -> tuple[dict[str, np.ndarray], np.ndarray]:
        columns = {name: np.concatenate([part[name] for part in parts]) for name in self.names}
        return columns, self._cuts(columns)


def _pairs_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])


def _first_round(tiles: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of small tiles, and of large ones those with the first and the next set by size.

    The members (a) of large tiles follow, with their key, for the second round.
    """
    cut = _Tiles(["key", "n", "doc_id", "bits_a", "bits_b"], 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, cuts in cut(batches):
            n, doc = columns["n"], columns["doc_id"]
            bits = np.stack([columns["bits_a"], columns["bits_b"]], axis=1)
            sizes = np.diff(cuts)
            run = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(run)) - cuts[:-1][run]
            left, right = [], []
            for step in range(1, SMALL_TILE):
                near = place >= step
                if step > 1:
                    near &= sizes[run] <= SMALL_TILE
                j = np.flatnonzero(near)
                if not len(j):
                    break
                left.append(j - step)
                right.append(j)
            j = np.flatnonzero((sizes[run] > SMALL_TILE) & (place > 0))
            i, j = np.concatenate([*left, cuts[:-1][run[j]]]), np.concatenate([*right, j])
            good = _may_link(n[i], bits[i], n[j], bits[j], percent)
            pairs = _pairs_batch(doc[i[good]], doc[j[good]])
            none = pa.nulls(len(pairs), pa.int64())
            yield pa.RecordBatch.from_arrays([*pairs.columns, none, none], names)
            big = sizes[run] > SMALL_TILE
            none = pa.nulls(int(np.count_nonzero(big)), pa.int64())
            kept = [pa.array(columns[name][big]) for name in ("doc_id", "key", "n")]
            yield pa.RecordBatch.from_arrays([kept[0], none, *kept[1:]], names)

    names = ["a", "b", "key", "n"]
    return tiles.mapInArrow(rows, "a long, b long, key long, n long")


def _second_round(tiles: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of large tiles between components, band by band; a visitor comes from the next band."""
    cut = _Tiles(["key", "band", "guest", "doc_id", "n", "mid", "component"], 2)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, cuts in cut(batches):
            n, doc, part, guest = columns["n"], columns["doc_id"], columns["component"], columns["guest"]
            bits = np.frombuffer(b"".join(columns["mid"]), np.int64).reshape(len(n), -1)
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if part[start] == part[end - 1] and (part[start:end] == part[start]).all():
                    continue
                own = start + int(np.count_nonzero(guest[start:end] == 0))
                for i in range(start, own, BLOCK):
                    rows_i = np.arange(i, min(i + BLOCK, own))
                    for j in range(i, end, BLOCK):
                        rows_j = np.arange(j, min(j + BLOCK, end))
                        p, q = np.nonzero((part[rows_i][:, None] != part[rows_j][None, :]) & (rows_i[:, None] < rows_j[None, :]))
                        p, q = rows_i[p], rows_j[q]
                        good = _may_link(n[p], bits[p], n[q], bits[q], percent)
                        if good.any():
                            yield _pairs_batch(doc[p[good]], doc[q[good]])

    return tiles.mapInArrow(rows, "a long, b long")


def _arrays(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles) of the documents named in ids: told to the tasks if few, else joined."""
    spark = docs.sparkSession
    if ids.count() <= MOST_TOLD:
        told = spark.sparkContext.broadcast(np.sort(ids.toArrow().column("doc_id").to_numpy()))
    else:
        docs, told = docs.join(ids, "doc_id", "left_semi"), None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in _pieces(batches):
            if told is not None:
                mine = batch.column("doc_id").to_numpy(zero_copy_only=False)
                batch = batch.filter(pa.array(np.isin(mine, told.value)))
            data = [shingler(text).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "shingles"])

    named = docs.where("doc_id is not null").select("doc_id", "text")
    return named.mapInArrow(rows, "doc_id long, shingles binary")


def _close(pairs: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """The pairs that the wide bitmaps leave room for."""
    left, right = (
        firsts.select(F.col("doc_id").alias(name), F.struct("n", "wide").alias(f"of_{name}")) for name in ("a", "b")
    )
    sides = pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist(), strict=True):
                most = (100 - percent) * (x["n"] + y["n"])
                keep.append(apart(x["wide"], y["wide"]) * (100 + percent) <= most)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return sides.mapInArrow(rows, "a long, b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose sorted arrays intersect enough."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    arrays = stage(_arrays(docs, ids, words), "shingles")
    sides = pairs.join(arrays.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left")), "a")
    sides = sides.join(arrays.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right")), "b")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in (left, right))
                shared = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x) if len(y) else 0
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return sides.select("a", "b", "left", "right").mapInArrow(rows, "a long, b long")


def link(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of documents (doc_id, text).

    Two documents link when their sets of word shingles have a Jaccard similarity of at least
    percent / 100; component_id is the smallest doc_id reachable by links, the own one included.
    Words are separated by ASCII white space and compared with A-Z in lower case. A text with fewer
    words than a shingle has its whole sequence as one; null, empty and blank texts have no shingle
    and link with nothing. A null doc_id links with nothing and has a null component. Every row
    has one result row; a row that repeats a doc_id takes part with its own text under the same id.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    marks = stage(_marks(named, words, percent), "marks")
    sets = marks.where("n > 0 and doc_id is not null").groupBy("set_a", "set_b")
    sets = sets.agg(F.min("doc_id").alias("first"))
    joined = marks.where("n > 0").join(sets, ["set_a", "set_b"])
    firsts = joined.where("doc_id = first").dropDuplicates(["set_a", "set_b"])
    firsts = stage(firsts.select("doc_id", "n", "bits_a", "bits_b", "prefix", "wide", "mid"), "firsts")
    tiles = firsts.select(F.explode("prefix").alias("key"), "n", "doc_id", "bits_a", "bits_b")
    tiles = tiles.repartition("key").sortWithinPartitions("key", "n", "doc_id")
    found = stage(_first_round(tiles, percent), "tiles")
    pairs = _close(found.where("b is not null").select("a", "b").distinct(), firsts, percent)
    links = stage(_verified(stage(pairs, "pairs"), named, words, percent), "links")
    known = stage(components(links), "known")

    large = found.where("b is null").select("key", F.col("a").alias("doc_id"), "n")
    large = large.join(known.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    large = large.withColumn("component", F.coalesce("component", "doc_id"))
    # tiles of one component have nothing to compare
    open_ = large.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    large = large.join(open_.where("low < high").select("key"), "key", "left_semi")
    large = large.join(firsts.select("doc_id", "n", "mid"), ["doc_id", "n"])
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent) * 1.0001))
    sides = F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))
    large = large.withColumn("band", band).withColumn("guest", F.explode(sides))
    large = large.withColumn("band", F.col("band") - F.col("guest"))
    large = large.select("key", "band", "guest", "doc_id", "n", "mid", "component")
    large = large.repartition("key", "band").sortWithinPartitions("key", "band", "guest", "n", "doc_id")
    more = stage(_close(_second_round(large, percent).distinct(), firsts, percent), "pairs")
    if not more.isEmpty():
        links = links.unionByName(stage(_verified(more, named, words, percent), "links"))
        known = stage(components(links), "known")

    sets = sets.join(known, F.col("first") == F.col("node"), "left")
    sets = sets.select("set_a", "set_b", F.coalesce("component", "first").alias("component_id"))
    out = marks.join(sets, ["set_a", "set_b"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def without_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of its component; rows without doc_id stay.

    All columns are kept as they are. Repeated rows of a doc_id that stays all stay.
    """
    gone = link(docs, words, percent).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[f"`{name}`" for name in docs.columns])
