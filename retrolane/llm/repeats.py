"""Exact repeats across documents by a logarithmic family of suffix arrays.

A repeat of min_bytes bytes has, in every document it lies in, the same smallest hash among its
k-grams: its anchor. So all windows of min_bytes bytes are dealt out by their anchor, and equal
windows meet. Neighbouring windows with one anchor travel as one context, the bytes they span
together. Contexts whose anchor occurs in one document alone can't repeat and aren't sent at all.

Where contexts arrive they are read by ascending document, in batches. A batch is sorted into a
suffix array (of the suffixes that windows begin, compared on their first min_bytes bytes), is
merge-scanned against the arrays of the existing levels for matches of full length, and joins the
family as a new level; levels of about equal size merge, so there are only logarithmically many. An
array holds its contexts' bytes and an offset of four bytes for each window; suffixes become text
only in blocks, while they are compared.

Copies of a whole text are settled first, by their hash, and take no part in this.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrolane.llm.common import stage

MIN_BYTES = 50
GRAM = 16
PIECE = 4 << 20  # bytes of text looked at together
SLICE = 8 << 20  # longer documents are looked at in slices
BUCKET = 16 << 20  # bytes of text behind one bucket of anchors
BATCH = 400_000  # windows of a batch
BLOCK = 1 << 16  # suffixes of a block of a merge scan
KNOWN_BYTES = 16_000_000  # contexts that a task remembers whole, their overhead included
MOST_TOLD = 1_000_000  # ids that may be broadcast
SPOT = np.uint64((1 << 24) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    return x


def _windows(data: bytes, ends: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of texts laid end to end: first and last window start of each, and its anchor's hash."""
    n = len(data) - min_bytes + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    grams = len(data) - GRAM + 1
    raw = np.frombuffer(data, np.uint8)
    eight = np.lib.stride_tricks.as_strided(raw[:8].view("<u8"), (len(data) - 7,), (1,)).copy()
    hashes = _mixed(eight[:grams] * np.uint64(0x9E3779B97F4A7C15) + _mixed(eight[8 : 8 + grams] * np.uint64(0xC2B2AE3D27D4EB4F)))
    del eight
    low = (hashes & ~SPOT) | np.arange(grams, dtype=np.uint64)
    wide, span = min_bytes - GRAM + 1, 1
    while span < wide:
        step = min(span, wide - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    good = np.zeros(n, dtype=bool)
    begin = 0
    for end in ends.tolist():
        if end - begin >= min_bytes:
            good[begin : end - min_bytes + 1] = True
        begin = end
    at = np.flatnonzero(good)
    if not len(at):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    anchor = (low[at] & SPOT).astype(np.int64)
    new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)) + 1
    first = np.concatenate(([0], new))
    last = np.concatenate((new, [len(at)])) - 1
    return at[first], at[last], hashes[anchor[first]]


def contexts(texts: list[bytes], min_bytes: int = MIN_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, first start, last start, anchor hash) of all windows of the texts, in groups of texts."""
    i = 0
    while i < len(texts):
        if len(texts[i]) > SLICE:
            for at in range(0, len(texts[i]), SLICE):
                part = texts[i][at : at + SLICE + min_bytes - 1]
                first, last, hashes = _windows(part, np.array([len(part)]), min_bytes)
                yield np.full(len(first), i), first + at, last + at, hashes
            i += 1
            continue
        j, total = i, 0
        while j < len(texts) and len(texts[j]) <= SLICE and (j == i or total + len(texts[j]) <= PIECE):
            total += len(texts[j])
            j += 1
        ends = np.cumsum([len(text) for text in texts[i:j]])
        first, last, hashes = _windows(b"".join(texts[i:j]), ends, min_bytes)
        owner = np.searchsorted(ends, first, side="right")
        begins = np.concatenate(([0], ends))[owner]
        yield owner + i, first - begins, last - begins, hashes
        i = j


def _planes(values: np.ndarray) -> bytes:
    """The bytes of numbers, all first bytes first: near-constant high bytes then compress away."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unplanes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _texts(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, [text.as_buffer().to_pybytes() if text.is_valid else b"" for text in part.column("text")]


def _anchors(docs: DataFrame, buckets: int, min_bytes: int) -> DataFrame:
    """Anchors by bucket, packed: 48 bits of the hash, document and first window."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for owner, first, _, hashes in contexts(texts, min_bytes):
                bucket = (hashes % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                names, cuts = np.unique(bucket[order], return_index=True)
                out: list[list] = [[], [], [], []]
                for name, part in zip(names.tolist(), np.split(order, cuts[1:]), strict=True):
                    held, inside = np.unique(owner[part], return_inverse=True)
                    out[0].append(name)
                    short = (hashes[part] >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                    out[1].append(short)
                    out[2].append(_planes(ids[held]))
                    out[3].append(_planes(np.stack([inside.astype("<u4"), first[part].astype("<u4")], axis=1)))
                kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
                columns = [pa.array(values, kind) for values, kind in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "hashes", "ids", "spots"])

    return docs.select("doc_id", "text").mapInArrow(rows, "bucket long, hashes binary, ids binary, spots binary")


def _shared(anchors: DataFrame) -> DataFrame:
    """(doc_id, first) of the contexts whose anchor lies in more than one document."""

    def rows(group: pd.DataFrame) -> pd.DataFrame:
        hashes, owners, firsts = [], [], []
        for short, ids, spots in zip(group["hashes"], group["ids"], group["spots"], strict=True):
            full = np.zeros((len(short) // 6, 8), np.uint8)
            full[:, :6] = np.frombuffer(short, np.uint8).reshape(-1, 6)
            hashes.append(full.view("<u8").ravel())
            inside, first = np.ascontiguousarray(np.frombuffer(spots, np.uint8).reshape(8, -1).T).view("<u4").T
            owners.append(_unplanes(ids, "<i8")[inside])
            firsts.append(first)
        hashes, owners, firsts = np.concatenate(hashes), np.concatenate(owners), np.concatenate(firsts)
        order = np.argsort(hashes, kind="stable")
        sorted_, owner = hashes[order], owners[order]
        cuts = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
        many = np.minimum.reduceat(owner, cuts) < np.maximum.reduceat(owner, cuts)
        keep = np.repeat(many, np.diff(np.concatenate((cuts, [len(order)]))))
        return pd.DataFrame({"doc_id": owner[keep], "first": firsts[order][keep].astype(np.int64)})

    return anchors.groupBy("bucket").applyInPandas(rows, "doc_id long, first long")


def _sent(docs: DataFrame, min_bytes: int) -> DataFrame:
    """The bytes of the contexts named in firsts, dealt by anchor."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches, 512):
            ids, tags = batch.column("doc_id"), batch.column("tag")
            wanted = [np.unique(v.values.to_numpy(zero_copy_only=False)) for v in batch.column("firsts")]
            for owner, first, last, hashes in contexts(texts, min_bytes):
                keep = np.zeros(len(owner), dtype=bool)
                cuts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1], [True]))) if len(owner) else [0]
                for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                    keep[start:end] = np.isin(first[start:end], wanted[owner[start]])
                at = np.flatnonzero(keep)
                if len(at):
                    parts = [
                        texts[o][a : b + min_bytes]
                        for o, a, b in zip(owner[at].tolist(), first[at].tolist(), last[at].tolist(), strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(hashes[at].view(np.int64)),
                            ids.take(pa.array(owner[at])),
                            tags.take(pa.array(owner[at])),
                            pa.array(first[at]),
                            pa.array(parts, pa.binary()),
                        ],
                        names=["anchor", "doc_id", "tag", "first", "context"],
                    )

    schema = "anchor long, doc_id long, tag long, first long, context binary"
    return docs.select("doc_id", "tag", "text", "firsts").mapInArrow(rows, schema)


class SuffixArray:
    """Some suffixes of a run of bytes, sorted by their first `wide` bytes: an offset of four bytes each."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, wide: int):
        self.data, self.starts, self.wide = data, starts, wide

    def __len__(self) -> int:
        return len(self.starts)

    def heads(self, begin: int, end: int) -> np.ndarray:
        """The first bytes of the suffixes at some places of the array."""
        wide = self.wide
        windows = np.lib.stride_tricks.as_strided(self.data[:wide].view(f"S{wide}"), (len(self.data) - wide + 1,), (1,))
        return windows[self.starts[begin:end]]

    def places(self, other: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
        """By a merge scan in blocks: how many suffixes lie before each of another array's, and which of those stand here.

        Both arrays are gone through once, from their first blocks to their last; only a block of
        each is held as text.
        """
        at = np.full(len(other), len(self), np.int64)
        found = np.zeros(len(other), dtype=bool)
        done = 0
        for begin in range(0, len(self), BLOCK):
            block = self.heads(begin, begin + BLOCK)
            while done < len(other):
                some = other.heads(done, done + BLOCK)
                upto = int(np.searchsorted(some, block[-1], side="right"))
                near = np.searchsorted(block, some[:upto])
                at[done : done + upto] = begin + near
                found[done : done + upto] = block[near] == some[:upto]
                done += upto
                if upto < len(some):
                    break
            if done == len(other):
                break
        return at, found

    def merged(self, other: SuffixArray) -> SuffixArray:
        """Both arrays as one, over the bytes of both."""
        at = self.places(other)[0] + np.arange(len(other))
        starts = np.empty(len(self) + len(other), np.uint32)
        own = np.ones(len(starts), dtype=bool)
        own[at] = False
        starts[own] = self.starts
        starts[at] = other.starts + np.uint32(len(self.data))
        return SuffixArray(np.concatenate([self.data, other.data]), starts, self.wide)


class SuffixFamily:
    """Levels of suffix arrays; each level is at least twice as long as the next one."""

    def __init__(self) -> None:
        self.levels: list[SuffixArray] = []

    def holds(self, batch: SuffixArray) -> np.ndarray:
        """Which suffixes of a batch stand in some level, by a merge scan of each."""
        found = np.zeros(len(batch), dtype=bool)
        for level in self.levels:
            found |= level.places(batch)[1]
        return found

    def add(self, batch: SuffixArray) -> None:
        """Takes in distinct suffixes that no level holds; offsets keep within four bytes."""
        while self.levels and len(self.levels[-1]) < 2 * len(batch):
            if len(self.levels[-1].data) + len(batch.data) >= 1 << 32:
                break
            batch = self.levels.pop().merged(batch)
        if len(batch):
            self.levels.append(batch)


class _Index:
    """Reads contexts by ascending document and tells which of their windows an earlier document has."""

    def __init__(self, min_bytes: int):
        self.min_bytes = min_bytes
        self.family = SuffixFamily()
        self.known: dict[bytes, int] = {}
        self.known_bytes = 0

    def batch(self, docs: list[int], parts: list[bytes]) -> list[list[tuple[int, int]]]:
        """Runs [begin, end) of repeated bytes in each context, within the context."""
        out: list[list[tuple[int, int]]] = [[] for _ in parts]
        if self.known_bytes > KNOWN_BYTES:
            self.known.clear()
            self.known_bytes = 0
        fresh = []
        for i, (doc, part) in enumerate(zip(docs, parts, strict=True)):
            first = self.known.get(part)
            if first is None:
                self.known[part] = first = doc
                self.known_bytes += len(part) + 150
            if first < doc:
                out[i].append((0, len(part)))
            else:
                fresh.append(i)
        if not fresh:
            return out
        wide = self.min_bytes
        data = np.frombuffer(b"".join(parts[i] for i in fresh), np.uint8)
        lengths = np.array([len(parts[i]) for i in fresh])
        counts = lengths - wide + 1
        begins = np.cumsum(lengths) - lengths
        row = np.repeat(np.arange(len(fresh)), counts)
        spot = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = (begins[row] + spot).astype(np.uint32)
        heads = SuffixArray(data, starts, wide).heads(0, len(starts))
        order = np.argsort(heads, kind="stable")
        heads = heads[order]
        cuts = np.flatnonzero(np.concatenate(([True], heads[1:] != heads[:-1])))
        del heads
        distinct = order[cuts]  # rows come by ascending document and the sort is stable: the earliest of each
        held = self.family.holds(SuffixArray(data, starts[distinct], wide))
        owner = np.array([docs[i] for i in fresh], dtype=np.int64)[row]
        sizes = np.diff(np.concatenate((cuts, [len(order)])))
        gone = np.zeros(len(row), dtype=bool)
        gone[order] = np.repeat(held, sizes) | (owner[order] > np.repeat(owner[distinct], sizes))
        self._keep(data, starts, row, distinct[~held], begins, lengths)
        edge = np.flatnonzero(np.concatenate(([True], (gone[1:] != gone[:-1]) | (row[1:] != row[:-1]), [True])))
        for start, end in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            if gone[start]:
                out[fresh[row[start]]].append((int(spot[start]), int(spot[end - 1]) + wide))
        return out


    def _keep(
        self, data: np.ndarray, starts: np.ndarray, row: np.ndarray, new: np.ndarray, begins: np.ndarray, lengths: np.ndarray
    ) -> None:
        """Adds the new suffixes to the family, with the bytes of those contexts alone that have some."""
        used = np.zeros(len(begins), dtype=bool)
        used[row[new]] = True
        moved = np.where(used, begins - (np.cumsum(np.where(used, lengths, 0)) - np.where(used, lengths, 0)), 0)
        kept = data[np.repeat(used, lengths)]
        self.family.add(SuffixArray(kept, (starts[new] - moved[row[new]]).astype(np.uint32), self.min_bytes))


def _found(sent: DataFrame, min_bytes: int) -> DataFrame:
    """(doc_id, tag, begin, end) of repeated bytes, from contexts sorted by document within each partition."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(min_bytes)
        docs: list[int] = []
        tags: list[int] = []
        firsts: list[int] = []
        parts: list[bytes] = []
        windows = 0

        def flush() -> pa.RecordBatch:
            out: list[list[int]] = [[], [], [], []]
            for doc, tag, first, runs in zip(docs, tags, firsts, index.batch(docs, parts), strict=True):
                for begin, end in runs:
                    for values, value in zip(out, (doc, tag, first + begin, first + end), strict=True):
                        values.append(value)
            for held in (docs, tags, firsts, parts):
                held.clear()
            columns = [pa.array(values, kind) for values, kind in zip(out, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "tag", "begin", "end"])

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("doc_id", "tag", "first", "context")]
            for doc, tag, first, part in zip(*columns, strict=True):
                if windows >= BATCH and doc != docs[-1]:
                    yield flush()
                    windows = 0
                docs.append(doc)
                tags.append(tag)
                firsts.append(first)
                parts.append(part)
                windows += len(part) - min_bytes + 1
        if docs:
            yield flush()

    return sent.select("doc_id", "tag", "first", "context").mapInArrow(rows, "doc_id long, tag long, begin long, end long")


def _halves(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Rows whose id is among ids, and the rest; few ids are broadcast after counting them."""
    ids = F.broadcast(ids) if ids.count() <= MOST_TOLD else ids
    return docs.join(ids, column, "left_semi"), docs.join(ids, column, "left_anti")


def find(docs: DataFrame, min_bytes: int = MIN_BYTES) -> tuple[DataFrame, DataFrame]:
    """What to remove from documents (doc_id, tag, text): (doc_id, tag, spans) and the (doc_id, tag) of whole copies.

    tag tells apart texts that share a doc_id. Spans are [begin, end) in UTF-8 bytes, may overlap and are in no order.
    """
    spark = docs.sparkSession
    size = F.octet_length("text").cast("long")
    narrow = docs.where("text is not null and doc_id is not null").select(
        "doc_id", "tag", size.alias("size"), F.xxhash64(F.lit(1), "text").alias("name")
    )
    narrow = stage(narrow, "texts")
    first = narrow.groupBy("tag", "name", "size").agg(F.min("doc_id").alias("first"))
    copies = narrow.join(first, ["tag", "name", "size"]).where("doc_id > first").select("doc_id", "tag").distinct()
    copies = stage(copies, "copies")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET)

    own = docs.where(size >= min_bytes).where("doc_id is not null")
    if copies.count() <= MOST_TOLD:
        own = own.join(F.broadcast(copies), ["doc_id", "tag"], "left_anti")
    else:
        own = own.join(copies, ["doc_id", "tag"], "left_anti")
    anchors = _anchors(own, buckets, min_bytes).repartition(buckets, "bucket")
    shared = stage(_shared(anchors).groupBy("doc_id").agg(F.collect_list("first").alias("firsts")), "shared")
    named = _halves(own, shared.select("doc_id"))[0].join(shared, "doc_id")
    sent = _sent(named, min_bytes).repartition(buckets, "anchor").sortWithinPartitions("doc_id", "tag", "first")
    found = _found(sent, min_bytes).groupBy("doc_id", "tag")
    return stage(found.agg(F.collect_list(F.struct("begin", "end")).alias("spans")), "spans"), copies


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans as maximal runs in order."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def remove(docs: DataFrame, min_bytes: int = MIN_BYTES, kept: bool = True) -> DataFrame:
    """Per row of documents (doc_id, text): what is left after removing bytes that an earlier document repeats.

    A byte goes if a string of min_bytes bytes that covers it also starts in a document with a smaller
    doc_id; strings are judged on the input. Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256 and,
    with kept, the remaining bytes (binary, as a cut may fall inside a character). Null texts count as empty.
    A row without doc_id neither loses nor takes bytes. Rows that repeat a doc_id count as that document,
    each with its own text, and don't remove from each other.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    docs = docs.withColumn("tag", F.xxhash64(F.lit(2), "text"))
    spans, copies = find(docs, min_bytes)
    whole = copies.withColumn("spans", F.expr("array(struct(0L as begin, -1L as end))"))
    gone = spans.unionByName(whole)
    touched, rest = _halves(docs, gone.select("doc_id").distinct())
    touched = touched.join(gone, ["doc_id", "tag"], "left").select("doc_id", "text", "spans")
    rest = rest.select("doc_id", "text", F.lit(None).cast("array<struct<begin:bigint,end:bigint>>").alias("spans"))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * kept

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches):
            out: list[list] = [[] for _ in names[1:]]
            for text, spans in zip(texts, batch.column("spans").to_pylist(), strict=True):
                runs = merged([(s["begin"], len(text) if s["end"] < 0 else s["end"]) for s in spans or ()])
                if len(text) < min_bytes:
                    runs = []
                at, left = 0, []
                for begin, end in runs:
                    left.append(text[at:begin])
                    at = end
                rest = b"".join([*left, text[at:]])
                row = (len(text), len(text) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest)
                for values, value in zip(out, row, strict=False):
                    values.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = [pa.array(values, kind) for values, kind in zip(out, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * kept
    return touched.unionByName(rest).mapInArrow(rows, schema)
