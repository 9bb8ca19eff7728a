"""Near-duplicate vectors by navigable small-world graphs, one hierarchy per shard.

Equal vectors become one class. Classes are dealt into shards by a hash; each shard builds a
hierarchy of graphs: every layer holds a sixteenth of the nodes of the layer below, the top one is
small enough to compare whole, and the nodes found in a layer are where the search of the next one
starts. Every vector then queries every shard. A query whose beam is still full of links when it
ends is repeated with a wider one, and a group of queries starts with the narrowest beam that finds nearly
all links of an audit, known by comparing with all nodes. An audit asks for some of the group's queries
and for nodes of the shard that are turned away until they barely link, so it always holds links; a node's
link with itself doesn't count. Links are decided by the cosine in double precision; blocks of them are
folded into counts and components, so that no task holds the links of a dense group.

A group holds about as many bytes of queries as a shard of vectors, so sending a shard's graph to every
group costs about what sending every query to every shard does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrolane.llm.common import components, stage

LEAST_SHARDS = 8
SHARD_BYTES = 64 << 20  # of vectors in a shard
SLICE_BYTES = SHARD_BYTES  # of queries in a group
SLICE = 16_384  # queries of a group where there would be few groups
GROUPS = 64  # fewer groups than this are few
NEIGHBOURS = 24
BUILD_BEAM = 48
BEAM = 32
ENTRIES = 12
STEP = 4  # nodes of the beam whose neighbours are visited at once
SHRINK = 16
WHOLE = 512  # a layer of at most so many nodes is compared whole
WIDEST = 16  # a beam of more than this part of a layer costs more than comparing the layer whole
CELLS = 1 << 20  # similarities or pairs that are held at once
AUDIT = 96  # audited queries of a group, and links planted for its audit
RECALL = 0.995  # share of the audited links that must be found


def _select(sims: np.ndarray, ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Neighbours among candidates: nearest first, none nearer to a chosen one than to the node; then the nearest."""
    order = np.argsort(-sims, axis=1, kind="stable")
    sims, ids = np.take_along_axis(sims, order, 1), np.take_along_axis(ids, order, 1)
    known = vectors[ids]
    across = known @ known.transpose(0, 2, 1)
    good = sims > -1.5
    chosen = np.zeros(ids.shape, dtype=bool)
    taken = np.zeros(len(ids), dtype=np.int64)
    for c in range(ids.shape[1]):
        near = np.where(chosen, across[:, c, :], -2).max(axis=1)
        take = good[:, c] & (near < sims[:, c]) & (taken < most)
        chosen[:, c] = take
        taken += take
    rank = np.where(chosen, 0, np.where(good, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
    best = np.argsort(rank, axis=1)[:, :most]
    out = np.take_along_axis(ids, best, 1)
    out[~np.take_along_axis(good, best, 1)] = len(vectors) - 1
    return out


class Layer:
    """One graph of the hierarchy over unit vectors, and the layers above it. Similar means a large product."""

    def __init__(self, vectors: np.ndarray, build: bool = True):
        self.n = len(vectors)
        self.vectors = np.concatenate([vectors, np.zeros((1, vectors.shape[1]), vectors.dtype)])
        self.upper: Layer | None = None
        self.links: np.ndarray | None = None
        if build and self.n > WHOLE:
            self.upper = Layer(vectors[: max(WHOLE // 2, self.n // SHRINK)])
            self._build()

    def _build(self) -> None:
        """Inserts the nodes in batches; the nodes of the upper layer come first."""
        self.links = np.full((self.n + 1, NEIGHBOURS), self.n, dtype=np.int32)
        done = self.upper.n
        self._insert(0, done)
        while done < self.n:
            size = min(done, 1024, self.n - done)
            self._insert(done, size)
            done += size

    def _insert(self, done: int, size: int) -> None:
        new = self.vectors[done : done + size]
        sims = new @ new.T
        np.fill_diagonal(sims, -2)
        many = min(BUILD_BEAM, size)
        near = np.argpartition(-sims, many - 1, axis=1)[:, :many]
        sims, ids = np.take_along_axis(sims, near, 1), near + done
        if done:
            before_sims, before = self.search(new, BUILD_BEAM)
            sims, ids = np.concatenate([sims, before_sims], axis=1), np.concatenate([ids, before], axis=1)
        keep = np.argsort(-sims, axis=1)[:, : 2 * NEIGHBOURS]
        sims, ids = np.take_along_axis(sims, keep, 1), np.take_along_axis(ids, keep, 1)
        for at in range(0, size, 512):
            part = slice(at, at + 512)
            self.links[done + at : min(done + at + 512, done + size)] = _select(sims[part], ids[part], self.vectors, NEIGHBOURS)
        source = np.repeat(np.arange(done, done + size), NEIGHBOURS)
        target = self.links[done : done + size].ravel()
        self._back(source[target < self.n], target[target < self.n])

    def _back(self, source: np.ndarray, target: np.ndarray) -> None:
        """Adds links back from targets, choosing again where there are too many."""
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
        for at in range(0, len(nodes), 512):
            some = slice(at, at + 512)
            width = min(int(counts[some].max()), 2 * NEIGHBOURS)
            place = first[some][:, None] + np.arange(width)
            inside = np.arange(width) < counts[some][:, None]
            extra = np.where(inside, source[np.minimum(place, len(source) - 1)], self.n)
            ids = np.concatenate([self.links[nodes[some]], extra], axis=1)
            ids = np.sort(ids, axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = self.n
            sims = np.einsum("bd,bkd->bk", self.vectors[nodes[some]], self.vectors[ids])
            sims[ids == self.n] = -2
            self.links[nodes[some]] = _select(sims, ids, self.vectors, NEIGHBOURS)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Similarities and numbers of the beam most similar nodes found, for each query; blanks are -2 and n."""
        if self.upper is None or self.whole(beam):
            return self._compare(queries, min(beam, self.n))
        width = max(16, min(1024, (1 << 24) // self.n))
        parts = [self._walk(queries[at : at + width], beam) for at in range(0, len(queries), width)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def whole(self, beam: int) -> bool:
        """Whether a beam is so wide that the whole layer is compared instead."""
        return beam * WIDEST >= self.n

    def _compare(self, queries: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for at in range(0, max(1, len(queries)), 512):
            sims = queries[at : at + 512] @ self.vectors[: self.n].T
            ids = np.argpartition(-sims, many - 1, axis=1)[:, :many]
            out.append((np.take_along_axis(sims, ids, 1), ids))
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])

    def _walk(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        many = len(queries)
        entry_sims, entries = self.upper.search(queries, min(beam, ENTRIES))
        sims = np.full((many, beam), -2, queries.dtype)
        ids = np.full((many, beam), self.n, np.int64)
        sims[:, : entries.shape[1]], ids[:, : entries.shape[1]] = entry_sims, np.where(entry_sims > -1.5, entries, self.n)
        open_ = ids < self.n
        seen = np.zeros((many, self.n + 1), dtype=bool)
        np.put_along_axis(seen, ids, True, 1)
        seen[:, self.n] = True
        active = np.arange(many)
        while len(active):
            rank = np.where(open_[active], sims[active], -3)
            step = min(STEP, beam)
            best = np.argpartition(-rank, step - 1, axis=1)[:, :step]
            live = np.take_along_axis(rank, best, 1) > -2.5
            nodes = np.where(live, np.take_along_axis(ids[active], best, 1), self.n)
            open_[active[:, None], best] = False
            near = np.sort(self.links[nodes].reshape(len(active), -1), axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = self.n
            near[np.take_along_axis(seen[active], near, 1)] = self.n
            seen[active[:, None], near] = True
            found = np.einsum("bd,bkd->bk", queries[active], self.vectors[near])
            found[near == self.n] = -2
            all_sims = np.concatenate([sims[active], found], axis=1)
            all_ids = np.concatenate([ids[active], near], axis=1)
            all_open = np.concatenate([open_[active], near < self.n], axis=1)
            keep = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            sims[active] = np.take_along_axis(all_sims, keep, 1)
            ids[active] = np.take_along_axis(all_ids, keep, 1)
            open_[active] = np.take_along_axis(all_open, keep, 1)
            active = active[open_[active].any(axis=1)]
        return sims, ids

    def pieces(self, queries: np.ndarray, least: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) of at least this similarity, at most CELLS at once; full beams are widened until they end below it."""
        rows = np.arange(len(queries))
        while len(rows):
            if self.upper is None or self.whole(beam):
                many = max(1, CELLS // self.n)
                for at in range(0, len(rows), many):
                    part = rows[at : at + many]
                    q, node = np.nonzero(queries[part] @ self.vectors[: self.n].T >= least)
                    yield part[q], node
                return
            many = max(1, CELLS // beam)
            full = []
            for at in range(0, len(rows), many):
                part = rows[at : at + many]
                sims, ids = self.search(queries[part], beam)
                wide = sims.min(axis=1) >= least
                q, place = np.nonzero((sims >= least) & ~wide[:, None])
                yield part[q], ids[q, place]
                full.append(part[wide])
            rows, beam = np.concatenate(full), beam * 4

    def within(self, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (query, node) of at least this similarity."""
        out = list(self.pieces(queries, least, beam))
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])

    def saved(self) -> tuple[list[int], list[bytes]]:
        """Sizes and link tables of the layers from here up; the vectors of a layer are the first of the one below."""
        sizes, tables = self.upper.saved() if self.upper else ([], [])
        return [self.n, *sizes], [self.links.tobytes() if self.links is not None else b"", *tables]

    @classmethod
    def loaded(cls, vectors: np.ndarray, sizes: list[int], tables: list[bytes]) -> Layer:
        layer = cls(vectors[: sizes[0]], build=False)
        if tables[0]:
            layer.links = np.frombuffer(tables[0], np.int32).reshape(-1, NEIGHBOURS)
            layer.upper = cls.loaded(vectors, sizes[1:], tables[1:])
        return layer


def _unit(values: np.ndarray) -> np.ndarray:
    scale = np.abs(values).max(axis=1, keepdims=True)
    values = values / scale
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def _sure(
    layer: Layer, exact: np.ndarray, queries: np.ndarray, least: float, beam: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, node) with a cosine of at least `least` that beams from this width on find, in pieces."""
    for q, node in layer.pieces(queries.astype(np.float32), least - 1e-5, beam):
        sure = np.zeros(len(q), dtype=bool)
        for at in range(0, len(q), 1 << 16):
            part = slice(at, at + (1 << 16))
            sure[part] = np.einsum("ij,ij->i", queries[q[part]], exact[node[part]]) >= least
        yield q[sure], node[sure]


def planted(exact: np.ndarray, least: float, rng: np.random.Generator) -> np.ndarray:
    """Unit vectors that link with a node each: nodes turned away until the cosine is between least and halfway to 1."""
    near = exact[rng.choice(len(exact), min(AUDIT, len(exact)), replace=False)]
    away = rng.normal(size=near.shape)
    away -= np.einsum("ij,ij->i", away, near)[:, None] * near
    away /= np.maximum(np.sqrt((away * away).sum(axis=1, keepdims=True)), 1e-12)
    cosine = least + (1 - least) * rng.uniform(0.02, 0.5, (len(near), 1))
    return _unit(cosine * near + np.sqrt(1 - cosine * cosine) * away)


def audited_beam(
    layer: Layer, exact: np.ndarray, ids: np.ndarray, queries: np.ndarray, mine: np.ndarray, least: float
) -> tuple[int, int, int]:
    """The beam that the audit asks for, the audit's links and how many of them that beam finds.

    Queries don't depend on each other, so the audited ones alone settle the beam before the others are
    asked. No audit (0, 0) where the layer is compared whole.
    """
    beam = BEAM
    if layer.whole(beam):
        return beam, 0, 0
    rng = np.random.default_rng(len(queries))
    some = rng.choice(len(queries), min(AUDIT, len(queries)), replace=False)
    asked = np.concatenate([queries[some], planted(exact, least, rng)])
    truth = asked @ exact.T >= least
    truth[: len(some)] &= mine[some][:, None] != ids
    total = int(truth.sum())
    while True:
        found = sum(int(truth[q, node].sum()) for q, node in _sure(layer, exact, asked, least, beam))
        if found >= RECALL * total or layer.whole(beam):
            return beam, total, found
        beam *= 4


def _prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, size, data): the components as doubles; null where a vector can't link."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, data = [], []
            for values in batch.column("embedding").to_pylist():
                array = np.array([math.nan if v is None else v for v in values or ()], np.float64)
                good = len(array) and np.isfinite(array).all() and array.any()
                sizes.append(len(array))
                data.append((array + 0.0).tobytes() if good else None)
            columns = [batch.column("vec_id"), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "size", "data"])

    typed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>"))
    return typed.mapInArrow(rows, "vec_id long, size long, data binary")


def _built(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("vec_id")
    order = np.random.default_rng(7).permutation(len(group))
    group = group.iloc[order]
    exact = _unit(np.frombuffer(b"".join(group["data"]), np.float64).reshape(len(group), -1))
    sizes, tables = Layer(exact.astype(np.float32)).saved()
    row = {
        "size": group["size"].iloc[0],
        "shard": group["shard"].iloc[0],
        "ids": group["vec_id"].to_numpy().tobytes(),
        "weights": group["many"].to_numpy().tobytes(),
        "vectors": exact.tobytes(),
        "layers": [sizes],
        "tables": [tables],
    }
    return pd.DataFrame(row)


class Forest:
    """Components of nodes 0 to size - 1 under the edges added so far; edges aren't kept."""

    def __init__(self, size: int):
        self.root = np.arange(size)  # the smallest node of each one's component

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while ((up := self.root[self.root]) != self.root).any():
                self.root = up


def _queried(least: float):
    def search(graph: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        names = ["vec_id", "links", "other", "audited", "met"]
        if not len(graph) or not len(queries):
            return pd.DataFrame({name: np.zeros(0, np.int64) for name in names})
        row = graph.iloc[0]
        ids, weights = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["weights"], np.int64)
        exact = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1)
        layer = Layer.loaded(exact.astype(np.float32), [int(x) for x in row["layers"]], list(row["tables"]))
        mine = queries["vec_id"].to_numpy()
        asked = _unit(np.frombuffer(b"".join(queries["data"]), np.float64).reshape(len(queries), -1))
        vertices, flat = np.unique(np.concatenate([mine, ids]), return_inverse=True)
        counts, forest = np.zeros(len(mine)), Forest(len(vertices))
        beam, audited, met = audited_beam(layer, exact, ids, asked, mine, least)
        for q, node in _sure(layer, exact, asked, least, beam):
            other = mine[q] != ids[node]
            q, node = q[other], node[other]
            counts += np.bincount(q, weights=weights[node], minlength=len(mine))
            forest.add(flat[: len(mine)][q], flat[len(mine) :][node])
        some, joined = counts > 0, forest.root != np.arange(len(vertices))
        # the last row carries the audit only
        rows = some.sum() + joined.sum()
        return pd.DataFrame(
            {
                "vec_id": np.concatenate([mine[some], vertices[joined], mine[:1]]),
                "links": np.concatenate([counts[some].astype(np.int64), np.zeros(joined.sum() + 1, np.int64)]),
                "other": np.concatenate([mine[some], vertices[forest.root[joined]], mine[:1]]),
                "audited": np.append(np.zeros(rows, np.int64), audited),
                "met": np.append(np.zeros(rows, np.int64), met),
            }
        )

    return search


def near_vectors(vectors: DataFrame, least: float = 0.95, recall: bool = False) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vectors (vec_id, embedding).

    Vectors link when their cosine in double precision is at least `least`; component_id is the smallest
    vec_id reachable by links, kept says whether that is the own one. Vectors that are null, empty or zero
    or hold null or non-finite components link with nothing, as do rows without vec_id (their component is
    null). Vectors of different length don't link. Rows that repeat a vec_id with the same vector count as
    copies; with other vectors they are one vertex, whose links are those of all its vectors. Other columns
    are ignored. On request every row also tells audit_links and audit_recall: how many links all audits held
    and the share that the searches found; 0 and null where all layers were small enough to compare whole.
    """
    spark = vectors.sparkSession
    all_ = stage(_prepared(vectors), "vectors")
    usable = all_.where("data is not null and vec_id is not null")
    classes = usable.groupBy("data").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("many"), F.first("size").alias("size"))
    classes = stage(classes, "classes")
    total, widest = classes.agg(F.count("*"), F.max("size")).first()
    shards = max(LEAST_SHARDS, -(-total * 8 * (widest or 1) // SHARD_BYTES))
    few = min(-(-total // SLICE), -(-GROUPS // shards))
    slices = max(1, few, -(-total * 8 * (widest or 1) // SLICE_BYTES))
    dealt = classes.withColumn("shard", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(shards)))
    schema = "size long, shard long, ids binary, weights binary, vectors binary, layers array<long>, tables array<binary>"
    graphs = stage(dealt.groupBy("size", "shard").applyInPandas(_built, schema), "graphs")
    graphs = graphs.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
    asked = classes.withColumn("slice", F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(slices)))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    asked = asked.select("size", "shard", "slice", "vec_id", "data")
    keys = ["size", "shard", "slice"]
    schema = "vec_id long, links long, other long, audited long, met long"
    found = stage(graphs.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_queried(least), schema), "found")
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("links")).withColumnRenamed("vec_id", "first")
    known = components(found.where("vec_id <> other").select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    named = classes.select("data", F.col("vec_id").alias("first"), "many")
    named = named.join(counts, "first", "left").join(known.withColumnRenamed("node", "first"), "first", "left")
    out = all_.join(named, (all_["data"] == named["data"]) & all_["vec_id"].isNotNull(), "left")
    links = F.coalesce(F.col("links"), F.lit(0)) + F.coalesce(F.col("many") - 1, F.lit(0))
    component = F.coalesce("component", "first", "vec_id")
    out = out.select("vec_id", links.alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
    if not recall:
        return out
    audited, met = found.agg(F.coalesce(F.sum("audited"), F.lit(0)), F.coalesce(F.sum("met"), F.lit(0))).first()
    share = F.lit(met / audited if audited else None).cast("double")
    return out.withColumns({"audit_links": F.lit(audited).cast("long"), "audit_recall": share})
