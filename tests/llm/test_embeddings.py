import tracemalloc

import numpy as np
import pandas as pd
import pytest

from retrolane.llm import embeddings


def brute(rows, least):
    good = [(i, v, np.asarray(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = [(i, a / np.sqrt((a * a).sum())) for i, _, a in good]
    links = {i: 0 for i, _ in unit}
    low = {i: i for i, _ in rows if i is not None}
    edges = []
    for n, (i, a) in enumerate(unit):
        for j, b in unit[:n]:
            if len(a) == len(b) and a @ b >= least:
                links[i] += 1
                links[j] += 1
                edges.append((i, j))
    moved = True
    while moved:
        moved = False
        for i, j in edges:
            if low[i] != low[j]:
                low[i] = low[j] = min(low[i], low[j])
                moved = True
    return sorted((-1 if i is None else i, links.get(i, 0), low.get(i, -1), i is None or low[i] == i) for i, _ in rows)


@pytest.mark.parametrize("whole", [512, 16])
def test_links_equal_brute_force(spark, whole, monkeypatch):
    monkeypatch.setattr(embeddings, "WHOLE", whole)
    rng = np.random.default_rng(5)
    points = [rng.normal(size=16) for _ in range(500)]
    points += [points[int(rng.integers(500))] + rng.normal(size=16) * 0.12 for _ in range(300)]
    points += [points[3] + rng.normal(size=16) * 0.05 for _ in range(150)] + [points[7]] * 40 + [points[8] * 3]
    rows = [(i, np.round(p, 4).tolist()) for i, p in enumerate(points)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [None] + [1.0] * 15)]
    rows += [(2005, [1.0, 2.0]), (2006, [2.0, 4.0]), (None, rows[0][1]), (2007, [float("inf")] + [1.0] * 15)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, component_id string")
    got = sorted(tuple(-1 if v is None else v for v in r) for r in embeddings.near_vectors(frame).collect())
    assert got == brute(rows, 0.95)


def test_shards_too_large_to_compare_whole_are_walked(spark):
    """About 650 nodes a shard against a beam of 32: too many to compare, so every shard's graph is searched."""
    rng = np.random.default_rng(9)
    points = rng.normal(size=(5200, 12))
    points[4000:] = points[:1200] + rng.normal(size=(1200, 12)) * rng.uniform(0.02, 0.4, (1200, 1))
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = embeddings.near_vectors(frame, 0.95, recall=True).toPandas().sort_values("vec_id")
    unit = points / np.sqrt((points * points).sum(axis=1, keepdims=True))
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    links = out.n_links.to_numpy()
    assert (links <= near.sum(axis=1)).all() and links.sum() >= 0.995 * near.sum() > 1000
    forest = embeddings.Forest(len(points))
    forest.add(*np.nonzero(near))
    assert (out.component_id.to_numpy() == forest.root).mean() >= 0.995
    assert out.audit_links.min() >= embeddings.LEAST_SHARDS * embeddings.AUDIT
    assert 0.995 <= out.audit_recall.min() <= 1


def test_planted_links_are_links_at_any_threshold():
    rng = np.random.default_rng(1)
    for least, width in [(0.95, 12), (0.5, 3), (1.0, 4), (0.9, 1)]:
        exact = embeddings._unit(rng.normal(size=(300, width)))
        assert ((embeddings.planted(exact, least, rng) @ exact.T).max(axis=1) >= least - 1e-9).all()


def test_empty_table(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_a_saved_hierarchy_answers_as_before(monkeypatch):
    rng = np.random.default_rng(2)
    vectors = embeddings._unit(rng.normal(size=(3000, 12))).astype(np.float32)
    layer = embeddings.Layer(vectors)
    again = embeddings.Layer.loaded(vectors, *layer.saved())
    assert len(layer.saved()[0]) > 1
    for a, b in zip(layer.search(vectors[:50], 20), again.search(vectors[:50], 20)):
        assert (a == b).all()
    pairs = set(zip(*map(list, layer.within(vectors, 0.9, 16))))
    truth = set(zip(*map(list, np.nonzero(vectors @ vectors.T >= 0.9))))
    assert len(pairs & truth) >= 0.99 * len(truth)


def test_a_dense_group_is_folded_in_blocks():
    rng = np.random.default_rng(6)
    size = 4000
    points = embeddings._unit(rng.normal(size=8) + 0.02 * rng.normal(size=(size, 8)))
    points[-2:] = embeddings._unit(rng.normal(size=(2, 8)))
    ids = rng.permutation(size).astype(np.int64)
    row = {"ids": ids.tobytes(), "weights": np.ones(size, np.int64).tobytes(), "vectors": points.tobytes(), "layers": [[size]], "tables": [[b""]]}
    queries = pd.DataFrame({"vec_id": ids, "data": [p.tobytes() for p in points]})
    tracemalloc.start()
    out = embeddings._queried(0.95)(pd.DataFrame(row), queries)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    near = points @ points.T >= 0.95
    counts = dict(zip(ids.tolist(), (near.sum(axis=1) - 1).tolist()))
    assert out[out.links > 0].set_index("vec_id").links.to_dict() == {i: n for i, n in counts.items() if n}
    stars = out[out.vec_id != out.other]
    assert set(stars.vec_id) == set(ids[:-2].tolist()) - {min(ids[:-2])} and set(stars.other) == {min(ids[:-2])}
    assert peak < 150e6


def test_a_forest_equals_the_components_of_its_edges():
    rng = np.random.default_rng(8)
    forest, low = embeddings.Forest(300), np.arange(300)
    for _ in range(12):
        a, b = rng.integers(0, 300, (2, 20))
        forest.add(a, b)
        for x, y in zip(a, b):
            low[(low == low[x]) | (low == low[y])] = min(low[x], low[y])
        assert (forest.root == low).all()
