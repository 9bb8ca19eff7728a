import hashlib
import random

import numpy as np
import pytest

from retrolane.llm import repeats


def brute(rows, wide=50):
    texts = [(doc, (text or "").encode()) for doc, text in rows]
    first: dict[bytes, int] = {}
    for doc, text in texts:
        for i in range(len(text) - wide + 1) if doc is not None else ():
            part = text[i : i + wide]
            first[part] = min(first.get(part, doc), doc)
    out = []
    for doc, text in texts:
        gone = np.zeros(len(text) + 1, dtype=bool)
        for i in range(len(text) - wide + 1) if doc is not None else ():
            if first[text[i : i + wide]] < doc:
                gone[i : i + wide] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
        out.append((-1 if doc is None else doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed: int) -> list:
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passages = [make(rng.randrange(30, 200)) for _ in range(8)]
    rows = []
    for i in range(150):
        parts = [make(rng.randrange(0, 150)) for _ in range(rng.randrange(4))]
        for _ in range(rng.randrange(3)):
            passage = rng.choice(passages)
            start = rng.randrange(len(passage))
            parts.insert(rng.randrange(len(parts) + 1), passage[start:] if rng.random() < 0.5 else passage)
        rows.append((rng.randrange(10_000), "".join(parts)))
    for doc, text in rng.sample(rows, 40):
        at = rng.randrange(len(text) + 1)
        rows.append((rng.randrange(10_000), text if rng.random() < 0.3 else text[:at] + "Q" + text[at:]))
    return list(dict(rows).items())


@pytest.mark.parametrize("seed", [1, 2])
def test_removed_bytes_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(repeats, "BATCH", 300)
    rows = corpus(seed) + [(20_000, None), (20_001, ""), (20_002, "x" * 49), (20_003, "x" * 50), (20_004, "x" * 90_000)]
    rows += [(None, "x" * 60), (None, "x" * 60), (20_005, "x" * 60), (20_005, "x" * 60), (20_005, "y" * 60), (3, "y" * 70)]
    docs = spark.createDataFrame([(*row, "z") for row in rows], "doc_id long, text string, tag string").repartition(4)
    out = repeats.remove(docs)
    got = sorted((-1 if r[0] is None else r[0], *r[1:5]) for r in out.collect())
    assert got == brute(rows)


def sorted_array(parts: np.ndarray) -> repeats.SuffixArray:
    return repeats.SuffixArray(np.frombuffer(parts.tobytes(), np.uint8), np.arange(len(parts), dtype=np.uint32) * 50, 50)


@pytest.mark.parametrize("block", [3, 64, 1 << 16])
def test_the_family_keeps_few_levels(monkeypatch, block):
    monkeypatch.setattr(repeats, "BLOCK", block)
    rng = np.random.default_rng(1)
    family, held = repeats.SuffixFamily(), set()
    for _ in range(60):
        batch = np.unique(rng.integers(0, 10_000, 100).astype("S50"))
        found = family.holds(sorted_array(batch))
        assert [x in held for x in batch.tolist()] == found.tolist()
        family.add(sorted_array(batch[~found]))
        held |= set(batch.tolist())
    assert len(family.levels) <= 10 and sum(map(len, family.levels)) == len(held)
    for level in family.levels:
        heads = level.heads(0, len(level))
        assert (heads[1:] > heads[:-1]).all()


def test_the_family_holds_about_eight_bytes_a_window():
    rng = np.random.default_rng(2)
    index = repeats._Index(50)
    windows = 0
    for batch in range(6):
        parts = [rng.integers(97, 123, 67, dtype=np.uint8).tobytes() for _ in range(2000)]
        assert index.batch(list(range(batch * 2000, batch * 2000 + 2000)), parts) == [[]] * 2000
        windows += 2000 * 18
    held = sum(level.data.nbytes + level.starts.nbytes for level in index.family.levels)
    assert held <= 8 * windows


def test_long_texts_are_looked_at_in_slices(monkeypatch):
    rng = random.Random(5)
    text = bytes(rng.choice(b"abc") for _ in range(5000))
    whole = list(repeats.contexts([text]))
    monkeypatch.setattr(repeats, "SLICE", 700)
    starts = lambda parts: [s for _, a, b, _ in parts for x, y in zip(a, b) for s in range(x, y + 1)]
    assert starts(repeats.contexts([text])) == starts(whole) == list(range(5000 - 49))


def test_empty_table(spark):
    assert repeats.remove(spark.createDataFrame([], "doc_id long, text string")).count() == 0
