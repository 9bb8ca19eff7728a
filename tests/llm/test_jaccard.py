import random
import re

import pytest

from retrolane.llm import jaccard

SPLIT = re.compile("[^\x20\x09-\x0d]+")


def shingles(text: str | None, words: int) -> frozenset:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens = SPLIT.findall(lower)
    if not tokens:
        return frozenset()
    width = min(words, len(tokens))
    return frozenset(tuple(tokens[i : i + width]) for i in range(len(tokens) - width + 1))


def brute(rows, words, percent):
    sets = [(doc, shingles(text, words)) for doc, text in rows]
    low = {doc: doc for doc, _ in sets if doc is not None}
    moved = True
    pairs = []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and a is not None and b is not None and 100 * len(x & y) >= percent * len(x | y):
                pairs.append((a, b))
    while moved:
        moved = False
        for a, b in pairs:
            if low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                moved = True
    return sorted((-1 if doc is None else doc, len(s), low.get(doc, -1)) for doc, s in sets)


def corpus(seed: int) -> list:
    rng = random.Random(seed)
    plain = [f"w{i}" for i in range(300)]
    rows = []
    passage = [rng.choice(plain) for _ in range(30)]
    for _ in range(40):
        words = [rng.choice(plain) for _ in range(rng.randrange(0, 120))]
        if rng.random() < 0.5:
            words[5:5] = passage
        for _ in range(rng.choice([1, 1, 2, 30 if rng.random() < 0.2 else 4])):
            copy = list(words)
            for _ in range(rng.randrange(0, 4)):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice(plain)
            rows.append(copy)
    rng.shuffle(rows)
    return [(i, " ".join(words)) for i, words in enumerate(rows)]


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_components_equal_brute_force(spark, words, percent):
    rows = corpus(words)
    rows += [(1000, "A b"), (1001, "a  B"), (1002, ""), (1003, None), (1004, " \t"), (None, "a b"), (1005, "İx é"), (1006, "x" * 50_000)]
    rows += [(1007, "long " * 30_000), (1008, "long " * 20_000), (1000, "A b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = jaccard.link(docs, words, percent)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    none = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(none(r) for r in out.collect()) == brute(rows, words, percent)


def test_large_tiles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL_TILE", 2)
    rows = corpus(11)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard.link(docs, 3, 90).collect()) == brute(rows, 3, 90)


def test_one_of_each_group_stays_with_all_columns(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(3, text, "x"), (2, text, "y"), (5, text + " more", "z"), (None, text, "n"), (9, None, None), (9, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    out = jaccard.without_near_copies(docs)
    assert out.columns == docs.columns
    assert sorted((r[0] or 0, r[2] or "") for r in out.collect()) == [(0, "n"), (2, "y"), (9, ""), (9, "")]
    assert jaccard.without_near_copies(docs.limit(0)).count() == 0


def test_counted_shingles_are_counted_over_all_documents(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HEAVY_BATCH", 7)
    rows = corpus(4) + [(9000 + i, "the very same words") for i in range(40)] + [(9900, None), (9901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    shingler = jaccard.Shingler(3)
    held = {}
    for _, text in rows:
        for name in jaccard._names(shingler(text), 1024).tolist():
            held[name] = held.get(name, 0) + 1
    counts = {row["name"]: row["times"] for row in jaccard._counts(docs, 3, 64, 1024).collect()}
    share = 64 << 34  # a name has ten bits of the bucket and 32 more
    exact = {name: times for name, times in held.items() if times > jaccard.SMALL_TILE and name < share}
    assert {name: times for name, times in counts.items() if name < share} == exact and len(exact) > 10
    assert all(jaccard.SMALL_TILE < times <= held[name] for name, times in counts.items())


def test_order_is_one_for_all_sets_and_rare_shingles_come_first(spark):
    docs = spark.createDataFrame([(i, f"the very same words {i}") for i in range(90)], "doc_id long, text string")
    heavy = jaccard._heavy(docs, 2, 60)
    shingler = jaccard.Shingler(2)
    frequent = set(shingler("the very same words").tolist())
    place = {}
    for i in range(90):
        order = jaccard._in_order(shingler(f"the very same words {i}"), *heavy).tolist()
        assert order[0] not in frequent
        for left, right in zip(order, order[1:], strict=False):
            assert place.setdefault((left, right), True) and (right, left) not in place


@pytest.mark.parametrize("most", [0, 5])
def test_components_with_few_frequent_shingles_told(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard, "MOST_HEAVY", most)
    rows = corpus(8)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard.link(docs, 3, 90).collect())) == brute(rows, 3, 90)
