import random

from retrolane.llm import decontaminate as d


def edits(item, text):
    """Fewest edits of item to any run of text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, symbol in enumerate(item, 1):
        new = [i]
        for j in range(1, len(text) + 1):
            new.append(min(row[j - 1] + (symbol != text[j - 1]), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def corpus(seed):
    rng = random.Random(seed)
    plain = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(plain) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 10, 14, 20, 38, 59])))) for i in range(40)]
    docs = []
    for i in range(260):
        words = [rng.choice(plain) for _ in range(rng.randrange(0, 90))]
        if rng.random() < 0.8:
            part = rng.choice(items)[1].split()
            for _ in range(rng.randrange(0, max(1, len(part) // 4 + 1))):
                at = rng.randrange(len(part))
                what = rng.randrange(3)
                part[at : at + (what != 0)] = [rng.choice(plain)] if what < 2 else []
                part = part or ["w0"]
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        docs.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in words) + "."))
    return docs, items


def test_pairs_equal_brute_force_with_high_recall(spark):
    docs, items = corpus(3)
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in d.leaks(*frames).collect()}
    want = {}
    for doc, text in docs:
        for item, passage in items:
            w, p = d.words(text), d.words(passage)
            if p and (e := edits(p, w)) <= d.allowed(len(p), 80):
                want[doc, item] = e
    assert set(got) <= set(want)
    assert len(got) >= 0.99 * len(want) > 100
    assert sum(got[pair] == want[pair] for pair in got) >= 0.98 * len(got)


def test_nulls_empties_repeats_and_extra_columns(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(1, f"x {passage} y", "a"), (1, f"x {passage} y", "a"), (None, passage, "b"), (2, None, "c"), (3, "", None), (4, "w " * 60_000, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, passage), (7, passage), (8, None), (9, " .,"), (None, "w w w")], "item_id long, text string")
    found = sorted((r["doc_id"] or 0, *r[1:]) for r in d.leaks(docs, items).collect())
    assert found == [(0, 7, 0, 0, 12), (1, 7, 0, 1, 12)]
    left = d.without_leaks(docs, items)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4]
    assert d.leaks(docs.limit(0), items).count() == 0
    assert d.without_leaks(docs, items.limit(0)).count() == 6


def test_items_in_blocks_give_the_same(spark, monkeypatch):
    docs, items = corpus(4)
    frames = spark.createDataFrame(docs[:80], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(tuple(r)[:3] for r in d.leaks(*frames).collect())
    monkeypatch.setattr(d, "MOST_ITEMS", 15)
    assert sorted(tuple(r)[:3] for r in d.leaks(*frames).collect()) == whole
