import math
import random
import re
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import Row

from retrolane.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {code: code + 32 for code in range(65, 91)}
COLUMNS = "doc_id long, text string, item_id long, rank string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    """docs: (doc_id, text) rows; items: (item_id, text) rows."""
    held = [(doc, Counter(terms(text))) for doc, text in docs if terms(text)]
    many, total = len(held), sum(sum(count.values()) for _, count in held)
    df = Counter(term for _, count in held for term in count)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item].update(terms(text))
    out = set()
    for item, asked in wanted.items():
        scores = []
        for place, (doc, count) in enumerate(held):
            m = 100 - 90 + (90 * sum(count.values()) * many) // total
            score = 0
            for term in asked & set(count):
                w = math.floor(1000 * math.log((2 * many + 2) / (2 * df[term] + 1)))
                score += w * ((1000000000 * count[term]) // (1000 * count[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, place))
        for rank, (score, missing, doc, _) in enumerate(sorted(scores)[:top], 1):
            out.add((item, rank, None if missing else doc, -score))
    return out


def found(spark, docs, items, **options):
    rows = [Row(doc_id=d, text=t, item_id=7, rank="clash") for d, t in docs]
    frame = spark.createDataFrame(rows, COLUMNS).repartition(5) if rows else spark.createDataFrame([], COLUMNS)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(frame, asked, **options).collect()
    assert len(got) == len({(row["item_id"], row["rank"]) for row in got})
    return {(row["item_id"], row["rank"], row["doc_id"], row["score"]) for row in got}


def sample(seed, many):
    rng = random.Random(seed)
    vocabulary = ["a", "the", "café", "CAFÉ", "naïve", "x1", "Ab", "ab", "日本", "日", "_", "a-b", "\x00z", "😀", "É"]
    said = lambda: rng.choice([" ", "", ", "]).join(rng.choice(vocabulary) for _ in range(rng.randrange(14)))
    return [(number, said()) for number in range(many)]


def test_equal_to_brute_force_with_ties_nulls_and_repeats(spark):
    docs = sample(1, 160)
    docs += [(500 + i, "the ab café") for i in range(40)] + [(500, "the ab café")] * 3
    docs += [(None, "the ab café"), (None, None), (900, None), (901, ""), (902, " .,"), (903, "ab " * 100_000)]
    items = [(1, "The AB"), (2, "日本 日 é"), (3, None), (4, ""), (5, "nowhere"), (6, "the café x1 naïve 😀 z")]
    items += [(7, "the"), (7, "ab AB ab"), (None, "ab"), (8, "É a")]
    want = brute(docs, items)
    assert found(spark, docs, items) == want
    assert found(spark, docs, items, most_pairs=3) == want


def test_pending_candidates_are_cut_without_loss(spark, monkeypatch):
    docs = [(number, "ab " * (1 + number % 9) + "the " * (number % 4)) for number in range(700)]
    items = [(1, "ab"), (2, "the"), (3, "ab the")]
    best = lexical.Best(3, 10)
    monkeypatch.setattr(lexical, "PENDING", 5)
    whole = brute(docs, items)
    assert found(spark, docs, items) == whole
    rng = random.Random(2)
    offered = [(doc, [rng.randrange(4) for _ in range(3)]) for doc in range(500)]
    rng.shuffle(offered)
    for doc, scores in offered:
        best.offer(lexical.np.array(scores), doc)
    got = best.rows()
    for item in range(3):
        want = sorted((-scores[item], doc) for doc, scores in offered if scores[item] > 0)[:10]
        assert [(-s, d) for i, s, _, d in got.T.tolist() if i == item] == want


def test_empty_tables_give_no_rows(spark):
    assert found(spark, [], [(1, "a")]) == set()
    assert found(spark, [(1, "a")], []) == set()
    assert found(spark, [(1, None)], [(1, "a")]) == set()


def test_sql_says_the_same(spark, tmp_path):
    docs = [(i, t) for i, t in sample(4, 300) if t] + [(1000 + i, "the ab") for i in range(30)]
    items = [(i, t) for i, t in sample(9, 25)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/b")
    base = duckdb.connect()
    base.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    base.sql(f"CREATE VIEW benchmark AS SELECT * FROM '{tmp_path}/b/*.parquet'")
    rows = base.sql(f"SELECT item_id, rank, doc_id, score FROM ({lexical.ORACLE})").fetchall()
    assert set(rows) == brute(docs, items)
