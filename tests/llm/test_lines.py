import random

from pyspark.sql import functions as F

from retrolane.llm import lines, queries


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def changed(rng, line, most):
    chars = list(line)
    for _ in range(rng.randrange(most + 1)):
        at = rng.randrange(len(chars) + 1)
        what = rng.randrange(3)
        chars[at : at + (what != 0)] = [rng.choice("abé")] if what < 2 else []
    return "".join(chars)


def corpus(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcé ") for _ in range(rng.choice([5, 19, 20, 23, 41, 80]))) for _ in range(25)]
    docs = []
    for i in range(60):
        docs.append((i, "\n".join(changed(rng, rng.choice(base), 4) for _ in range(rng.randrange(0, 5)))))
    return docs


def brute(rows, limit, least):
    places = [(doc, pos, line) for doc, text in rows if doc is not None and text for pos, line in enumerate(text.split("\n"))]
    first = {}
    for doc, pos, line in sorted(places):
        first.setdefault(line, (doc, pos))
    names = [line for line in first if len(line) >= least]
    near = {a for a in names for b in names if first[b] < first[a] and abs(len(a) - len(b)) <= limit and edits(a, b) <= limit}
    out = []
    for doc, text in rows:
        if doc is None or not text:
            out.append((-1 if doc is None else doc, text, 0 if text is None else len(text.split("\n")), 0))
            continue
        split = text.split("\n")
        kept = [s for p, s in enumerate(split) if len(s) < least or (s not in near and first[s] == (doc, p))]
        out.append((doc, "\n".join(kept), len(split), len(split) - len(kept)))
    return sorted(out, key=str)


def test_bit_parallel_distance_equals_the_full_table(spark):
    rng = random.Random(4)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 14)))
        pairs.append((a, changed(rng, a, 4)))
    frame = spark.createDataFrame(pairs, "a string, b string")
    for limit in (1, 2, 3):
        for a, b, got in frame.select("a", "b", lines.edit_distance(F.col("a"), F.col("b"), limit)).collect():
            want = edits(a, b)
            assert got == want if want <= limit else got > limit, (a, b, limit, got, want)


def test_lines_equal_brute_force(spark):
    for seed, limit in ((1, 2), (2, 1)):
        rows = corpus(seed) + [(None, "a" * 30), (None, None), (100, None), (101, ""), (102, "\n\n"), (103, "z" * 900), (104, "z" * 899), (107, "y" * 60_000)]
        rows += [(105, "q" * 30), (105, "q" * 30)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = [(-1 if r[0] is None else r[0], *r[1:]) for r in lines.dedup(docs, limit).collect()]
        assert sorted(got, key=str) == brute(rows, limit, 20)


def test_the_main_path_has_no_python(spark):
    docs = spark.createDataFrame(corpus(3), "doc_id long, text string")
    plan = lines.dedup(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_extra_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x" * 30, 5, "t"), (2, "x" * 30, 6, None)], "doc_id long, text string, n_lines int, tag string")
    out = sorted(map(tuple, lines.dedup(docs).collect()))
    assert out == [(1, "x" * 30, "t", 1, 0), (2, "", None, 1, 1)]
    assert lines.dedup(docs.limit(0)).count() == 0


def test_the_query_removes_short_repeats_too(spark, tmp_path):
    rows = [(1, "Read more\n\n}\nabc"), (2, "Read more\nRead mode\n\n}\nabd"), (3, "}\n}\n" + "x" * 30), (4, "x" * 31)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op8_lines(spark, str(tmp_path)).select("doc_id", "n_lines", "n_removed").collect()
    assert sorted(map(tuple, out)) == [(1, 4, 0), (2, 5, 2), (3, 3, 2), (4, 1, 1)]
    kept = {r["doc_id"]: r["text"] for r in lines.dedup(spark.createDataFrame(rows, "doc_id long, text string"), equal_chars=1).collect()}
    assert kept == {1: rows[0][1], 2: "Read mode\n\nabd", 3: "x" * 30, 4: ""}


def test_large_groups_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(lines, "MOST_MET", 2)
    for seed, limit in ((5, 2), (6, 1)):
        rows = corpus(seed) + [(200 + i, changed(random.Random(i), "abécabc" * 9, 3)) for i in range(60)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert sorted(map(tuple, lines.dedup(docs, limit).collect()), key=str) == brute(rows, limit, 20)


def test_gram_bits_never_part_near_lines(spark):
    rng = random.Random(7)
    pairs = [(a, changed(rng, a, 2)) for a in ("".join(rng.choice("abé c") for _ in range(rng.randrange(0, 40))) for _ in range(300))]
    near = spark.createDataFrame(pairs, "a string, b string")
    for q in lines.GRAMS:
        bits = [lines.gram_bits(F.col(name), q) for name in ("a", "b")]
        assert near.where(lines.grams_near(*bits, q, 2)).count() == len(pairs)


def test_a_large_group_does_not_meet_in_all_pairs(spark, monkeypatch):
    rng = random.Random(8)
    made = {}

    def counted(df, name):
        out = stage(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out

    stage = lines.stage
    monkeypatch.setattr(lines, "stage", counted)
    rows = []
    for i in range(300):
        words = [rng.choice(("one", "neo", "eon", "seat", "teas", "east", "sate")) for _ in range(6)]
        rows.append((i, "the same long beginning of all these many lines, and then " + " ".join(sorted(words, key=len)) + f" {'.' * 4}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, lines.dedup(docs).collect()), key=str) == brute(rows, 2, 20)
    distinct = len({text for _, text in rows})
    assert made["met"] < 20 * distinct


def join_rows(frame):
    """Rows that the topmost join of a frame makes when the frame is computed."""
    frame.collect()
    node = frame._jdf.queryExecution().executedPlan()
    while "Join" not in (name := node.nodeName()):
        node = node.executedPlan() if name == "AdaptiveSparkPlan" else node.plan() if name.endswith("QueryStage") else node.children().apply(0)
    return node.metrics().apply("numOutputRows").value()


def test_repeats_of_a_line_meet_nothing_more_than_the_line(spark, monkeypatch):
    stage, made = lines.stage, []

    def counted(df, name):
        if name == "met" and len(made) < runs:
            made.append(join_rows(df))
        return stage(df, name)

    monkeypatch.setattr(lines, "stage", counted)
    base = "a line that stands at many places of the documents"
    rows = [(i, base[:i] + base[i + 1 :]) for i in range(6)]
    for runs, repeats in enumerate((0, 1, 50), 1):
        docs = rows + [(100 + i, f"{base}\n{base}" if i else base) for i in range(repeats + 1)]
        frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        assert sorted(map(tuple, lines.dedup(frame).collect()), key=str) == brute(docs, 2, 20)
    assert made[0] > 0 and made == made[:1] * 3


def test_lines_too_many_to_be_told_of_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(lines, "MOST_TOLD", 3)
    rows = corpus(9) + [(300 + i, "\n".join(line for _, text in corpus(9)[i % 7 :: 7] for line in text.split("\n"))) for i in range(12)]
    rows += [rows[70], rows[70]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, lines.dedup(docs).collect()), key=str) == brute(rows, 2, 20)
