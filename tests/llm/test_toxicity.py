import itertools
import random
import zlib

import numpy as np
from pyspark.sql import Row
from pyspark.sql import functions as F

from retrolane.llm import toxicity


def sample(seed: int, n: int) -> list[tuple[str, int]]:
    rng = random.Random(seed)
    plain = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 60))]
        label = int(i % 4 == 0)
        for _ in range(rng.randrange(2, 6) if label else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "foulness", "fouler", "foulest", "foulish"]))
        out.append((" ".join(words), label))
    return out


def test_marginals_equal_the_sum_over_all_paths():
    model = toxicity.Model({"vile": 2.5, "foul": 1.0}, bias=-1.2, moves=np.array([[0.0, -0.4], [0.3, 0.6]]))
    words = "a vile b foul vile c d".split()
    unary = [np.array([0.0, model.bias + (model.weight(word) or 0.0)]) for word in words]
    total, sums, blank = 0.0, np.zeros(len(words)), 0.0
    for path in itertools.product((0, 1), repeat=len(words)):
        steps = list(zip((0, *path), path))
        value = np.exp(sum(u[y] for u, y in zip(unary, path)) + sum(model.moves[s] for s in steps))
        blank += np.exp(sum(model.bias * y for y in path) + sum(model.moves[s] for s in steps))
        total += value
        sums += value * np.array(path)
    _, at, found, _ = model.sums(" ".join(words))
    assert at == [1, 3, 4]
    assert np.allclose(found, (sums / total)[at])
    assert np.isclose(model.marginals(len(words), at, [2.5, 1.0, 2.5])[1], np.log(total / blank))


def test_fitted_scores_separate_unseen_documents_and_find_the_words():
    model = toxicity.fit(sample(1, 600))
    for text, label in sample(2, 200):
        assert (model.score(model.sums(text)[3]) >= toxicity.THRESHOLD) == bool(label)
    words, at, found, _ = model.sums("w1 w2 fouler w3 vile vile w4")
    assert [words[i] for i, p in zip(at, found) if p >= 0.5] == ["fouler", "vile", "vile"]


def test_a_sample_of_one_label_scores_low():
    model = toxicity.fit([("a b", 0), ("c", 0)])
    assert model.score(model.sums("a b")[3]) < toxicity.THRESHOLD


def test_rows_with_nulls_long_texts_and_clashing_names(spark):
    model = toxicity.fit(sample(1, 600))
    rows = [Row(doc_id=1, text="İ w1 VILE fouler", score="x"), Row(doc_id=1, text="İ w1 VILE fouler", score="x")]
    rows += [Row(doc_id=None, text=None, score=None), Row(doc_id=3, text="", score="y")]
    rows += [Row(doc_id=4, text="w1 " * 100_000 + "vile", score="z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = toxicity.tag(docs, model).collect()
    assert len(out) == 5 and out[0] == out[1]
    assert [out[0]["text"][s["start"] : s["end"]] for s in out[0]["toxic_spans"]] == ["VILE", "fouler"]
    assert out[2]["toxic_spans"] == [] and 0 <= out[2]["score"] < toxicity.THRESHOLD
    assert out[2]["score"] == out[3]["score"]
    assert out[4]["text"][out[4]["toxic_spans"][0]["start"] :] == "vile"
    assert toxicity.tag(docs.limit(0), model).count() == 0


def test_held_out_rows_and_training(spark):
    texts = sample(1, 400)
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, label) for i, (_, label) in enumerate(texts)] + [(None, 1), (7, None)], "doc_id long, toxic int"
    )
    marks = {r[0]: r[1] for r in docs.select("doc_id", toxicity.held_out(F.col("doc_id"))).collect()}
    assert marks == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(400)}
    out = toxicity.tag(docs, toxicity.train(docs, labels), spans=False).collect()
    wrong = sum(row["predicted"] != texts[row["doc_id"]][1] for row in out if marks[row["doc_id"]])
    assert wrong == 0
    assert toxicity.train(docs.limit(0), labels.limit(0)).weights == {}
