"""Toxic spans by a linear-chain conditional random field, gathered to document scores.

Every token is clean (0) or toxic (1). A token's evidence is its lower-case word and its
prefixes; only evidence seen in enough toxic sample documents, and mostly there, has a weight.
All other tokens share one potential, so a run of k of them is the k-th power of one 2 x 2
matrix: forward and backward passes step from one evidence token to the next and are still
those of the whole chain, whatever the length of the text.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")
PREFIXES = (4, 5, 6, 7)
SAMPLE_ROWS = 6_000  # labelled documents used for fitting, at most a third of them toxic
# Of a longer document so many characters, from a place that its id chooses, give words and sequences to the fit;
# the map to a probability is fitted on whole documents below it. Scores read every document whole.
SAMPLE_CHARS = 20_000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
WINDOW = 48  # tokens of a training sequence
MOST_WINDOWS = 2_000  # training sequences, half of them at most from clean documents; chosen by a hash, from anywhere
MOST_WORDS = 400_000  # words whose evidence a task remembers


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from the fit: crc32 of the id's text modulo 4 is 2. Null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def evidence(word: str) -> list[str]:
    """The names of a lower-case word's features."""
    return [word] + [f"{word[:n]}*" for n in PREFIXES if len(word) >= n]


@dataclass
class Model:
    """Weights of the field and of the map from its sums to a probability."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    scale: np.ndarray = field(default_factory=lambda: np.array([-3.0, 0.0, 0.0, 0.0]))

    def __post_init__(self) -> None:
        self.known: dict[str, float | None] = {}
        step = np.exp(self.moves) * np.exp(np.array([0.0, self.bias]))
        values, vectors = np.linalg.eig(step)
        self.values, self.vectors, self.inverse = values.real, vectors.real, np.linalg.inv(vectors).real

    def weight(self, word: str) -> float | None:
        """The evidence of a word for being toxic; None if it has none."""
        if word in self.known:
            return self.known[word]
        found = [self.weights[name] for name in evidence(word) if name in self.weights]
        if len(self.known) >= MOST_WORDS:
            self.known.clear()
        self.known[word] = value = sum(found) if found else None
        return value

    def plain(self, k: int) -> tuple[np.ndarray, float]:
        """The matrix of k tokens without evidence, divided by the power of its larger eigenvalue (whose log is second)."""
        top = self.values.max()
        return (self.vectors * (self.values / top) ** k) @ self.inverse, k * math.log(top)

    def marginals(self, n: int, at: list[int], weights: list[float]) -> tuple[np.ndarray, float]:
        """P(toxic) of the evidence tokens of n tokens, and how far their evidence lifts the log of the partition sum."""
        row, log = np.array([1.0, 0.0]), 0.0  # as if a clean token stood before the text
        rows, here = [], -1
        for place, weight in zip(at, weights, strict=True):
            matrix, more = self.plain(place - here - 1)
            row = row @ matrix @ np.exp(self.moves) * np.exp(np.array([0.0, self.bias + weight]))
            total = row.sum()
            row, log = row / total, log + more + math.log(total)
            rows.append(row)
            here = place
        matrix, more = self.plain(n - here - 1)
        log += more + math.log((row @ matrix).sum())
        column = matrix.sum(axis=1)
        found = np.zeros(len(at))
        for i in range(len(at) - 1, -1, -1):
            both = rows[i] * column
            found[i] = both[1] / both.sum()
            if i:
                step = np.exp(self.moves) * np.exp(np.array([0.0, self.bias + weights[i]]))
                column = self.plain(at[i] - at[i - 1] - 1)[0] @ (step @ column)
                column /= column.sum()
        matrix, more = self.plain(n)
        return found, log - more - math.log((np.array([1.0, 0.0]) @ matrix).sum())

    def sums(self, text: str) -> tuple[list[str], list[int], np.ndarray, np.ndarray]:
        """Words, evidence places, their marginals, and the document's inputs to the score."""
        words = WORD.findall(text.lower())
        known = self.known
        at = [i for i, word in enumerate(words) if (known[word] if word in known else self.weight(word)) is not None]
        if not at:
            return words, at, np.zeros(0), np.array([1.0, 0.0, 0.0, 0.0])
        found, lift = self.marginals(len(words), at, [self.weight(words[i]) for i in at])
        count = float(found.sum())
        return words, at, found, np.array([1.0, math.log1p(max(lift, 0.0)), math.log1p(count), count / len(words)])

    def score(self, inputs: np.ndarray) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(inputs @ self.scale)))))


def _lexicon(texts: list[tuple[set[str], int]]) -> dict[str, float]:
    """Log odds of features that a hundredth of the toxic documents (three at least) have and that clean ones mostly lack.

    A prefix must also stand for at least three words, else the word itself says more.
    """
    toxic, clean = Counter(), Counter()
    forms: dict[str, set[str]] = {}
    for words, label in texts:
        names = {name for word in words for name in evidence(word)}
        (toxic if label else clean).update(names)
        for word in words if label else ():
            for name in evidence(word)[1:]:
                forms.setdefault(name, set()).add(word)
    for name, words in forms.items():
        if len(words) < 3:
            del toxic[name]
    sick = sum(label for _, label in texts)
    well = len(texts) - sick
    least = max(3, sick // 100)
    odds = {
        name: math.log((n + 0.5) / (sick + 1)) - math.log((clean[name] + 0.5) / (well + 1))
        for name, n in toxic.items()
        if n >= least
    }
    return {name: value for name, value in odds.items() if value >= 2.5 and value * math.sqrt(toxic[name]) >= 8}


def _fit_chain(model: Model, windows: list[tuple[list[float], list[int]]], steps: int = 120) -> tuple[float, float, np.ndarray]:
    """Gradient ascent on the conditional likelihood: a factor for the evidence, the bias and the moves."""
    x = np.array([w + [0.0] * (WINDOW - len(w)) for w, _ in windows])
    there = np.array([[1.0] * len(w) + [0.0] * (WINDOW - len(w)) for w, _ in windows])
    y = np.array([t + [0] * (WINDOW - len(t)) for _, t in windows])
    share, bias, moves = 1.0, -4.0, np.zeros((2, 2))
    rate, memory = 0.25, np.zeros(5)
    for _ in range(steps):
        unary = np.stack([np.zeros_like(x), share * x + bias], axis=2) * there[:, :, None]
        step = np.exp(moves)
        forward = np.empty((len(x), WINDOW, 2))
        backward = np.ones((len(x), WINDOW, 2))
        forward[:, 0] = step[0] * np.exp(unary[:, 0])
        forward[:, 0] /= forward[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, WINDOW):
            on = there[:, t, None]
            value = (forward[:, t - 1] @ step) * np.exp(unary[:, t])
            forward[:, t] = on * value / value.sum(axis=1, keepdims=True) + (1 - on) * forward[:, t - 1]
        for t in range(WINDOW - 2, -1, -1):
            on = there[:, t + 1, None]
            value = (backward[:, t + 1] * np.exp(unary[:, t + 1])) @ step.T
            backward[:, t] = on * value / value.sum(axis=1, keepdims=True) + (1 - on) * backward[:, t + 1]
        p = forward * backward
        p = p[:, :, 1] / p.sum(axis=2)
        miss = (y - p) * there
        pair = forward[:, :-1, :, None] * step * (np.exp(unary[:, 1:]) * backward[:, 1:])[:, :, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        seen = np.zeros_like(pair)
        for a in (0, 1):
            for b in (0, 1):
                seen[:, :, a, b] = (y[:, :-1] == a) & (y[:, 1:] == b)
        turn = ((seen - pair) * there[:, 1:, None, None]).sum(axis=(0, 1)) / len(x)
        slope = np.array([(miss * x).sum() / len(x), miss.sum() / len(x), turn[0, 1], turn[1, 0], turn[1, 1]])
        slope -= 0.01 * np.array([share - 1, 0.0, moves[0, 1], moves[1, 0], moves[1, 1]])
        memory = 0.9 * memory + 0.1 * slope
        change = rate * memory
        share, bias = share + change[0], bias + change[1]
        moves = moves + np.array([[0.0, change[2]], [change[3], change[4]]])
    return share, bias, moves


def _fit_scale(inputs: np.ndarray, labels: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a light pull towards zero."""
    scale = start.copy()
    if not len(labels):
        return scale
    pull = 1e-3 * np.eye(len(scale))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(inputs @ scale, -30, 30)))
        slope = inputs.T @ (labels - p) - pull @ scale
        bend = (inputs * (p * (1 - p))[:, None]).T @ inputs + pull + 1e-6 * np.eye(len(scale))
        scale = scale + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return scale


def fit(texts: list[tuple[str, int]]) -> Model:
    """The model of a bounded sample of (text, label); without toxic rows every score is near zero.

    Labels are of documents: a token of a toxic document counts as labelled toxic if it has evidence.
    Texts that occur more than once count once.
    """
    texts = sorted(set(texts))
    split = [(WORD.findall(text.lower()), label) for text, label in texts]
    if not any(label for _, label in split) or all(label for _, label in split):
        return Model()
    weights = _lexicon([(set(words), label) for words, label in split])
    model = Model(weights)
    drawn: tuple[list, list] = ([], [])
    tokens = [[model.weight(word) for word in words] for words, _ in split]
    for number, ((text, label), values) in enumerate(zip(texts, tokens, strict=True)):
        starts = {max(0, i - WINDOW // 2) for i, value in enumerate(values) if value is not None}
        if not label:
            starts.update(range(0, len(values), WINDOW))
        mark = zlib.crc32(text.encode())
        drawn[bool(label)].extend((zlib.crc32(b"%d" % start, mark), number, start) for start in starts)
    windows: tuple[list, list] = ([], [])
    for label, places in enumerate(drawn):
        for _, number, start in heapq.nsmallest(MOST_WINDOWS // 2, places):
            part = tokens[number][start : start + WINDOW]
            windows[label].append(([value or 0.0 for value in part], [int(bool(label) and value is not None) for value in part]))
    if any(windows):
        share, bias, moves = _fit_chain(model, windows[0] + windows[1])
        model = Model({name: value * share for name, value in weights.items()}, bias, moves)
    # a part of a longer document says nothing about the document's sums
    whole = [(text, label) for text, label in texts if len(text) < SAMPLE_CHARS]
    inputs = np.array([model.sums(text)[3] for text, _ in whole])
    labels = np.array([label for _, label in whole], dtype=float)
    return Model(model.weights, model.bias, model.moves, _fit_scale(inputs, labels, model.scale))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits on at most sample_rows labelled documents that are not held out, chosen by a hash of the id.

    At most sample_rows texts of at most SAMPLE_CHARS characters reach the driver.
    Rows of labels without id or label count as absent; an id labelled more than once counts as toxic
    if any of its labels does.
    """
    marked = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label"))
    marked = marked.withColumn("order", F.xxhash64("doc_id"))
    third = sample_rows // 3
    sick = marked.where("label = 1").orderBy("order", "doc_id").limit(third)
    well = marked.where("label = 0").orderBy("order", "doc_id").limit(sample_rows - third)
    chosen = sick.unionByName(well).select("doc_id", "label")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("length(text) > 0")
    # of rows that repeat an id one takes part, so at most sample_rows reach the driver
    picked = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"))).alias("text")
    )
    start = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1) + 1
    rows = picked.select(F.substring("text", start.cast("int"), F.lit(SAMPLE_CHARS)).alias("text"), "label").collect()
    return fit([(row["text"], row["label"]) for row in rows])


def tag(docs: DataFrame, model: Model, threshold: float = THRESHOLD, spans: bool = True) -> DataFrame:
    """Adds score, predicted, toxic_tokens and (on request) toxic_spans to every row.

    Spans are code point offsets [start, end) of tokens whose marginal is at least one half, with that
    marginal. Every input column is kept; an input column named like an added one is replaced. A null or
    empty text gets the score of a text without evidence and no spans. Repeated rows get equal results.
    """
    added = ["score", "predicted", "toxic_tokens"] + ["toxic_spans"] * spans
    kept = [name for name in docs.columns if name not in added]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[f"`{k}`" for k in kept]).schema.fields]
    fields += ["score double", "predicted int", "toxic_tokens bigint"]
    fields += ["toxic_spans array<struct<start:int,end:int,p:double>>"] * spans
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # what words a model remembers goes with the task, not with the worker that holds the broadcast
        told = shared.value
        model = Model(told.weights, told.bias, told.moves, told.scale)
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                scores, counts, places = [], [], []
                for text in batch.column("text").to_pylist():
                    words, at, found, inputs = model.sums(text or "")
                    scores.append(model.score(inputs))
                    toxic = [(i, p) for i, p in zip(at, found.tolist(), strict=True) if p >= 0.5]
                    counts.append(len(toxic))
                    if spans:
                        places.append(_offsets(text, words, toxic) if toxic else [])
                columns = [*batch.columns, pa.array(scores, pa.float64())]
                columns.append(pa.array([int(score >= threshold) for score in scores], pa.int32()))
                columns += [pa.array(counts, pa.int64())] + [pa.array(places, kind)] * spans
                yield pa.RecordBatch.from_arrays(columns, names=kept + added)

    return docs.select(*[f"`{name}`" for name in kept]).mapInArrow(rows, ", ".join(fields))


def _offsets(text: str, words: list[str], toxic: list[tuple[int, float]]) -> list[dict]:
    """Places of the toxic tokens in the text as it was before lower-casing."""
    lower = text.lower()
    spans = [match.span() for match in WORD.finditer(lower)]
    if len(lower) == len(text):
        return [{"start": spans[i][0], "end": spans[i][1], "p": p} for i, p in toxic]
    origin = [at for at, char in enumerate(text) for _ in char.lower()] + [len(text)]
    return [{"start": origin[spans[i][0]], "end": origin[spans[i][1] - 1] + 1, "p": p} for i, p in toxic]
