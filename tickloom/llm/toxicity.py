"""Toxicity: a logistic classifier regularised by counterfactuals.

Features are which words and which pieces of words (4 and 5 characters with word ends
marked, and longer beginnings) a text has, in at least 1, 2 or 4 of its different
words.  Their document counts by label are taken over the training
sample in Spark, and those that tell most of the label (by the likelihood ratio of
their two by two table) are kept.  Weights minimise the
logistic loss, a squared norm, and the squared change of the score between a labelled
text and its counterfactual, in which each identity term is swapped for another one of
its group.  So mentioning a group is not by itself a sign of toxicity.

Learned from at most ``limit`` labelled rows, half of each label, never held-out ones.
Empty and null texts score by the intercept.  Null doc_id: scored, never learned from.
Repeated rows score alike.  Without labels of both kinds every score is the share of
label 1 (0 without labels).  Extra columns are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tickloom.llm import labelled
from tickloom.llm.store import lean, staged, to_arrow

#: Labelled rows that the classifier is fitted on.
LIMIT = 8_000
#: Features kept, and the least number of sample documents that have one.
FEATURES, LEAST_DOCS = 1500, 3
#: Least likelihood ratio (2 ln) of a feature's table; chance gives that much once in a thousand.
SURE = 10.8
THRESHOLD = 0.5
RIDGE, COUNTERFACTUAL, STEPS = 1e-4, 1.0, 250
#: Words whose features a task remembers.
CACHE = 100_000
#: Features that a task counts before it passes them on.
HELD_FEATURES = 200_000

#: Groups of identity terms; within a group any may stand for any other.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "bisexual", "transgender", "straight"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("deaf", "blind", "disabled"),
    ("old", "young", "elderly"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("frauen", "männer"),
    ("mujeres", "hombres"),
    ("femmes", "hommes"),
)

_WORD = re.compile(r"[^\W_]+")
_SWAP = {term: group[(i + 1) % len(group)] for group in IDENTITY_TERMS for i, term in enumerate(group)}


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def pieces(word: str) -> set[str]:
    """A word itself, its pieces with the ends marked, and its beginnings."""
    marked = f"^{word}$"
    found = {marked[i : i + n] for n in (4, 5) for i in range(len(marked) - n + 1)}
    return found | {f"={word}"} | {marked[:n] for n in range(6, min(len(marked), 11))}


#: A feature is a piece in at least so many different words of a text.
LEVELS = (1, 2, 4)


def named(piece: str, level: int) -> str:
    return f"{piece} {level}"


def all_features(own: set[str]) -> Iterator[str]:
    counts: Counter = Counter()
    for word in own:
        counts.update(pieces(word))
    for piece, count in counts.items():
        for level in LEVELS:
            if count >= level:
                yield named(piece, level)


class Model(NamedTuple):
    names: dict[str, int]
    weights: np.ndarray
    bias: float


class Featurizer:
    """The numbers of the known features of a text, with the words of before remembered."""

    def __init__(self, names: dict[str, int]):
        self._pieces: dict[str, list[tuple[int, int]]] = {}
        for name, number in names.items():
            piece, level = name.rsplit(" ", 1)
            self._pieces.setdefault(piece, []).append((int(level), number))
        self._known: dict[str, tuple[str, ...]] = {}

    def __call__(self, own: set[str]) -> list[int]:
        known, counts = self._known, Counter()
        for word in own:
            found = known.get(word)
            if found is None:
                if len(known) >= CACHE:
                    known.clear()
                found = known[word] = tuple(p for p in pieces(word) if p in self._pieces)
            if found:
                counts.update(found)
        return sorted(number for piece, count in counts.items() for level, number in self._pieces[piece] if count >= level)


_COUNT = StructType([StructField("feature", StringType()), StructField("n0", LongType()), StructField("n1", LongType())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by feature and label, among some of a task's documents."""
    by_label: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            by_label[label].update(all_features(words(text.as_py())))
            if len(by_label[label]) > HELD_FEATURES:
                yield _counted(by_label)
    if by_label[0] or by_label[1]:
        yield _counted(by_label)


def _counted(by_label: tuple[Counter, Counter]) -> pa.RecordBatch:
    names = list(by_label[0].keys() | by_label[1].keys())
    counts = [pa.array([c[n] for n in names], pa.int64()) for c in by_label]
    for c in by_label:
        c.clear()
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *counts], schema=to_arrow(_COUNT))


def _selected(texts: DataFrame, counts: dict[int, int], shares: dict[int, float], features: int) -> list[str]:
    """The features that tell most of the label."""
    n0, n1 = (counts[k] * shares[k] for k in (0, 1))
    found = texts.mapInArrow(lean(_count), _COUNT).groupBy("feature").agg(F.sum("n0").alias("a"), F.sum("n1").alias("b")).where(f"a + b >= {LEAST_DOCS}")
    a, b = F.least("a", F.lit(n0)), F.least("b", F.lit(n1))
    share, total = (a + b) / (n0 + n1), F.lit(0.0)
    for seen, expected in ((a, n0 * share), (b, n1 * share), (n0 - a, n0 * (1 - share)), (n1 - b, n1 * (1 - share))):
        total = total + F.when((seen > 0) & (expected > 0), 2 * seen * F.log(seen / expected)).otherwise(0.0)
    return [r["feature"] for r in found.where(total > SURE).orderBy(total.desc(), "feature").limit(features).collect()]


_EXAMPLE = StructType([StructField("label", IntegerType()), StructField("real", ArrayType(IntegerType())), StructField("swapped", ArrayType(IntegerType()))])


def _examples(names: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Featurizer(names)
        types = to_arrow(_EXAMPLE)
        for batch in batches:
            own = [words(t.as_py()) for t in batch.column(1)]
            swapped = [known({_SWAP.get(w, w) for w in x}) if not _SWAP.keys().isdisjoint(x) else None for x in own]
            columns = ([known(x) for x in own], swapped)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), *(pa.array(c, f.type) for c, f in zip(columns, list(types)[1:], strict=True))], schema=types)

    return run


class _Rows:
    """Sparse 0/1 rows."""

    def __init__(self, rows: list[list[int]]):
        self.columns = np.array([i for r in rows for i in r], np.int64)
        self.rows = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.count = len(rows)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.columns], self.count)

    def back(self, errors: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.columns, errors[self.rows], width)


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x)))


def fit(real: list[list[int]], swapped: list[list[int] | None], labels: np.ndarray, width: int, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam over all examples."""
    pairs = [i for i, s in enumerate(swapped) if s is not None]
    x, a, b = _Rows(real), _Rows([real[i] for i in pairs]), _Rows([swapped[i] for i in pairs])
    theta, first, second = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    weight = weight / weight.sum()
    for step in range(1, STEPS + 1):
        error = (sigmoid(x.times(theta[:-1]) + theta[-1]) - labels) * weight
        slope = np.r_[x.back(error, width), error.sum()]
        slope[:-1] += RIDGE * theta[:-1]
        if pairs:
            change = COUNTERFACTUAL * 2 / len(pairs) * (a.times(theta[:-1]) - b.times(theta[:-1]))
            slope[:-1] += a.back(change, width) - b.back(change, width)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta = theta - 0.1 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, limit: int = LIMIT, features: int = FEATURES) -> Model:
    chosen, counts, shares = labelled.sample(labels, "toxic", limit)
    total = sum(counts.values())
    if len(counts) < 2:
        prior = counts.get(1, 0) / max(total, 1)
        return Model({}, np.zeros(0), float(np.log((prior + 1e-6) / (1 - prior + 1e-6))))
    texts = staged(labelled.texts(docs, chosen), "sample")
    names = {f: i for i, f in enumerate(_selected(texts, counts, shares, features))}
    # In a fixed order, so that weights do not hang on that of the tasks.
    rows = sorted(texts.mapInArrow(lean(_examples(names)), _EXAMPLE).collect(), key=lambda r: (r["label"], r["real"], r["swapped"] or []))
    if not rows:
        return Model({}, np.zeros(0), float(np.log((counts[1] + 0.5) / (counts[0] + 0.5))))
    y = np.array([r["label"] for r in rows], float)
    # A label sampled more thinly counts for more, so scores follow the shares of the labels.
    weight = np.where(y == 1, 1 / shares[1], 1 / shares[0])
    weights, bias = fit([r["real"] for r in rows], [r["swapped"] for r in rows], y, len(names), weight)
    return Model(names, weights, bias)


def with_score(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with the score of each whole text as DOUBLE column ``name``."""
    schema = StructType([*(f for f in docs.schema.fields if f.name != name), StructField(name, DoubleType())])
    others = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, known = to_arrow(schema), Featurizer(model.names)
        for batch in batches:
            raw = [model.bias + float(model.weights[known(words(t.as_py()))].sum()) if t.is_valid else model.bias for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).cast(types.field(c).type) for c in others), pa.array(sigmoid(raw))], schema=types)

    return docs.mapInArrow(lean(run), schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = with_score(docs.select("doc_id", "text"), train(docs, labels), "score")
    return scored.select("doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without those predicted toxic."""
    return with_score(docs, model, "__score").where(F.col("__score") < THRESHOLD).select(*docs.columns)
