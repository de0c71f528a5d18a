"""Quality classifier: Bradley-Terry pairwise ranking.

A document's worth is a linear function of its features: shares of letters, capitals,
digits and symbols, repetition of words and lines, and how often each shape of word
occurs.  It is learned from preference pairs (a document labelled 1 is preferred to
one labelled 0) by the logistic loss on the difference of their features.  The cut is a
quantile of the worths of all labelled rows, at the share of label 0.  The score is the
worth through a logistic curve that gives ``threshold`` at the cut.

The weights are learned from at most ``limit`` labelled rows, half of each label; the pairs
are a bounded, fixed choice among them.  Held-out rows are neither in them nor in the cut.  Null text counts as empty; empty
texts are scored like others.  Null doc_id: scored, never learned from.  Repeated rows
score alike.  Without labels of both kinds every worth is 0.  Extra columns are left out.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructField, StructType

from tickloom.llm import labelled
from tickloom.llm.store import lean, staged, to_arrow
from tickloom.llm.text import WORD
from tickloom.session import BROADCAST_ROWS, freed

LIMIT = 12_000
PAIRS, STEPS, RIDGE = 60_000, 300, 1e-3
THRESHOLD = 0.3
#: Shapes of words are hashed to so many features.
SHAPES = 96
FAR = 8.0
#: The rank of the cut is right to one in so many.
RANKS = 1_000_000
CACHE = 300_000

_BYTE = np.arange(256)


def _of(characters: str) -> np.ndarray:
    return np.isin(_BYTE, [ord(c) for c in characters])


#: Classes of bytes whose shares are features.
_CLASSES = np.array(
    [
        (_BYTE >= 97) & (_BYTE <= 122),
        (_BYTE >= 65) & (_BYTE <= 90),
        (_BYTE >= 48) & (_BYTE <= 57),
        _BYTE >= 128,
        _of(".,;:"),
        _of("!?"),
        _of("#*$%&|<>"),
        _of("{}[]()/\\=+_~^@"),
        _of("'\"-`"),
        _BYTE == 10,
        _BYTE < 32,
    ],
    float,
)
WIDTH = len(_CLASSES) + 8 + SHAPES


def shape(word: str) -> int:
    """The feature of a word's shape: runs of capitals, small letters and digits count as one each, signs as they are."""
    seen = []
    for c in word:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not seen or seen[-1] != kind:
            seen.append(kind)
    return zlib.crc32("".join(seen).encode()) % SHAPES


class Features:
    """The features of a whole text; the shapes of words of before are remembered."""

    def __init__(self):
        self._shapes: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        out = np.zeros(WIDTH)
        raw = (text or "").encode()
        own = WORD.findall(text or "")
        if not own:
            return out
        n = len(own)
        bytes_ = _CLASSES @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        out[: len(_CLASSES)] = bytes_ / len(raw)
        counts = Counter(own)
        lines = [line for line in text.split("\n") if line]
        common = counts.most_common(1)[0][1]
        at = len(_CLASSES)
        out[at : at + 8] = (
            np.log1p(n) / 10,
            min(len(raw) / n, 40) / 10,
            1 - len(counts) / n,
            common / n if n >= 10 else 0,
            sum(map(eq, own, own[1:])) / n,
            1 - len(set(lines)) / max(len(lines), 1),
            len(lines) / n,
            # Words of which there is only one, against those of a random text of the length.
            sum(1 for c in counts.values() if c == 1) / n,
        )
        shapes = self._shapes
        by_shape = np.zeros(SHAPES)
        for word, count in counts.items():
            number = shapes.get(word)
            if number is None:
                if len(shapes) >= CACHE:
                    shapes.clear()
                number = shapes[word] = shape(word)
            by_shape[number] += count
        out[at + 8 :] = by_shape / n
        return out


def standard(features: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Features in deviations from the mean, at most ``FAR`` of them."""
    return np.clip((features - mean) / scale, -FAR, FAR)


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    theta: np.ndarray
    cut: float
    threshold: float

    def worth(self, features: np.ndarray) -> np.ndarray:
        return standard(features, self.mean, self.scale) @ self.theta

    def scores(self, features: np.ndarray) -> np.ndarray:
        worth = self.worth(features)
        return 1 / (1 + np.exp(-np.clip(worth - self.cut + np.log(self.threshold / (1 - self.threshold)), -700, 700)))


_EXAMPLE = StructType([StructField("label", IntegerType()), StructField("chosen", BooleanType()), StructField("features", ArrayType(DoubleType()))])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features, types = Features(), to_arrow(_EXAMPLE)
    for batch in batches:
        rows = [features(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), batch.column(1), pa.array(rows, types.field(2).type)], schema=types)


def fit(features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and weights: full-batch Adam on the Bradley-Terry loss."""
    mean, scale = features.mean(0), features.std(0)
    scale = np.where(scale < 1e-9, 1.0, scale)
    x = standard(features, mean, scale)
    chosen = np.random.default_rng(20)
    better, worse = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    count = min(PAIRS, 4 * len(labels))
    difference = x[chosen.choice(better, count)] - x[chosen.choice(worse, count)]
    theta, first, second = np.zeros(WIDTH), np.zeros(WIDTH), np.zeros(WIDTH)
    for step in range(1, STEPS + 1):
        lost = 1 / (1 + np.exp(np.clip(difference @ theta, -500, 500)))
        slope = -(lost @ difference) / count + RIDGE * theta
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta = theta - 0.05 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return mean, scale, theta


def quantile(values: DataFrame, share: float) -> float:
    """The middle between the ``value`` at ``share`` of all rows and the next one."""
    low = values.agg(F.percentile_approx("value", share, RANKS)).first()[0]
    above = values.where(F.col("value") > low).agg(F.min("value")).first()[0]
    return low if above is None else (low + above) / 2


def _worths(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                features = batch.column(0).values.to_numpy(zero_copy_only=False)[batch.column(0).offset * WIDTH :][: batch.num_rows * WIDTH]
                yield pa.RecordBatch.from_arrays([pa.array(model.worth(features.reshape(-1, WIDTH)))], names=["value"])

    return run


def train(docs: DataFrame, labels: DataFrame, limit: int = LIMIT, threshold: float = THRESHOLD) -> Model:
    neutral = Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), 0.0, threshold)
    usable, counts, _ = labelled.usable(labels, "quality", limit)
    if len(counts) < 2:
        return neutral
    if sum(counts.values()) <= BROADCAST_ROWS:
        usable = F.broadcast(usable)
    examples = staged(labelled.all_texts(docs, usable).mapInArrow(lean(_examples), _EXAMPLE), "examples")
    rows = examples.where("chosen").collect()
    y = np.array([r["label"] for r in rows])
    if len(set(y.tolist())) < 2:
        return neutral
    x = np.array([r["features"] for r in rows])
    # Rows in a fixed order, so that the choice of pairs does not hang on that of the tasks.
    order = np.lexsort((*x.T[::-1], y))
    x, y = x[order], y[order]
    mean, scale, theta = fit(x, y)
    model = Model(mean, scale, theta, 0.0, threshold)
    worths = staged(examples.select("features").mapInArrow(lean(_worths(model)), "value double"), "worths")
    bad = examples.agg(F.avg((F.col("label") == 0).cast("int"))).first()[0]
    freed(examples)
    return model._replace(cut=quantile(worths, bad))


def with_score(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with the score of each whole text as DOUBLE column ``name``."""
    schema = StructType([*(f for f in docs.schema.fields if f.name != name), StructField(name, DoubleType())])
    others = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, features = to_arrow(schema), Features()
        for batch in batches:
            rows = [features(t.as_py()) for t in batch.column("text")]
            scores = model.scores(np.array(rows)) if rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).cast(types.field(c).type) for c in others), pa.array(scores)], schema=types)

    return docs.mapInArrow(lean(run), schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = with_score(docs.select("doc_id", "text"), train(docs, labels), "score")
    return scored.select("doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
