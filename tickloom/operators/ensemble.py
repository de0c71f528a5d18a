"""Combinations of prediction columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .regress import fit_linear, score_linear


def weighted(predictions: Sequence[Column], weights: Sequence[float]) -> Column:
    """Sum of weight times prediction; the weights are taken as they are."""
    if len(predictions) != len(weights):
        raise ValueError("there must be one weight for each prediction")
    return reduce(add, [p * F.lit(float(w)) for p, w in zip(predictions, weights)])


def voting(predictions: Sequence[Column]) -> Column:
    """Plain mean of the predictions."""
    return reduce(add, predictions) / len(predictions)


def stack(
    held_out: DataFrame, test: DataFrame, bases: Sequence[str], ridge: float = 1.0
) -> DataFrame:
    """Predictions of a ridge model over base predictions, for all tickers at once.

    ``held_out`` has the base predictions of training rows, each by models that
    did not see the row; ``test`` those of new rows.
    """
    meta = durable(fit_linear(held_out, inputs=bases, ridge=ridge))
    return score_linear(test, meta, inputs=bases)
