"""Two-class scores: from logits to probabilities, classes and back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def softmax_pair(logit_0: Column, logit_1: Column) -> Column:
    """``array(p0, p1)`` of two logits."""
    p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(logit_0 - logit_1))
    return F.array(F.lit(1.0) - p1, p1)


def chosen_class(probabilities: Column) -> Column:
    """Index of the largest probability; the lowest one wins ties."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def chosen_probability(probabilities: Column, classes: Column) -> Column:
    return F.element_at(probabilities, classes + 1)


def linear_probabilities(features: Mapping[str, float], bias: float) -> Column:
    """Probabilities of a fixed linear model over numeric columns."""
    logit = F.lit(float(bias))
    for name, weight in features.items():
        logit = logit + F.col(name).cast("double") * F.lit(float(weight))
    return softmax_pair(F.lit(0.0), logit)
