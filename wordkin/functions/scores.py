"""Association scores over pair and word counts. All logarithms are natural."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joint_probability(pair: Column, total: Column) -> Column:
    return F.try_divide(pair.cast("double"), total.cast("double"))


def pmi(pair: Column, left: Column, right: Column, total: Column) -> Column:
    """Pointwise mutual information. A zero count gives NULL."""
    return F.ln(pair) + F.ln(total) - F.ln(left) - F.ln(right)


def npmi(pair: Column, left: Column, right: Column, total: Column) -> Column:
    """PMI divided by ``-ln p(pair)``. NULL where that is zero."""
    return F.try_divide(pmi(pair, left, right, total), -F.ln(joint_probability(pair, total)))


def is_perfect(pair: Column, left: Column, right: Column) -> Column:
    """The two words occur only together, so NPMI is 1. Tested on the integers: the rounded score
    falls on either side of 1."""
    return (pair == left) & (pair == right)
