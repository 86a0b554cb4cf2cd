"""The DPH relevance model (Amati et al., TREC 2007 blog track), as column expressions."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_MINUS_INFINITY = float("-inf")

# Term scores are kept as multiples of this power of two. Sums of such numbers are exact, so a
# score does not depend on the order in which a shuffle delivers its parts, and neither do ties.
_GRAIN = float(2**40)


def log2_or_minus_infinity(x: Column) -> Column:
    """log2 with log2(0) = -Infinity; Spark's own gives null there, which sums would skip."""
    return F.when(x == 0, F.lit(_MINUS_INFINITY)).otherwise(F.log2(x))


def rarity(n_docs: Column, cf: Column, ratio: str) -> Column:
    """Documents per occurrence of a term; ``integer`` truncates it, ``real`` does not.

    Null where the term never occurs.
    """
    if ratio == "integer":
        per_occurrence = F.call_function("div", n_docs, cf)
    elif ratio == "real":
        per_occurrence = n_docs / cf
    else:
        raise ValueError(f"ratio must be 'integer' or 'real', not {ratio!r}")
    return F.when(cf > 0, per_occurrence.cast("double"))


def dph(tf: Column, length: Column, avg_len: Column, rarity: Column) -> Column:
    """DPH score of one term in one document.

    -Infinity where ``rarity`` is 0; NaN for a document made of one repeated term.
    """
    tf = tf.cast("double")
    f = tf / length
    norm = (1 - f) * (1 - f) / (tf + 1)
    score = norm * (
        tf * log2_or_minus_infinity(tf * avg_len / length * rarity)
        + 0.5 * log2_or_minus_infinity(2 * math.pi * tf * (1 - f))
    )
    return F.rint(score * _GRAIN) / _GRAIN


def merit(score: Column) -> Column:
    """The score as a sort key: NaN, which Spark takes for the largest double, goes last."""
    return F.nanvl(score, F.lit(_MINUS_INFINITY))
