"""Normalised edit distance between titles, as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a title closer than this to a kept one is a near duplicate; exactly this far is not.
NEAR_DUPLICATE_BELOW = 0.5


# Titles longer than this are compared by how often they have these characters before any distance is taken.
_LONG = 256
_COUNTED = " eaionrstlducmh"


def _longer(left: Column, right: Column) -> Column:
    return F.greatest(F.length(left), F.length(right))


def title_distance(left: Column, right: Column) -> Column:
    """Edit distance over the longer length: 0 for equal titles, 1 for nothing in common.

    Two empty titles have no distance and give NaN, which no threshold test accepts.
    """
    longer = _longer(left, right)
    return F.when(longer == 0, F.lit(float("nan"))).otherwise(F.levenshtein(left, right) / longer)


def title_profile(title: Column) -> Column:
    """How often a title has each of some frequent characters, as an array: taken once per title, compared per pair."""
    return F.array(*[F.length(title) - F.length(F.replace(title, F.lit(c), F.lit(""))) for c in _COUNTED])


def _fewest_edits_doubled(left: Column, right: Column) -> Column:
    """At most twice the edit distance of titles with these profiles: one edit changes the counts of two characters by one at most."""
    apart = F.zip_with(left, right, lambda a, b: F.abs(a - b))
    return F.aggregate(apart, F.lit(0), lambda total, n: total + n)


def is_near_duplicate(
    left: Column, right: Column, left_profile: Column | None = None, right_profile: Column | None = None
) -> Column:
    """``title_distance(left, right) < 0.5``, without a full distance where less settles it.

    Equal titles are near unless empty. The distance is at least the difference in length, so
    titles of very different lengths never are, nor are long titles with very different counts of frequent
    characters, as their profiles tell; give those if a title meets many others. What remains needs fewer than half as many edits
    as the longer title has characters, which bounds the band the edit distance has to look at.
    """
    longer = _longer(left, right)
    most_edits = F.floor((longer - 1) / 2).cast("int")
    profiles = (left_profile, right_profile) if left_profile is not None else (title_profile(left), title_profile(right))
    return (
        F.when(left == right, longer > 0)
        .when(F.abs(F.length(left) - F.length(right)) > most_edits, F.lit(False))
        .when((longer > _LONG) & (_fewest_edits_doubled(*profiles) > 2 * most_edits), F.lit(False))
        .otherwise(F.call_function("levenshtein", left, right, most_edits) >= 0)
    )
