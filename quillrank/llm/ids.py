"""Row ids on their way through pandas, which would turn 64-bit ids with nulls into floats."""

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_ID = -(1 << 63)


def id_or_mark(name: str) -> Column:
    """The id, or the least 64-bit number for null."""
    return F.coalesce(F.col(name).cast("bigint"), F.lit(NO_ID)).alias(name)


def id_or_null(name: str) -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name)).alias(name)
