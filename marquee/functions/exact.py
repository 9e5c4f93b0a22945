"""Fixed-point sums and means for decimal money columns stored as DOUBLE.

A DOUBLE sum depends on the order rows arrive in, which differs between runs,
partitionings and engines. Summing the value scaled to an integer (cents) is
exact and order-free, so every retry, every executor layout and the SQL
oracle agree bit for bit, and comparisons with a group mean are exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.util import as_col


def fixed_point(col: Column | str, scale: int = 2) -> Column:
    """The value as a whole number of ``10^-scale``, as BIGINT.

    The scale is checked: a value that is not exactly a decimal of that many
    places is an error, never rounded."""
    value = as_col(col).cast("double")
    places = value.cast(f"decimal(28,{scale})")
    units = (places * F.lit(10**scale).cast("decimal(10,0)")).cast("bigint")
    wrong = F.concat(F.lit(f"more than {scale} decimal places: "), value.cast("string"))
    return F.when(value.isNull() | (places.cast("double") == value), units).otherwise(F.raise_error(wrong).cast("bigint"))


def exact_sum(col: Column | str, scale: int = 2) -> Column:
    """Aggregate: exact sum of the scaled integers (BIGINT)."""
    return F.sum(fixed_point(col, scale))


def mean_from(total: Column | str, count: Column | str, scale: int = 2) -> Column:
    """DOUBLE mean from a fixed-point total and a row count (NULL if count is 0)."""
    return F.try_divide(as_col(total) / (10**scale), as_col(count))


def exact_mean(col: Column | str, scale: int = 2) -> Column:
    """Aggregate: mean of the non-NULL values, computed from an exact sum."""
    return mean_from(exact_sum(col, scale), F.count(as_col(col)), scale)
