"""Late lookup: a few keys found at run time filter a large table's scan.

``key_filter`` turns a frame of keys into a bitmap of fixed size (one bit per
key, hashed), computed as a scalar subquery when the query runs; whatever the
number of keys, its size is the bound. ``late_lookup`` drops the rows of the
large table whose key's bit is not set before anything is shuffled, and then
joins exactly. Many keys only make the filter weak, never the result wrong.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 16
_WORD = 32


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_filter(keys: DataFrame, column: str, bits: int = BITS) -> Column:
    """A bitmap of ``column``'s values, as ``bits / 32`` words, for ``may_hold``."""
    place = keys.where(F.col(column).isNotNull()).select(_place(F.col(column).cast("string"), bits).alias("__place"))
    word = F.floor(F.col("__place") / _WORD).cast("int")
    bit = F.expr(f"shiftleft(1L, cast(__place % {_WORD} AS INT))")
    words = place.groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__bits"))  # bits / 32 rows at most
    every = keys.sparkSession.range(0, bits // _WORD, 1, 1).select(F.col("id").cast("int").alias("__at"))
    dense = every.join(F.broadcast(words), F.col("__at") == F.col("__word"), "left")
    dense = dense.select("__at", F.coalesce("__bits", F.lit(0).cast("long")).alias("__bits"))
    ordered = F.array_sort(F.collect_list(F.struct("__at", "__bits")))
    return dense.agg(ordered.alias("__held")).select(F.col("__held.__bits").alias("__bitmap")).scalar()


def may_hold(bitmap: Column, key: Column, bits: int = BITS) -> Column:
    """Whether ``key`` may be among the keys of the bitmap (never false for one that is)."""
    place = _place(key.cast("string"), bits)
    word = F.get(bitmap, F.floor(place / _WORD).cast("int"))
    return F.getbit(word, (place % _WORD).cast("int")) == 1


def late_lookup(
    keys: DataFrame,
    table: DataFrame,
    left_on: str,
    right_on: str,
    how: str = "inner",
    columns: Sequence[str] = (),
    bits: int = BITS,
) -> DataFrame:
    """``keys`` with ``columns`` of ``table``: a plain equi-join whose right side
    is filtered by the keys before its shuffle. For a few keys of a large table;
    ``keys`` is computed once more for the bitmap."""
    bitmap = key_filter(keys.select(left_on), left_on, bits)
    near = table.where(may_hold(bitmap, F.col(right_on), bits))
    right = near.select(F.col(right_on).alias("__late_key"), *columns)
    return keys.join(right, keys[left_on] == right["__late_key"], how).drop("__late_key")
