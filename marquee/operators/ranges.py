"""Deterministic ranges of a sort key, found when the query runs.

``with_range`` deals rows to consecutive ranges of a total order, about one per
shuffle partition and of about equal size. The bounds are quantiles of a sample:
the rows whose sort keys have the smallest hashes. The same rows are sampled
wherever and however often the bounds are computed, so every use of a range in
one query agrees, and so does a task that runs again.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sampled rows per range: a range then holds its share of rows within a few tenths.
SAMPLED = 16


@dataclass(frozen=True)
class SortKey:
    """A column of a sort order."""

    name: str
    descending: bool = False
    nulls_first: bool = True

    def column(self) -> Column:
        c = F.col(f"`{self.name}`")
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()


def sort_keys(order: Sequence[Column | str], columns: Sequence[str]) -> list[SortKey]:
    """Names, or columns by name with a direction, as sort keys (ascending with
    NULLs first unless said)."""
    found = []
    for item in order:
        text = item if isinstance(item, str) else re.fullmatch(r"Column<'(.*)'>", str(item), re.S).group(1)
        way = None if isinstance(item, str) else re.fullmatch(r"(.*) (ASC|DESC) NULLS (FIRST|LAST)", text, re.S)
        name = (way.group(1) if way else text).strip("`")
        if name not in columns:
            raise ValueError(f"order by a column of the frame, not by {text!r}: add it as a column first")
        found.append(SortKey(name, way is not None and way.group(2) == "DESC", way is None or way.group(3) == "FIRST"))
    return found


def _fields(keys: Sequence[SortKey]) -> list[str]:
    return [f"k{i}" for i in range(len(keys))]


def _before(keys: Sequence[SortKey], a: Column, b: Column, equal: bool) -> Column:
    """Whether struct ``a`` stands before struct ``b`` (or is equal to it, with ``equal``)."""
    result = F.lit(equal)
    for key, field in reversed(list(zip(keys, _fields(keys), strict=True))):
        x, y = a.getField(field), b.getField(field)
        less = F.coalesce(x > y if key.descending else x < y, F.lit(False))
        null = x.isNull() & y.isNotNull() if key.nulls_first else x.isNotNull() & y.isNull()
        result = less | null | (x.eqNullSafe(y) & result)
    return result


def _struct(keys: Sequence[SortKey]) -> Column:
    return F.struct(*[F.col(f"`{k.name}`").alias(f) for k, f in zip(keys, _fields(keys), strict=True)])


def bounds(df: DataFrame, keys: Sequence[SortKey], ranges: int) -> Column:
    """At most ``2 * ranges`` ascending bounds of the sort keys, as a scalar
    subquery: every n-th of ``SAMPLED * ranges`` sampled rows."""
    rows = df.select(_struct(keys).alias("k"))
    sample = rows.orderBy(F.xxhash64("k")).limit(SAMPLED * ranges)

    def compare(a: Column, b: Column) -> Column:
        return F.when(_before(keys, a, b, False), -1).when(_before(keys, b, a, False), 1).otherwise(0)

    ordered = sample.agg(F.array_sort(F.collect_list("k"), compare).alias("s"))
    step = F.greatest(F.lit(1), F.floor(F.size("s") / ranges).cast("int")).alias("n")
    every = F.filter(F.col("s"), lambda x, i: (i + 1) % F.col("n") == 0)
    return ordered.select("s", step).select(every.alias("bounds")).scalar()


def with_range(df: DataFrame, keys: Sequence[SortKey], name: str, ranges: int | None = None) -> DataFrame:
    """``df`` with ``name`` (INT): the range of each row, ascending in the order
    of ``keys``; by default one range per shuffle partition. Rows equal in all
    keys share a range."""
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [1 << b for b in reversed(range((2 * ranges).bit_length()))]
    start = F.struct(F.lit(0).alias("at"), F.col("__bounds").alias("b"), _struct(keys).alias("k"))

    def halve(state: Column, step: Column) -> Column:
        probe = F.get(state.getField("b"), state.getField("at") + step - 1)  # NULL past the end
        ahead = probe.isNotNull() & _before(keys, probe, state.getField("k"), True)
        at = F.when(ahead, state.getField("at") + step).otherwise(state.getField("at"))
        return F.struct(at.alias("at"), state.getField("b").alias("b"), state.getField("k").alias("k"))

    found = F.aggregate(F.array(*map(F.lit, steps)), start, halve, lambda s: s.getField("at"))
    return df.withColumn("__bounds", bounds(df, keys, ranges)).withColumn(name, F.coalesce(found, F.lit(0))).drop("__bounds")
