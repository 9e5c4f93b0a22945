"""Lookup joins and existence checks.

No join here hints a broadcast: Spark's own size estimates and AQE choose the
strategy, and AQE splits a partition that holds a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_names(
    df: DataFrame,
    names: DataFrame,
    left_on: str,
    right_on: str,
    how: str = "inner",
    columns: Sequence[str] = (),
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Attach name columns from a lookup table by a single equi-key.

    Only ``right_on`` and ``columns`` are read from ``names`` (pruned at the
    scan). ``rename`` renames the attached columns.
    """
    rename = rename or {}
    right = names.select(
        F.col(right_on).alias("__name_key"),
        *[F.col(c).alias(rename.get(c, c)) for c in columns],
    )
    out = df.join(right, df[left_on] == right["__name_key"], how)
    return out.drop("__name_key")


def exists_in(
    df: DataFrame, other: DataFrame, left_on: str, right_on: str | None = None, dedupe: bool = False
) -> DataFrame:
    """Rows of ``df`` whose key appears in ``other`` (a semi join).

    Unlike an inner join it never multiplies rows and adds no columns.
    ``dedupe=True`` first collapses ``other``'s keys (map-side), for a right
    side that repeats keys: a hot key then reaches the join once per task
    instead of once per row. Leave it off when the keys are already unique.
    """
    right_on = right_on or left_on
    keys = other.select(F.col(right_on).alias("__exists_key"))
    if dedupe:
        keys = keys.distinct()
    return df.join(keys, df[left_on] == keys["__exists_key"], "left_semi")
