"""Table preview: the first rows in a stated order.

``orderBy(...).limit(n)`` is planned as ``TakeOrderedAndProject``: each task
keeps its own top ``n`` and only those reach the final merge, so no full sort
and no full shuffle happen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from marquee.functions.util import as_cols


def preview(df: DataFrame, n: int = 5, order: Sequence[Column | str] | None = None) -> DataFrame:
    """The first ``n`` rows; ordered by ``order`` (default: all columns)."""
    return df.orderBy(*(as_cols(order) if order else df.columns)).limit(n)
