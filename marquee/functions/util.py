from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def as_cols(cs: Iterable[Column | str] | Column | str | None) -> list[Column]:
    if cs is None:
        return []
    if isinstance(cs, (str, Column)):
        return [as_col(cs)]
    return [as_col(c) for c in cs]
