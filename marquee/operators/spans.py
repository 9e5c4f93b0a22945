"""Differences between two year / date columns, kept within a range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.temporal import days_between
from marquee.functions.util import as_col


def year_span(
    df: DataFrame,
    start: Column | str,
    end: Column | str,
    name: str,
    lo: int | None = None,
    hi: int | None = None,
    days: bool = False,
) -> DataFrame:
    """Add ``name = end - start`` (INT) and keep ``lo <= name < hi``.

    Integer year columns are subtracted; with ``days=True`` the columns are
    dates or timestamps and the span is in whole days. Rows where either side
    is NULL have a NULL span and are dropped whenever a bound is given.
    """
    span = days_between(start, end) if days else (as_col(end) - as_col(start)).cast("int")
    out = df.withColumn(name, span)
    if lo is not None:
        out = out.filter(F.col(name) >= lo)
    if hi is not None:
        out = out.filter(F.col(name) < hi)
    return out
