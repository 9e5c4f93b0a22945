"""Year arithmetic written so predicates reach the Parquet scan.

``year(ts) >= 2000`` is opaque to pushdown; ``ts >= DATE '2000-01-01'`` is
pushed as a Parquet row-group filter. The helpers below produce the latter.
A DATE literal is coerced to the column's type (DATE, TIMESTAMP_NTZ, or
TIMESTAMP at the session time zone's midnight), so one helper serves all three.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.util import as_col


def year_start(year: int) -> Column:
    """1 January ``year`` as a DATE literal."""
    return F.lit(dt.date(int(year), 1, 1))


def year_of(col: Column | str) -> Column:
    return F.year(as_col(col))


def in_year(col: Column | str, year: int) -> Column:
    c = as_col(col)
    return (c >= year_start(year)) & (c < year_start(year + 1))


def year_at_least(col: Column | str, year: int) -> Column:
    return as_col(col) >= year_start(year)


def year_below(col: Column | str, year: int) -> Column:
    return as_col(col) < year_start(year)


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from ``start`` to ``end`` (INT)."""
    return F.datediff(as_col(end), as_col(start))
