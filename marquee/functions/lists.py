"""Delimited-list string columns (``"Drama,Comedy"``, ``"nm1,nm2"``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.util import as_col


def literal_pattern(sep: str) -> str:
    """A Java regex that matches ``sep`` literally (``split`` takes a regex)."""
    return "\\Q" + sep + "\\E"


def split_list(col: Column | str, sep: str = ",") -> Column:
    """``"a,b"`` -> ``["a", "b"]``; NULL stays NULL; ``""`` -> ``[""]``."""
    return F.split(as_col(col), literal_pattern(sep))


def list_size(col: Column | str, sep: str = ",") -> Column:
    """Number of list elements; NULL for a NULL list."""
    return F.size(split_list(col, sep))


def single_valued(col: Column | str, sep: str = ",") -> Column:
    """Non-NULL and at most one element.

    Same rows as ``size(split(c, sep)) <= 1`` on non-NULL input, but a plain
    substring test: no array is built per row.
    """
    c = as_col(col)
    return c.isNotNull() & ~c.contains(sep)
