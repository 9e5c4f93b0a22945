"""Row predicates used by the questions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.util import as_col


def contains_any(col: Column | str, *needles: str) -> Column:
    """Case-sensitive substring test against any of ``needles``."""
    c = as_col(col)
    return reduce(lambda a, b: a | b, [c.contains(n) for n in needles])


def float_literal(value: float) -> Column:
    """``value`` as a FLOAT literal.

    FLOAT columns compared with a DOUBLE literal are widened first, and many
    tenths widen to just below themselves (8.1f < 8.1). Comparing in FLOAT
    makes ``rating >= 8.1`` keep ratings stored as 8.1.
    """
    return F.lit(value).cast("float")
