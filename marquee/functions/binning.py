"""Range binning generated from edges instead of a hand-written ``when`` chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.util import as_col


def _fmt(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def bin_label(
    col: Column | str,
    edges: Sequence[float],
    labels: Sequence[str] | None = None,
    close_last: bool = True,
) -> Column:
    """Label of the bin ``[edges[i], edges[i+1])`` holding the value.

    The last bin is closed on both ends when ``close_last``. Values outside
    every bin (and NULL) get a NULL label.
    """
    if len(edges) < 2:
        raise ValueError("need at least two edges")
    if labels is None:
        labels = [f"{_fmt(lo)}-{_fmt(hi)}" for lo, hi in zip(edges, edges[1:])]
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per bin")
    c = as_col(col)
    expr = None
    last = len(edges) - 2
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        upper = (c <= hi) if (close_last and i == last) else (c < hi)
        cond = (c >= lo) & upper
        expr = F.when(cond, labels[i]) if expr is None else expr.when(cond, labels[i])
    return expr
