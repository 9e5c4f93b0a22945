"""Delimited-list explosion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.lists import split_list


def explode_list(
    df: DataFrame,
    col: str,
    out: str,
    sep: str = ",",
    keep: Sequence[str] | None = None,
    outer: bool = False,
) -> DataFrame:
    """One row per element of the delimited list in ``col``, as column ``out``.

    A NULL list yields no row (``outer=True`` keeps it with a NULL element);
    an empty string yields one row with ``""``. ``keep`` selects the other
    columns carried along (default: all but ``out``).
    """
    keep = [c for c in df.columns if c != out] if keep is None else list(keep)
    gen = F.explode_outer if outer else F.explode
    return df.select(*[F.col(c) for c in keep], gen(split_list(col, sep)).alias(out))
