"""Grouped counts, means and maxima, plus whole-table counts.

All are hash aggregates, so Spark combines map-side before the shuffle and a
hot key costs one partial row per task, not its full row count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.util import as_col
from marquee.operators.explode import explode_list


def count_by(
    df: DataFrame,
    keys: Sequence[str],
    name: str = "count",
    distinct: Sequence[str] | str | None = None,
    nonnull: str | None = None,
) -> DataFrame:
    """Rows per group; ``distinct`` counts distinct values, ``nonnull`` counts non-NULL values."""
    if distinct is not None:
        cols = [distinct] if isinstance(distinct, str) else list(distinct)
        agg = F.count_distinct(*[F.col(c) for c in cols])
    elif nonnull is not None:
        agg = F.count(F.col(nonnull))
    else:
        agg = F.count(F.lit(1))
    return df.groupBy(*keys).agg(agg.alias(name))


def count_through(
    fact: DataFrame,
    fact_key: str,
    dim: DataFrame,
    dim_key: str,
    group_keys: Sequence[str],
    name: str = "count",
    fact_group: Sequence[str] = (),
    explode: tuple[str, str, str] | None = None,
) -> DataFrame:
    """``count(*)`` of ``fact JOIN dim`` per ``group_keys``, pre-aggregated.

    The fact side is first reduced to one row per (join key, ``fact_group``)
    with its row count, the join then runs on that, and the counts are summed
    per group. Same result as counting the joined rows, but the large side is
    collapsed map-side before any shuffle, and a hot join key is one row.

    ``explode=(list_column, out, sep)`` counts per element of a delimited list
    on the ``dim`` side (e.g. per genre). The list is exploded after the join,
    so the join ships one row per ``dim`` key rather than one per element.
    """
    pre = fact.groupBy(F.col(fact_key).alias("__fk"), *[F.col(c) for c in fact_group]).agg(
        F.count(F.lit(1)).alias("__n")
    )
    joined = pre.join(dim, pre["__fk"] == dim[dim_key])
    if explode is not None:
        col, out, sep = explode
        joined = explode_list(joined, col, out, sep=sep)
    return joined.groupBy(*group_keys).agg(F.sum("__n").alias(name))


def mean_by(
    df: DataFrame,
    keys: Sequence[str],
    means: Mapping[str, Column | str],
    count_name: str | None = None,
    having: Column | None = None,
) -> DataFrame:
    """Several aggregates in one pass: ``{out: value}`` means per group.

    A value given as a string is averaged with ``avg``; a Column is used as
    the aggregate itself (e.g. ``exact_mean(...)``). ``having`` filters groups.
    """
    aggs = [
        (F.avg(F.col(v)) if isinstance(v, str) else v).alias(out)
        for out, v in means.items()
    ]
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    out = df.groupBy(*keys).agg(*aggs)
    return out.filter(having) if having is not None else out


def max_by_group(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """Maximum of ``col`` per group (a grouped aggregate, not a window + distinct)."""
    return df.groupBy(*keys).agg(F.max(as_col(col)).alias(name))


def table_counts(
    tables: Mapping[str, DataFrame],
    name_col: str = "table_name",
    count_col: str = "row_count",
) -> DataFrame:
    """One row (table name, row count) per table, as a single DataFrame.

    Each count scans no columns, so Parquet answers from row-group metadata.
    """
    parts = [
        df.groupBy().agg(F.count(F.lit(1)).alias(count_col)).select(
            F.lit(name).alias(name_col), F.col(count_col)
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """The row count as a one-row DataFrame (a lazy ``df.count()``)."""
    return df.groupBy().agg(F.count(F.lit(1)).alias(name))
