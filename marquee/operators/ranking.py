"""Top-N per group and distributed row numbering.

``top_n_per_group`` is ``row_number() <= n`` over a window; Spark plans it with
a partial ``WindowGroupLimit`` before the shuffle, so each task forwards at
most ``n`` rows per group and a hot group costs ``n`` rows per task.

``number_rows`` numbers rows 1..N in a total order, globally or per group,
without sending a group (or everything) to one task. A window
``row_number() OVER (ORDER BY ...)`` with no or a constant partition key runs
in a single task; instead:

1. range bounds are quantiles of a sample of the sort keys (``operators.ranges``):
   a scalar subquery that is computed when the query runs and is the same
   whenever it is computed, since rows are sampled by a hash of their keys;
2. every row finds its range by binary search among the bounds, so a retried
   task cannot move a row, and a hot group spans many ranges;
3. exact counts per (group, range) and a running sum over the group's earlier
   ranges give each range's offset (at most groups + ranges rows);
4. a window over (group, range) ranks the rows of one range, and the offset is
   added.

No job runs while the plan is built, and nothing is stored. Sample, counts and
rows start from one exchange that Spark reuses, so the input is computed once;
should it be computed again, bounds and rows come out the same.

With ``limit=N`` only numbers 1..N are wanted: a partial top-N per group, or
``orderBy().limit(N)`` globally, replaces the full sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.util import as_cols
from marquee.operators.ranges import sort_keys, with_range

_GROUP, _RANGE, _CNT, _OFF, _POS = "__group", "__range", "__cnt", "__offset", "__pos"


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    n: int,
    rank_name: str | None = None,
) -> DataFrame:
    """The first ``n`` rows of each group under ``order``.

    Give ``order`` a unique last key: ties are otherwise broken arbitrarily.
    """
    w = Window.partitionBy(*keys).orderBy(*as_cols(order))
    ranked = df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= n)
    if rank_name:
        return ranked.withColumnRenamed("__rank", rank_name)
    return ranked.drop("__rank")


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per group: the first under ``order`` (deterministic dedupe)."""
    return top_n_per_group(df, keys, order, 1)


def number_rows(
    df: DataFrame,
    order: Sequence[Column | str],
    keys: Sequence[str] = (),
    name: str = "row_number",
    limit: int | None = None,
) -> DataFrame:
    """Append ``name`` (BIGINT): 1, 2, ... in ``order`` within each ``keys`` group.

    Same values as ``row_number() OVER (PARTITION BY keys ORDER BY order)``
    when ``order`` is total; computed without a single-task window. ``order``
    holds column names, or columns by name with ``.asc()``, ``.desc()`` and their
    NULL variants.

    ``limit=N`` keeps only numbers 1..N (a top-N report): per group this is a
    partial top-N; globally ``orderBy().limit(N)`` keeps N rows per task and
    only those N rows are numbered together.
    """
    keys = list(keys)
    if limit is not None:
        if keys:
            ranked = top_n_per_group(df, keys, order, limit, rank_name="__rank")
            return ranked.withColumn(name, F.col("__rank").cast("bigint")).drop("__rank")
        top = df.orderBy(*as_cols(order)).limit(limit)
        return top.withColumn(name, F.row_number().over(Window.orderBy(*as_cols(order))).cast("bigint"))
    spec = sort_keys(order, df.columns)
    # dealt by a hash of all columns: the three uses below read one and the same exchange
    df = df.repartition(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    ranged = with_range(df, [*sort_keys(keys, df.columns), *spec], _RANGE)
    # a struct of the keys is never NULL and equals another with the same NULLs
    group = F.struct(*[F.col(f"`{k}`") for k in keys]) if keys else F.lit(0)
    ranged = ranged.withColumn(_GROUP, group)

    spans = ranged.groupBy(_GROUP, _RANGE).agg(F.count(F.lit(1)).alias(_CNT))
    earlier = (Window.partitionBy(_GROUP) if keys else Window).orderBy(_RANGE).rowsBetween(
        Window.unboundedPreceding, -1
    )
    spans = spans.select(_GROUP, _RANGE, F.coalesce(F.sum(_CNT).over(earlier), F.lit(0)).alias(_OFF))
    if not keys:
        spans = F.broadcast(spans)  # one row per range: bounded by the number of ranges
    within = Window.partitionBy(_GROUP, _RANGE).orderBy(*[k.column() for k in spec])
    ranked = ranged.withColumn(_POS, F.row_number().over(within))
    joined = ranked.join(spans, [_GROUP, _RANGE])
    number = (F.col(_OFF) + F.col(_POS)).cast("bigint")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], number.alias(name))
