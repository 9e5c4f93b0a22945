"""Group-relative selection and ordered group lists.

``above_group_mean`` replaces ``avg(...) OVER (PARTITION BY key)`` + filter:
the window puts every row of a group in one task. Here the rows are dealt once,
by (group, part), where a row's part follows from a hash of its values; partial
sums per (group, part) are taken from the dealt rows, merged per group, and
joined back to the same parts. The input is computed and shuffled once (Spark
reuses the exchange), and a group that holds a third of the rows spans all
partitions.

``group_list`` gives a group's values in order as one row per value, so its
shape never depends on how large a group is and no list is built in a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.exact import fixed_point, mean_from
from marquee.functions.util import as_cols
from marquee.operators.ranking import number_rows


def above_group_mean(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    mean_name: str | None = None,
    exact_scale: int | None = None,
) -> DataFrame:
    """Rows whose ``value`` is strictly above the mean of ``value`` in their group.

    Groups are matched NULL-safely (a NULL key is a group, as in a window).
    With ``exact_scale`` the test is the exact integer comparison
    ``fixed(value) * count > fixed_sum`` and the mean is computed from the
    exact sum (a value with more decimals is an error, see
    ``functions.exact``); otherwise ``value > avg(value)``.
    """
    if not keys:
        raise ValueError("above_group_mean needs at least one group key")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.coalesce(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(parts)), F.lit(0))  # never NULL
    group = F.struct(*[F.col(f"`{k}`") for k in keys])  # equal with the same NULLs
    # the part is an expression of all columns, so both uses below read one and the same exchange
    dealt = df.repartition(group, part).withColumn("__group", group).withColumn("__part", part)
    if exact_scale is None:
        v = F.col(f"`{value}`").cast("double")
        sums = [F.sum(v).alias("__sum"), F.count(v).alias("__cnt")]
    else:
        v = fixed_point(value, exact_scale)
        sums = [F.sum(v).alias("__sum"), F.count(F.col(f"`{value}`")).alias("__cnt")]
    partial = dealt.groupBy("__group", "__part").agg(*sums)
    merged = Window.partitionBy("__group")  # over one row per part
    told = partial.select("__group", "__part", F.sum("__sum").over(merged).alias("__total"), F.sum("__cnt").over(merged).alias("__n"))
    joined = dealt.join(told, ["__group", "__part"])

    if exact_scale is None:
        mean = F.col("__total") / F.when(F.col("__n") > 0, F.col("__n"))
        keep = F.col(f"`{value}`") > mean
    else:
        scaled = v.cast("decimal(38,0)")
        keep = scaled * F.col("__n") > F.col("__total").cast("decimal(38,0)")
        mean = mean_from("__total", "__n", exact_scale)
    extra = [mean.alias(mean_name)] if mean_name else []
    return joined.filter(keep).select(*[F.col(f"`{c}`") for c in df.columns], *extra)


def group_list(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    order: Sequence[Column | str] | None = None,
    position: str = "position",
) -> DataFrame:
    """``keys, position, out``: each group's values numbered 1, 2, ... in order.

    ``order`` defaults to the value itself; give a unique last key for a
    deterministic order among equal values. NULL values come last.
    """
    last = [F.col(value).isNull().alias("__null"), *[c for c in df.columns]]
    by = ["__null", *as_cols(list(order) if order else [value])]
    numbered = number_rows(df.select(*last), by, keys=keys, name=position)
    return numbered.select(*keys, position, F.col(value).alias(out))
