"""Joins on keys of which a few hold very many rows.

``hot_key_join`` counts the left side's keys (combined map-side), splits every
key with more than ``rows_per_part`` rows into parts of about that size, and
copies the matching right rows to each part. It does not depend on adaptive
execution, and ordinary keys are joined as always.

The split keys are broadcast: at most ``most_keys`` of them, the heaviest, so
any key left whole holds at most 1 / ``most_keys`` of the rows. A row's part
follows from its own values, so a task that runs again deals it out alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heavy_keys(df: DataFrame, key: str, rows_per_part: int, most_keys: int) -> DataFrame:
    """(``__hot``, ``__parts``): the heaviest keys with more than
    ``rows_per_part`` rows and into how many parts each is split."""
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__hot")).agg(F.count(F.lit(1)).alias("__n"))
    heavy = counts.where(F.col("__n") > rows_per_part).orderBy(F.col("__n").desc(), "__hot").limit(most_keys)
    return heavy.select("__hot", F.ceil(F.col("__n") / rows_per_part).cast("int").alias("__parts"))


def hot_key_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    how: str = "inner",
    columns: Sequence[str] = (),
    rename: dict[str, str] | None = None,
    spread_by: Sequence[str] | None = None,
    rows_per_part: int = 1_000_000,
    most_keys: int = 1024,
) -> DataFrame:
    """``left`` with ``columns`` of ``right``, ``inner`` or ``left``: the rows of
    the plain join, dealt so that a hot key of ``left`` spans many tasks.

    ``spread_by`` names the left columns whose hash picks a row's part (default:
    all). Rows equal in them share a part, so name or keep a column that tells a
    hot key's rows apart. NULL keys match nothing; a left join spreads them over
    all shuffle partitions.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"hot_key_join is inner or left, not {how!r}")
    rename = rename or {}
    spread = list(spread_by) if spread_by is not None else left.columns
    heavy = F.broadcast(heavy_keys(left, left_on, rows_per_part, most_keys))
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = F.when(F.col(left_on).isNull(), F.lit(partitions)).otherwise(F.coalesce(F.col("__parts"), F.lit(1)))
    part = F.coalesce(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread]), parts).cast("int"), F.lit(0))
    dealt = left.join(heavy, F.col(left_on) == F.col("__hot"), "left").withColumn("__part", part).drop("__hot", "__parts")
    looked = right.select(F.col(right_on).alias("__key"), *[F.col(c).alias(rename.get(c, c)) for c in columns])
    each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__parts"), F.lit(1)) - 1)).alias("__copy")
    copies = looked.join(heavy, F.col("__key") == F.col("__hot"), "left").select(*looked.columns, each)
    out = dealt.join(copies, (F.col(left_on) == F.col("__key")) & (F.col("__part") == F.col("__copy")), how)
    return out.drop("__part", "__key", "__copy")
