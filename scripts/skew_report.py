"""Largest task share for the operators vs. their naive window forms, on a hot key.

    python scripts/skew_report.py [rows]

Generates ``rows`` rows where one key holds a third of them (operator input,
not query data), runs each operator and its naive counterpart with AQE
coalescing off and 16 shuffle partitions, and reports the largest share of
rows any one output partition (one task) held. Prints a Markdown table.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from marquee.operators import above_group_mean, number_rows  # noqa: E402
from marquee.session import build_session  # noqa: E402


def largest_share(df, total: int, keep: str | None = None) -> float:
    """Largest share of ``total`` rows in one output partition. ``keep`` names a
    computed column the measurement must use, or Catalyst prunes its operator."""
    if keep:
        df = df.filter(F.col(keep) > -1)  # a test the optimizer cannot fold away
    sizes = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] / total


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    spark = build_session(
        master="local[8]", shuffle_partitions=16,
        extra={"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"},
    )
    data = spark.range(rows).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string")).alias("g"),
        ((F.col("id") * 7919) % 100003).alias("v"),
        (((F.col("id") * 104729) % 1000000) / 100.0).alias("price"),
    ).persist()
    data.count()
    by_order = [F.col("v"), F.col("id")]
    out = []

    naive = data.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*by_order)))
    ours = number_rows(data, by_order, keys=["g"], name="rn")
    out.append(("number rows per group", largest_share(naive, rows, "rn"), largest_share(ours, rows, "rn")))

    naive = data.withColumn("m", F.avg("price").over(Window.partitionBy("g"))).filter(F.col("price") > F.col("m"))
    ours = above_group_mean(data, ["g"], "price", exact_scale=2)
    total_above = ours.count()
    out.append(("rows above the group mean", largest_share(naive, total_above), largest_share(ours, total_above)))

    print(f"rows: {rows:,}; one key holds {rows // 3:,} ({1 / 3:.0%})\n")
    print("| operator | naive window / collect | marquee |")
    print("|---|---|---|")
    for name, a, b in out:
        print(f"| {name} | {a:.1%} | {b:.1%} |")
    spark.stop()


if __name__ == "__main__":
    main()
