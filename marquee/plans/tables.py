"""Queries that go through tables of their own: bucketed copies, text dumps and
published CSV of the star-schema tables.

Each writes under the shared folder while its plan is built (that is what it
shows), reads back what it wrote, and answers a question from it, so the answer
checks the writer and the reader.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.functions import exact_mean
from marquee.plans import star
from marquee.session import shared_folder
from marquee.sources import export_csv, read_published, read_tsv, write_bucketed
from marquee.sources.star import StarTables


def l1_bucketed_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items and mean quantity per order status, joined bucket by bucket:
    both tables are laid out by order key, and the join shuffles nothing."""
    t, root = StarTables(spark, sf_dir), shared_folder(spark, "bucketed")
    tables = {"orders": t.orders.select("o_orderkey", "o_orderstatus"), "lineitem": t.lineitem.select("l_orderkey", "l_quantity")}
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = write_bucketed(tables, {"orders": "o_orderkey", "lineitem": "l_orderkey"}, root, buckets)
    joined = laid["lineitem"].join(laid["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    stats = joined.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("line_count"), exact_mean("l_quantity").alias("avg_quantity"))
    return stats.orderBy("o_orderstatus")


def t1_orders_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and mean price per status, from a tab-separated dump with ``\\N`` for
    NULL that is read with its declared schema."""
    orders = StarTables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = os.path.join(shared_folder(spark, "dump"), "orders.tsv")
    orders.write.option("header", "true").option("sep", "\t").option("nullValue", "\\N").option("quote", "").csv(path)
    read = read_tsv(spark, path, StructType(orders.schema.fields))
    stats = read.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("order_count"), exact_mean("o_totalprice").alias("avg_totalprice"))
    return stats.orderBy("o_orderstatus")


def x1_published_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per nation as published CSV, read back through the manifest,
    with the row count its writer saw."""
    results = {"customers_per_nation": star.s3_customers_per_nation(spark, sf_dir), "orders_per_year": star.st2_orders_per_year(spark, sf_dir)}
    out = shared_folder(spark, "published")
    paths = export_csv(results, out)
    back = read_published(spark, out, "customers_per_nation", "n_name string, customer_count long")
    return back.withColumn("result_rows", F.lit(paths["customers_per_nation"].rows).cast("long"))
