"""Query ID -> star-schema binding, and query ID -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.plans import star, tables
from marquee.plans.oracle import ORACLE_SQL

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {
    "A1": star.a1_word_pairs,
    "A2": star.a2_standard_parts_shipped_from,
    "A3": star.a3_customers_with_mean_price_from,
    "A4": star.a4_max_linenumber_per_nation,
    "A5": star.a5_finished_orders_priced_from,
    "A6": star.a6_discount_equals_tax,
    "A7": star.a7_mean_size_per_type,
    "I1": star.i1_orders_per_customer_name,
    "I2": star.i2_fast_shipments,
    "I3": star.i3_busy_parts,
    "I4": star.i4_old_urgent_orders,
    "I5": star.i5_top_order_per_customer,
    "I6": star.i6_top_widgets_above_size_mean,
    "I7": star.i7_orders_above_year_mean,
    "M1": star.m1_single_line_documents,
    "M1_unlabelled": star.m1_unlabelled_documents,
    "M2": star.m2_one_part_per_supplier,
    "M3": star.m3_shipped_after_days,
    "M4": star.m4_part_names_per_brand,
    "M5": star.m5_documents_per_language,
    "M6": star.m6_numbered_big_orders,
    "S1": star.s1_distinct_parts_per_customer,
    "S2": star.s2_lines_per_year_and_word,
    "S3": star.s3_customers_per_nation,
    "S4": star.s4_customer_line_stats,
    "S5": star.s5_top_parts_per_word,
    "S6": star.s6_first_part_per_word_with_suppliers,
    "ST1": star.st1_table_counts,
    "ST2": star.st2_orders_per_year,
    "ST3": star.st3_lines_per_ship_year,
    "ST4": star.st4_standard_part_count,
    "ST5": star.st5_standard_parts_per_word,
    "ST6": star.st6_standard_lines_per_quantity_bin,
    "L1_bucketed": tables.l1_bucketed_order_lines,
    "T1_text": tables.t1_orders_from_text,
    "X1_published": tables.x1_published_nations,
    **{f"P1_{t}": star.p1_preview(t) for t in star.PREVIEW_ORDER},
}

FLAGSHIP = "S5"


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE_SQL.items() if k in QUERIES}
