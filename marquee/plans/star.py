"""The questions bound to the star-schema test tables.

The title catalog itself is not available as test data, so each question's
operator shape is bound to the star-schema tables (mapping in SURVEY §7.3):
titles -> parts or orders, genres -> the words of ``p_name``, people ->
customers or suppliers, localized titles -> line items, ratings -> prices.
The bindings use the operators of ``plans.movies``; A4, M2, S2 and S4 add a
pre-aggregation that the star schema's keys allow. Each has a DuckDB oracle in
``plans.oracle``.

Conventions that keep results exact and comparable:
* money means are fixed-point (``functions.exact``): order-free and exact;
* every numbering or first-per-group has a unique last sort key;
* lists are one row per value, in a stated order;
* year filters are written as timestamp ranges so they reach the scan.

Every function takes ``(spark, sf_dir)`` plus parameters with the original questions'
defaults mapped to this data, and returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import (
    bin_label,
    contains_any,
    exact_mean,
    fixed_point,
    mean_from,
    single_valued,
    year_at_least,
    year_below,
    year_of,
    in_year,
)
from marquee.operators import (
    above_group_mean,
    count_by,
    count_through,
    exists_in,
    explode_list,
    first_per_group,
    group_list,
    hot_key_join,
    late_lookup,
    max_by_group,
    mean_by,
    number_rows,
    preview,
    row_count,
    table_counts,
    top_n_per_group,
    with_names,
    year_span,
)
from marquee.sources.star import STAR_TABLES, StarTables

# Bindings of the original questions' literals to this data.
RETURN_FLAG = "R"  # localized-title region "DE"
LINE_STATUS = "O"  # localized-title language "de"
MOVIE_TYPE = "STANDARD"  # titleType "movie"
SEGMENT_WORDS = ("AUTO", "MACH")  # profession "actor" / "actress"
PRIORITIES = ("1-URGENT", "2-HIGH")  # category "actor" / "actress"


def _words(parts: DataFrame, keep: list[str]) -> DataFrame:
    """One row per word of ``p_name`` (the exploded genres)."""
    return explode_list(parts, "p_name", "word", sep=" ", keep=keep)


def _nation(t: StarTables) -> DataFrame:
    # The nation table has 25 rows at every scale factor: a proven bound.
    return F.broadcast(t.nation.select("n_nationkey", "n_name"))


# --------------------------------------------------------------------- A*


def a1_word_pairs(spark: SparkSession, sf_dir: str, flag: str = RETURN_FLAG) -> DataFrame:
    """(flagged line item x word of its part) pairs per word."""
    t = StarTables(spark, sf_dir)
    lines = t.lineitem.filter(F.col("l_returnflag") == flag).select("l_partkey")
    parts = t.part.select("p_partkey", "p_name")
    return count_through(lines, "l_partkey", parts, "p_partkey", ["word"], name="count", explode=("p_name", "word", " "))


def a2_standard_parts_shipped_from(
    spark: SparkSession, sf_dir: str, border_year: int = 2000, flag: str = RETURN_FLAG, status: str = LINE_STATUS
) -> DataFrame:
    """STANDARD parts with an R/O line item shipped in or after ``border_year``, by year."""
    t = StarTables(spark, sf_dir)
    parts = t.part.filter(F.col("p_type") == MOVIE_TYPE).select("p_partkey", "p_name")
    lines = t.lineitem.filter(
        (F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status) & year_at_least("l_shipdate", border_year)
    ).select("l_partkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", year_of("l_shipdate").alias("ship_year"))
    out = parts.join(lines, parts["p_partkey"] == lines["l_partkey"])
    # Ties on the (few-valued) year are broken by keys so the range sort stays balanced.
    return out.orderBy("ship_year", "p_partkey", "l_orderkey", "l_linenumber").select(
        "p_partkey", "l_orderkey", "l_linenumber", "p_name", "l_returnflag", "l_linestatus", "ship_year"
    )


def a3_customers_with_mean_price_from(
    spark: SparkSession, sf_dir: str, border_price: float = 300000.0, min_price: float = 1000.0
) -> DataFrame:
    """Customer names (namesakes merged) whose mean order price is >= ``border_price``."""
    t = StarTables(spark, sf_dir)
    orders = t.orders.filter(F.col("o_totalprice") >= min_price).select("o_custkey", "o_totalprice")
    named = with_names(orders, t.customer, "o_custkey", "c_custkey", columns=["c_name"])
    means = mean_by(
        named, ["c_name"], {"avg_totalprice": exact_mean("o_totalprice")},
        count_name="order_count", having=F.col("avg_totalprice") >= border_price,
    )
    return means.select("c_name", "avg_totalprice", "order_count").orderBy("avg_totalprice", "c_name")


def a4_max_linenumber_per_nation(spark: SparkSession, sf_dir: str, flag: str = RETURN_FLAG) -> DataFrame:
    """Largest line number per nation over flagged line items, descending.

    Max is decomposable, so it is taken per order, then per customer, then per
    nation: each join sees one row per key instead of every line item.
    """
    t = StarTables(spark, sf_dir)
    per_order = max_by_group(
        t.lineitem.filter(F.col("l_returnflag") == flag), ["l_orderkey"], "l_linenumber", "m"
    )
    per_customer = max_by_group(
        per_order.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")),
        ["o_custkey"], "m", "m",
    )
    per_nation = max_by_group(
        per_customer.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")),
        ["c_nationkey"], "m", "max_linenumber",
    )
    out = per_nation.join(_nation(t), F.col("c_nationkey") == F.col("n_nationkey"))
    return out.select("n_name", "max_linenumber").orderBy(F.col("max_linenumber").desc(), "n_name")


def a5_finished_orders_priced_from(
    spark: SparkSession, sf_dir: str, border_price: float = 450000.0, status: str = "F"
) -> DataFrame:
    """Finished orders priced at or above ``border_price``, ascending price."""
    t = StarTables(spark, sf_dir)
    orders = t.orders.filter((F.col("o_orderstatus") == status) & (F.col("o_totalprice") >= border_price))
    out = with_names(orders, t.customer, "o_custkey", "c_custkey", columns=["c_name", "c_mktsegment"])
    return out.orderBy("o_totalprice", "o_orderkey").select(
        "o_orderkey", "c_name", year_of("o_orderdate").alias("order_year"), "c_mktsegment", "o_totalprice"
    )


def a6_discount_equals_tax(spark: SparkSession, sf_dir: str, skip_flag: str = "N") -> DataFrame:
    """Line items whose discount equals their tax (column = column), with supplier and part."""
    t = StarTables(spark, sf_dir)
    lines = t.lineitem.filter(
        (F.col("l_returnflag") != skip_flag) & (F.col("l_discount") == F.col("l_tax"))
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax", "l_shipdate")
    lines = hot_key_join(lines, t.supplier, "l_suppkey", "s_suppkey", columns=["s_name"])
    lines = with_names(lines, t.part, "l_partkey", "p_partkey", columns=["p_name"])
    return lines.orderBy("l_shipdate", "l_orderkey", "l_linenumber").select(
        "l_orderkey", "l_linenumber", "p_name", year_of("l_shipdate").alias("ship_year"), "l_discount", "l_tax", "s_name"
    )


def a7_mean_size_per_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean non-NULL ``p_size`` per ``p_type``."""
    t = StarTables(spark, sf_dir)
    parts = t.part.filter(F.col("p_size").isNotNull())
    return mean_by(parts, ["p_type"], {"avg_size": "p_size"})


# --------------------------------------------------------------------- I*


def _segment_customers(t: StarTables) -> DataFrame:
    return t.customer.filter(contains_any("c_mktsegment", *SEGMENT_WORDS))


def i1_orders_per_customer_name(spark: SparkSession, sf_dir: str, priorities: tuple[str, ...] = PRIORITIES) -> DataFrame:
    """Urgent/high orders per customer name, for AUTO*/MACH* customers, descending."""
    t = StarTables(spark, sf_dir)
    per_key = count_by(
        t.orders.filter(F.col("o_orderpriority").isin(*priorities)), ["o_custkey"], name="n", nonnull="o_orderkey"
    )
    named = per_key.join(_segment_customers(t).select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    return named.groupBy("c_name").agg(F.sum("n").alias("order_count")).orderBy(
        F.col("order_count").desc(), "c_name"
    )


def i2_fast_shipments(spark: SparkSession, sf_dir: str, max_days: int = 18) -> DataFrame:
    """Line items shipped within ``[0, max_days)`` days of the order, for AUTO*/MACH* customers."""
    t = StarTables(spark, sf_dir)
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate").join(
        _segment_customers(t).select("c_custkey", "c_name", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")
    )
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    out = year_span(
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")),
        "o_orderdate", "l_shipdate", "days_to_ship", lo=0, hi=max_days, days=True,
    )
    return out.select("c_name", "o_orderkey", "l_linenumber", "days_to_ship", "c_mktsegment").orderBy(
        "days_to_ship", "o_orderkey", "l_linenumber"
    )


def i3_busy_parts(spark: SparkSession, sf_dir: str, min_lines: int = 15, status: str = "F") -> DataFrame:
    """Parts with more than ``min_lines`` line items of finished orders; part name by left join."""
    t = StarTables(spark, sf_dir)
    finished = t.orders.filter(F.col("o_orderstatus") == status)
    lines = exists_in(t.lineitem.select("l_orderkey", "l_partkey"), finished, "l_orderkey", "o_orderkey")
    busy = count_by(lines, ["l_partkey"], name="line_count").filter(F.col("line_count") > min_lines)
    out = with_names(busy, t.part, "l_partkey", "p_partkey", how="left", columns=["p_name"])
    return out.orderBy(F.col("line_count").desc(), "l_partkey").select("p_name", "line_count")


def i4_old_urgent_orders(
    spark: SparkSession, sf_dir: str, current_year: int = 2002, min_age: int = 6, word: str = "URGENT"
) -> DataFrame:
    """Orders more than ``min_age`` years before ``current_year`` with ``word`` in the priority."""
    t = StarTables(spark, sf_dir)
    # current_year - year > min_age  <=>  orderdate < 1 Jan (current_year - min_age): pushed to the scan.
    orders = t.orders.filter(
        F.col("o_orderdate").isNotNull()
        & year_below("o_orderdate", current_year - min_age)
        & F.col("o_orderpriority").contains(word)
    )
    return orders.select(
        "o_orderkey", (F.lit(current_year) - year_of("o_orderdate")).alias("years_ago"), "o_orderpriority"
    ).orderBy(F.col("years_ago").desc(), "o_orderkey")


def i5_top_order_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's most expensive order (ties: lowest order key), by customer name."""
    t = StarTables(spark, sf_dir)
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    top = first_per_group(orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])
    out = with_names(top, t.customer, "o_custkey", "c_custkey", columns=["c_name"])
    return out.select("c_name", "o_orderkey", "o_totalprice").orderBy("c_name", "o_orderkey")


def i6_top_widgets_above_size_mean(spark: SparkSession, sf_dir: str, word: str = "widget", n: int = 3) -> DataFrame:
    """Parts named with ``word``, priced above their size's mean, top ``n`` per size."""
    t = StarTables(spark, sf_dir)
    parts = t.part.filter(F.col("p_name").contains(word)).select("p_partkey", "p_name", "p_size", "p_retailprice")
    above = above_group_mean(parts, ["p_size"], "p_retailprice", exact_scale=2)
    top = top_n_per_group(above, ["p_size"], [F.col("p_retailprice").desc(), F.col("p_partkey").asc()], n)
    return top.orderBy(F.col("p_size").desc(), F.col("p_retailprice").desc(), "p_partkey")


def i7_orders_above_year_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders priced strictly above the mean price of their order year, descending price."""
    t = StarTables(spark, sf_dir)
    orders = t.orders.filter(F.col("o_orderdate").isNotNull() & F.col("o_totalprice").isNotNull()).select(
        "o_orderkey", year_of("o_orderdate").alias("order_year"), "o_totalprice"
    )
    above = above_group_mean(orders, ["order_year"], "o_totalprice", mean_name="avg_year_totalprice", exact_scale=2)
    return above.orderBy(F.col("o_totalprice").desc(), "o_orderkey")


# --------------------------------------------------------------------- M*


def m1_single_line_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose whole text is one line, with their labels (left join: NULL when unlabeled)."""
    t = StarTables(spark, sf_dir)
    docs = t.documents.filter(single_valued("text", "\n")).select("doc_id", "lang")
    labels = t.labels.select(F.col("doc_id").alias("label_doc_id"), "quality", "toxic")
    out = docs.join(labels, docs["doc_id"] == labels["label_doc_id"], "left")
    return out.select("doc_id", "lang", "quality", "toxic")


def m1_unlabelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that no label names, per language (``isNull`` after a left join)."""
    t = StarTables(spark, sf_dir)
    labels = t.labels.select(F.col("doc_id").alias("label_doc_id"))
    out = t.documents.select("doc_id", "lang").join(labels, F.col("doc_id") == F.col("label_doc_id"), "left")
    return count_by(out.filter(F.col("label_doc_id").isNull()), ["lang"], name="doc_count").orderBy("lang")


def m2_one_part_per_supplier(spark: SparkSession, sf_dir: str, name_part: str = "01") -> DataFrame:
    """For suppliers whose name contains ``name_part``: their lowest-keyed part (deterministic dedupe)."""
    t = StarTables(spark, sf_dir)
    suppliers = t.supplier.filter(F.col("s_name").contains(name_part)).select("s_suppkey", "s_name")
    # First part by key == min(l_partkey): a grouped aggregate combined map-side.
    first = t.lineitem.groupBy("l_suppkey").agg(F.min("l_partkey").alias("first_partkey"))
    picked = first.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    out = with_names(picked, t.part, "first_partkey", "p_partkey", columns=["p_name"])
    return out.select("p_name", "s_suppkey", "s_name").withColumnsRenamed(
        {"p_name": "film_name", "s_suppkey": "supplier_id", "s_name": "supplier_name"}
    )


def m3_shipped_after_days(spark: SparkSession, sf_dir: str, days: int = 50) -> DataFrame:
    """Line items shipped exactly ``days`` after their order, numbered by ship date."""
    t = StarTables(spark, sf_dir)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = t.orders.select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    hits = year_span(joined, "o_orderdate", "l_shipdate", "days_to_ship", lo=days, hi=days + 1, days=True).select(
        "o_orderkey",
        "l_linenumber",
        F.to_date("o_orderdate").alias("order_date"),
        F.to_date("l_shipdate").alias("ship_date"),
        "days_to_ship",
    )
    return number_rows(
        hits, ["ship_date", "o_orderkey", "l_linenumber"], keys=["days_to_ship"], name="ship_rank"
    ).orderBy("days_to_ship", "ship_rank")


def m4_part_names_per_brand(spark: SparkSession, sf_dir: str, brand_part: str = "Brand#1") -> DataFrame:
    """Per brand containing ``brand_part``: its part names in (name, key) order, one row each."""
    t = StarTables(spark, sf_dir)
    parts = t.part.filter(F.col("p_brand").contains(brand_part)).select("p_brand", "p_name", "p_partkey")
    return group_list(parts, ["p_brand"], "p_name", "part_name", order=["p_name", "p_partkey"])


def m5_documents_per_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with text, source and language present, per language, descending."""
    t = StarTables(spark, sf_dir)
    docs = t.documents.filter(
        F.col("text").isNotNull() & F.col("source").isNotNull() & F.col("lang").isNotNull()
    )
    return count_by(docs, ["lang"], name="doc_count").orderBy(F.col("doc_count").desc(), "lang")


def m6_numbered_big_orders(spark: SparkSession, sf_dir: str, year: int = 2000, min_price: float = 400000.0) -> DataFrame:
    """Orders of ``year`` priced above ``min_price``, numbered by price (all kept)."""
    t = StarTables(spark, sf_dir)
    orders = t.orders.filter(in_year("o_orderdate", year) & (F.col("o_totalprice") > min_price)).select(
        "o_orderkey", year_of("o_orderdate").alias("order_year"), "o_totalprice"
    )
    numbered = number_rows(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], name="top-20")
    return numbered.orderBy("`top-20`")


# --------------------------------------------------------------------- S*


def s1_distinct_parts_per_customer(spark: SparkSession, sf_dir: str, flag: str = RETURN_FLAG) -> DataFrame:
    """Distinct STANDARD parts in each customer's flagged line items; name by left join."""
    t = StarTables(spark, sf_dir)
    lines = t.lineitem.filter(F.col("l_returnflag") == flag).select("l_orderkey", "l_partkey")
    lines = exists_in(lines, t.part.filter(F.col("p_type") == MOVIE_TYPE), "l_partkey", "p_partkey")
    owned = lines.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    counts = count_by(owned, ["o_custkey"], name="part_count", distinct="l_partkey")
    out = with_names(counts, t.customer, "o_custkey", "c_custkey", how="left", columns=["c_name"])
    # part_count has few distinct values: sort on the key too so the range sort splits evenly.
    return out.orderBy(F.col("part_count").desc(), "o_custkey").select("c_name", "part_count")


def s2_lines_per_year_and_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items per (ship year, word of a STANDARD part's name); year then count descending."""
    t = StarTables(spark, sf_dir)
    lines = t.lineitem.select("l_partkey", year_of("l_shipdate").alias("ship_year"))
    parts = t.part.filter(F.col("p_type") == MOVIE_TYPE).select("p_partkey", "p_name")
    counts = count_through(
        lines, "l_partkey", parts, "p_partkey", ["ship_year", "word"], fact_group=["ship_year"], explode=("p_name", "word", " ")
    )
    return counts.orderBy(F.col("ship_year").desc(), F.col("count").desc(), "word")


def s3_customers_per_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ordering customers per nation, descending."""
    t = StarTables(spark, sf_dir)
    buyers = t.orders.select("o_custkey").distinct()  # combined map-side before any join
    located = buyers.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    named = located.join(_nation(t), F.col("c_nationkey") == F.col("n_nationkey"))
    return count_by(named, ["n_name"], name="customer_count").orderBy(
        F.col("customer_count").desc(), "n_name"
    )


def s4_customer_line_stats(spark: SparkSession, sf_dir: str, min_avg_quantity: float = 27.0) -> DataFrame:
    """Per customer: mean line price, mean quantity, line count; mean quantity above the bound."""
    t = StarTables(spark, sf_dir)
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(fixed_point("l_extendedprice")).alias("price_c"),
        F.sum(fixed_point("l_quantity")).alias("qty_c"),
        F.count(F.lit(1)).alias("n"),
    )
    per_customer = (
        per_order.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .agg(F.sum("price_c").alias("price_c"), F.sum("qty_c").alias("qty_c"), F.sum("n").alias("n"))
        .filter(F.col("qty_c") > F.lit(int(round(min_avg_quantity * 100))) * F.col("n"))
    )
    out = per_customer.join(t.customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    return out.select(
        "c_name",
        mean_from("price_c", "n").alias("avg_price"),
        mean_from("qty_c", "n").alias("avg_quantity"),
        F.col("n").alias("line_count"),
    ).orderBy(F.col("avg_price").desc(), "c_name")


def s5_top_parts_per_word(spark: SparkSession, sf_dir: str, min_size: int = 10, n: int = 5) -> DataFrame:
    """Top ``n`` parts per name word by retail price (ties: key), over parts larger than ``min_size``."""
    t = StarTables(spark, sf_dir)
    parts = t.part.filter(F.col("p_size") > min_size).select("p_partkey", "p_name", "p_retailprice", "p_size")
    words = _words(parts, ["p_partkey", "p_name", "p_retailprice", "p_size"])
    top = top_n_per_group(words, ["word"], [F.col("p_retailprice").desc(), F.col("p_partkey").asc()], n)
    return top.select("word", "p_partkey", "p_name", "p_retailprice", "p_size")


def s6_first_part_per_word_with_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest part per name word (ties: key) with the names of the suppliers
    that shipped it, in (name, key) order, one row each.

    A part nobody shipped drops out (as a title without directors does).
    """
    t = StarTables(spark, sf_dir)
    words = _words(t.part.filter(F.col("p_size") > 0).select("p_partkey", "p_name", "p_size"), ["p_partkey", "p_name", "p_size"])
    first = first_per_group(words, ["word"], [F.col("p_size").asc(), F.col("p_partkey").asc()])
    # few parts are left: they filter the scan of the line items before any shuffle
    shipped = late_lookup(first, t.lineitem, "p_partkey", "l_partkey", columns=["l_suppkey"]).distinct()
    named = with_names(shipped, t.supplier, "l_suppkey", "s_suppkey", how="left", columns=["s_name"])
    return group_list(
        named.select("word", "p_name", "p_size", "s_name", "l_suppkey"),
        ["word", "p_name", "p_size"],
        "s_name",
        "supplier_name",
        order=["s_name", "l_suppkey"],
    ).orderBy("word", "position")


# -------------------------------------------------------------------- ST*


def st1_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = StarTables(spark, sf_dir)
    return table_counts({name: t.table(name) for name in STAR_TABLES})


def st2_orders_per_year(spark: SparkSession, sf_dir: str, min_year: int = 1800) -> DataFrame:
    t = StarTables(spark, sf_dir)
    orders = t.orders.filter(F.col("o_orderdate").isNotNull() & year_at_least("o_orderdate", min_year))
    return count_by(orders.select(year_of("o_orderdate").alias("order_year")), ["order_year"]).orderBy("order_year")


def st3_lines_per_ship_year(spark: SparkSession, sf_dir: str, min_year: int = 1800) -> DataFrame:
    t = StarTables(spark, sf_dir)
    lines = t.lineitem.filter(F.col("l_shipdate").isNotNull() & year_at_least("l_shipdate", min_year))
    return count_by(lines.select(year_of("l_shipdate").alias("ship_year")), ["ship_year"]).orderBy("ship_year")


def st4_standard_part_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = StarTables(spark, sf_dir)
    return row_count(t.part.filter(F.col("p_type") == MOVIE_TYPE))


def st5_standard_parts_per_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = StarTables(spark, sf_dir)
    words = _words(t.part.filter(F.col("p_type") == MOVIE_TYPE).select("p_partkey", "p_name"), ["p_partkey"])
    return count_by(words, ["word"])


# Quantity bin edges; the last bin is closed on both ends.
QUANTITY_EDGES = (1, 10, 20, 30, 40, 50)


def st6_standard_lines_per_quantity_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of STANDARD parts per quantity bin (outside every bin -> NULL bin)."""
    t = StarTables(spark, sf_dir)
    lines = exists_in(
        t.lineitem.select("l_partkey", "l_quantity"), t.part.filter(F.col("p_type") == MOVIE_TYPE), "l_partkey", "p_partkey"
    )
    binned = lines.select(bin_label("l_quantity", QUANTITY_EDGES).alias("quantity_range"))
    return count_by(binned, ["quantity_range"]).orderBy("quantity_range")


# --------------------------------------------------------------------- P1

# Preview order per table (a unique key, or every column).
PREVIEW_ORDER: dict[str, list[str]] = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
}


def p1_preview(table: str, n: int = 5):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return preview(StarTables(spark, sf_dir).table(table), n, PREVIEW_ORDER[table])

    run.__name__ = f"p1_preview_{table}"
    return run

