"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marquee.operators import top_n_per_group
from marquee.plans import registry
from marquee.plans import star
from tests.conftest import SF01


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_no_python_udf_and_no_single_partition_window(spark, name):
    plan = formatted(registry.QUERIES[name](spark, SF01))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in plan, f"{name}: {node}"
    tree = plan_of(registry.QUERIES[name](spark, SF01)).splitlines()
    for i, line in enumerate(tree):
        if "Exchange SinglePartition" in line:
            # one task may only receive one partial aggregate row per task, or the
            # per-range counts of number_rows (one row per range)
            child = tree[i + 1]
            assert "partial_" in child or "__range" in child, f"{name}: a single task would take every row"
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_top_n_uses_partial_window_group_limit(spark):
    parts = spark.read.parquet(f"{SF01}/part.parquet")
    df = top_n_per_group(parts, ["p_size"], [F.col("p_retailprice").desc(), F.col("p_partkey")], 3)
    plan = formatted(df)
    assert "WindowGroupLimit" in plan
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") or "Partial" in plan


def test_year_filter_reaches_the_scan(spark):
    plan = formatted(star.i4_old_urgent_orders(spark, SF01))
    assert "LessThan(o_orderdate,1996-01-01" in plan
    plan = formatted(star.a2_standard_parts_shipped_from(spark, SF01))
    assert "GreaterThanOrEqual(l_shipdate,2000-01-01" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = formatted(star.a7_mean_size_per_type(spark, SF01))
    read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert read and all("p_name" not in line for line in read)


def test_fixed_dimension_is_broadcast(spark):
    plan = formatted(star.s3_customers_per_nation(spark, SF01))
    assert "BroadcastHashJoin" in plan


def _check_shape(df, name):
    plan = formatted(df)
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in plan, f"{name}: {node}"
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    tree = plan_of(df).splitlines()
    for i, line in enumerate(tree):
        if "Exchange SinglePartition" in line:
            child = tree[i + 1]
            assert "partial_" in child or "__range" in child, f"{name}: a single task would take every row"


def test_catalog_questions_plan_shapes(catalog):
    from marquee.plans import movies

    for name, fn in movies.QUESTIONS.items():
        _check_shape(fn(catalog), name)
