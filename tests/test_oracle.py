"""Every registered query equals its DuckDB oracle at sf0.01 (exact values, any order)."""

from __future__ import annotations

import pytest

from marquee.plans import registry
from tests.conftest import SF01
from tests.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(registry.queries())


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_matches_oracle(spark, con, name):
    result = compare(spark, name, registry.QUERIES[name], registry.oracle_sql()[name], SF01, con)
    assert "error" not in result, result
    assert result["spark_rows"] > 0


@pytest.fixture
def other_layout(spark):
    """Another physical layout: AQE off, 3 shuffle partitions, no automatic
    broadcast, and ANSI mode off (legacy NULL and overflow semantics)."""
    conf = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "3",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.ansi.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_result_does_not_depend_on_layout(other_layout, con, name):
    result = compare(other_layout, name, registry.QUERIES[name], registry.oracle_sql()[name], SF01, con)
    assert "error" not in result, result
