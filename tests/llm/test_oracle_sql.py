"""The queries that SQL can express, against it on whole tables."""

from __future__ import annotations

import pytest

from marquee.llm import queries
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op2_rule_ledger", "op8_phrases", "op9_jaccard"])
def test_query_equals_sql(spark, name):
    got = compare(spark, name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF, duck(SF))
    assert "error" not in got and got["spark_rows"] == 1000
