"""Operator properties, checked against brute force on generated tables."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from marquee.functions import bin_label, exact_mean
from marquee.operators import above_group_mean, explode_list, group_list, number_rows, top_n_per_group

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

KEYED = StructType(
    [
        StructField("id", LongType(), False),
        StructField("g", StringType(), True),
        StructField("v", IntegerType(), True),
    ]
)

keyed_rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 5)), min_size=0, max_size=40
).map(lambda xs: [(i, g, v) for i, (g, v) in enumerate(xs)])


@SETTINGS
@given(rows=keyed_rows, n=st.integers(1, 4))
def test_top_n_per_group_sizes(spark, rows, n):
    df = spark.createDataFrame(rows, KEYED)
    got = top_n_per_group(df, ["g"], [F.col("v").desc(), F.col("id").asc()], n).collect()
    sizes = Counter(g for _, g, _ in rows)
    got_sizes = Counter(r["g"] for r in got)
    assert got_sizes == Counter({g: min(n, c) for g, c in sizes.items()})
    expect = set()
    by_group = defaultdict(list)
    for i, g, v in rows:
        by_group[g].append((-v, i))
    for g, xs in by_group.items():
        expect |= {(g, i) for _, i in sorted(xs)[:n]}
    assert {(r["g"], r["id"]) for r in got} == expect


@SETTINGS
@given(rows=keyed_rows)
def test_number_rows_matches_row_number(spark, rows):
    df = spark.createDataFrame(rows, KEYED).repartition(3)
    got = number_rows(df, [F.col("v").desc(), F.col("id").asc()], keys=["g"], name="rn").collect()
    expect = {}
    by_group = defaultdict(list)
    for i, g, v in rows:
        by_group[g].append((-v, i))
    for g, xs in by_group.items():
        for k, (_, i) in enumerate(sorted(xs), start=1):
            expect[i] = k
    assert {r["id"]: r["rn"] for r in got} == expect
    glob = number_rows(df, ["id"], name="rn").collect()
    assert sorted((r["id"], r["rn"]) for r in glob) == [(i, k) for k, (i, _, _) in enumerate(rows, start=1)]


@SETTINGS
@given(
    rows=st.lists(st.lists(st.sampled_from(["x", "y", "z", ""]), min_size=1, max_size=4), max_size=15)
)
def test_explode_count_is_sum_of_list_sizes(spark, rows):
    data = [(i, ",".join(xs)) for i, xs in enumerate(rows)] + [(len(rows), None)]
    df = spark.createDataFrame(data, "id long, lst string")
    out = explode_list(df, "lst", "item")
    assert out.count() == sum(len(xs) for xs in rows)


@SETTINGS
@given(values=st.lists(st.floats(0, 11, allow_nan=False), max_size=30))
def test_bins_partition_the_range(spark, values):
    edges = list(range(1, 11))
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r["b"] for r in df.select(bin_label("x", edges).alias("b")).collect()]
    for v, b in zip([r["x"] for r in df.collect()], got):
        inside = 1 <= v <= 10
        assert (b is not None) == inside
        if inside:
            lo, hi = (int(s) for s in b.split("-"))
            assert lo <= v and (v < hi or (hi == 10 and v == 10))


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3000)), max_size=30))
def test_above_group_mean_exact(spark, rows):
    data = [(i, g, v / 100.0) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, g string, p double")
    got = {r["id"] for r in above_group_mean(df, ["g"], "p", exact_scale=2).collect()}
    sums, counts = defaultdict(int), Counter()
    for _, g, v in [(i, g, v) for i, (g, v) in enumerate(rows)]:
        sums[g] += v
        counts[g] += 1
    expect = {i for i, (g, v) in enumerate(rows) if v * counts[g] > sums[g]}
    assert got == expect
    # never a whole group
    for g in counts:
        members = {i for i, (gg, _) in enumerate(rows) if gg == g}
        assert not members <= got


def test_more_decimals_than_the_scale_are_an_error(spark):
    df = spark.createDataFrame([("a", 0.001), ("a", 0.004)], "g string, p double")
    with pytest.raises(Exception, match="more than 2 decimal places"):
        above_group_mean(df, ["g"], "p", exact_scale=2).collect()
    assert [r["p"] for r in above_group_mean(df, ["g"], "p", exact_scale=3).collect()] == [0.004]


@SETTINGS
@given(rows=keyed_rows, blank=st.sets(st.integers(0, 39)))
def test_group_list_numbers_each_value_in_order(spark, rows, blank):
    rows = [(i, g, None if i in blank else v) for i, g, v in rows]
    df = spark.createDataFrame(rows, KEYED).withColumn("s", F.col("v").cast("string"))
    out = group_list(df.select("g", "s", "id"), ["g"], "s", "item", order=["s", "id"]).collect()
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (repr(r["g"]), r["position"])):
        got[r["g"]].append(r["item"])
        assert r["position"] == len(got[r["g"]])
    expect = defaultdict(list)
    for i, g, v in sorted(rows, key=lambda r: (r[2] is None, str(r[2]), r[0])):
        expect[g].append(None if v is None else str(v))
    assert dict(got) == dict(expect)


def test_exact_mean_is_order_free(spark):
    vals = [0.1, 0.2, 0.3] * 50
    a = spark.createDataFrame([(v,) for v in vals], "x double")
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "x double").repartition(7)
    ma = a.agg(exact_mean("x").alias("m")).first()["m"]
    mb = b.agg(exact_mean("x").alias("m")).first()["m"]
    assert ma == mb == 0.2


@pytest.fixture
def no_auto_broadcast(spark):
    # isolate our own size check from Spark's automatic broadcast of small sides
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, old)


def test_joins_without_broadcast_give_the_same_rows(no_auto_broadcast):
    spark = no_auto_broadcast
    rows = [(i, ["a", "b", None][i % 3], i % 7) for i in range(60)]
    df = spark.createDataFrame(rows, KEYED).repartition(4)
    numbered = number_rows(df, ["v", "id"], keys=["g"], name="rn")
    assert "BroadcastHashJoin" not in numbered._jdf.queryExecution().executedPlan().toString()
    want = {}
    for g in ("a", "b", None):
        own = sorted((v, i) for i, k, v in rows if k == g)
        want |= {i: n for n, (_, i) in enumerate(own, start=1)}
    assert {r["id"]: r["rn"] for r in numbered.collect()} == want


def test_year_helpers_on_date_ntz_and_ltz_columns(spark):
    from marquee.functions import in_year, year_at_least, year_below

    df = spark.createDataFrame(
        [(1, "1999-12-31 23:59:59"), (2, "2000-01-01 00:00:00"), (3, "2000-12-31 23:59:59"), (4, "2001-01-01 00:00:00")],
        "id int, s string",
    ).select(
        "id",
        F.to_timestamp_ntz("s").alias("ntz"),
        F.to_timestamp("s").alias("ltz"),
        F.to_date("s").alias("d"),
    )
    for c in ("ntz", "ltz", "d"):
        assert sorted(r.id for r in df.filter(in_year(c, 2000)).collect()) == [2, 3], c
        assert sorted(r.id for r in df.filter(year_at_least(c, 2000)).collect()) == [2, 3, 4], c
        assert sorted(r.id for r in df.filter(year_below(c, 2000)).collect()) == [1], c


@SETTINGS
@given(rows=keyed_rows, n=st.integers(1, 4))
def test_number_rows_with_limit_is_a_prefix(spark, rows, n):
    df = spark.createDataFrame(rows, KEYED).repartition(3)
    full = {(r["id"], r["rn"]) for r in number_rows(df, [F.col("v").desc(), F.col("id").asc()], keys=["g"], name="rn").collect()}
    cut = {(r["id"], r["rn"]) for r in number_rows(df, [F.col("v").desc(), F.col("id").asc()], keys=["g"], name="rn", limit=n).collect()}
    assert cut == {(i, k) for i, k in full if k <= n}
    gfull = {(r["id"], r["rn"]) for r in number_rows(df, ["v", "id"], name="rn").collect()}
    gcut = {(r["id"], r["rn"]) for r in number_rows(df, ["v", "id"], name="rn", limit=n).collect()}
    assert gcut == {(i, k) for i, k in gfull if k <= n}


def test_operators_keep_nothing_and_the_callers_cache(spark):
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("g"), "id", (F.col("id") / 4).alias("p")).persist()
    df.count()
    level, kept = df.storageLevel, spark.sparkContext._jsc.getPersistentRDDs().size()
    assert level.useMemory
    number_rows(df, ["id"], keys=["g"]).count()
    above_group_mean(df, ["g"], "p", exact_scale=2).count()
    group_list(df, ["g"], "p", "item").count()
    assert df.storageLevel == level
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    df.unpersist()


@SETTINGS
@given(
    facts=st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["x", "y"])), max_size=40),
    lists=st.lists(st.one_of(st.none(), st.sampled_from(["a", "a,b", "b,c,a", "", "c"])), min_size=7, max_size=7),
)
def test_count_through_matches_brute_force(spark, facts, lists):
    from collections import Counter

    from marquee.operators import count_through

    fact = spark.createDataFrame(facts, "k long, t string") if facts else spark.createDataFrame([], "k long, t string")
    dim = spark.createDataFrame(list(enumerate(lists)), "dk long, items string")
    got = {(r["t"], r["item"]): r["count"] for r in count_through(
        fact, "k", dim, "dk", ["t", "item"], fact_group=["t"], explode=("items", "item", ",")
    ).collect()}
    want = Counter()
    for k, t in facts:
        if lists[k] is not None:
            for item in lists[k].split(","):
                want[(t, item)] += 1
    assert got == dict(want)
