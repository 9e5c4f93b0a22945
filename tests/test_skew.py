"""A key holding a third of all rows must not land in one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marquee.operators import count_through, group_list, number_rows

ROWS = 30_000


def _skewed(spark):
    # one third of the rows in group "hot", the rest spread over 1,000 groups
    return spark.range(ROWS).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 1000).cast("string")).alias("g"),
        (F.col("id") * 7919 % 1009).alias("v"),
    )


@pytest.fixture
def uncoalesced(spark):
    # at this size AQE would merge everything into one partition; keep the
    # shuffle partitions as they would be at scale
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield spark
    spark.conf.set(key, old)


def _partition_sizes(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_number_rows_spreads_a_hot_group(uncoalesced):
    spark = uncoalesced
    out = number_rows(_skewed(spark), ["v", "id"], keys=["g"], name="rn")
    sizes = _partition_sizes(out)
    assert max(sizes) < ROWS / 3 * 0.75, sizes  # the hot group is split across tasks
    hot = out.filter(F.col("g") == "hot").agg(F.min("rn"), F.max("rn"), F.count(F.lit(1))).first()
    assert tuple(hot) == (1, ROWS // 3, ROWS // 3)  # and still numbered 1..N without gaps


def test_group_list_spreads_a_hot_group(uncoalesced):
    spark = uncoalesced
    out = group_list(_skewed(spark), ["g"], "v", "item", order=["v", "id"])
    assert max(_partition_sizes(out)) < ROWS / 3 * 0.75
    hot = out.filter(F.col("g") == "hot").agg(F.min("position"), F.max("position"), F.count(F.lit(1))).first()
    assert tuple(hot) == (1, ROWS // 3, ROWS // 3)


def test_count_through_collapses_hot_join_key(spark):
    fact = spark.range(ROWS).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    dim = spark.range(50).select(F.col("id").alias("k2"), (F.col("id") % 5).alias("grp"))
    got = {r["grp"]: r["count"] for r in count_through(fact, "k", dim, "k2", ["grp"]).collect()}
    assert sum(got.values()) == ROWS
    plan = count_through(fact, "k", dim, "k2", ["grp"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # the fact side is combined before it is shuffled


def test_exists_in_dedupe_collapses_repeated_keys(spark):
    from marquee.operators import exists_in

    left = spark.range(100).select(F.col("id").alias("k"))
    right = spark.range(ROWS).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40)).alias("k2"))
    plain = exists_in(left, right, "k", "k2")
    deduped = exists_in(left, right, "k", "k2", dedupe=True)
    assert sorted(r.k for r in plain.collect()) == sorted(r.k for r in deduped.collect()) == list(range(40))
    assert "HashAggregate" in deduped._jdf.queryExecution().executedPlan().toString()


def test_above_group_mean_never_shuffles_the_rows_by_group(spark):
    from marquee.operators import above_group_mean

    df = _skewed(spark).withColumn("price", (F.col("v") / 100.0))
    out = above_group_mean(df, ["g"], "price", exact_scale=2)
    assert out.count() > 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    # a window over the rows would put a whole group in one task: the only one is over the parts' sums
    assert plan.count("Window [") == 1 and "Window [sum(__sum" in plan
    assert "partial_sum" in plan  # the statistics are combined before their shuffle


@pytest.fixture
def no_skew_join(uncoalesced):
    keys = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64"}
    old = {k: uncoalesced.conf.get(k) for k in keys}
    for k, v in keys.items():
        uncoalesced.conf.set(k, v)
    yield uncoalesced
    for k, v in old.items():
        uncoalesced.conf.set(k, v)


def _people(spark):
    names = spark.range(1000).select(F.col("id").cast("string").alias("p"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    return names.union(spark.createDataFrame([("hot", "Hot")], "p string, name string"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_join_splits_the_hot_key_without_adaptive_help(no_skew_join, how):
    from marquee.operators import hot_key_join

    spark = no_skew_join
    left = _skewed(spark).withColumn("g", F.when(F.col("id") % 31 != 0, F.col("g")))  # some NULL keys too
    out = hot_key_join(left, _people(spark), "g", "p", how=how, columns=["name"], rows_per_part=300)
    assert max(_partition_sizes(out)) < ROWS / 10
    plain = left.join(_people(spark), F.col("g") == F.col("p"), how).select("id", "g", "v", "name")
    assert max(_partition_sizes(plain)) > ROWS / 4  # what it is for
    assert out.columns == plain.columns
    assert out.exceptAll(plain).count() == 0 and plain.exceptAll(out).count() == 0


def test_hot_key_join_keeps_ties_and_fan_out(spark):
    from marquee.operators import hot_key_join

    left = spark.createDataFrame([("a", 1)] * 50 + [("b", 2)] * 3 + [(None, 3)], "k string, v int")
    right = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), ("c", "w")], "k string, v string")
    out = hot_key_join(left, right, "k", "k", columns=["v"], rename={"v": "w"}, rows_per_part=7, most_keys=2)
    assert sorted((r["k"], r["w"]) for r in out.collect()) == sorted([("a", "x"), ("a", "y")] * 50 + [("b", "z")] * 3)
    none = left.where("v > 9")
    assert hot_key_join(none, right, "k", "k", columns=["v"], rename={"v": "w"}).count() == 0
    with pytest.raises(ValueError):
        hot_key_join(left, right, "k", "k", how="full")


def test_above_group_mean_spreads_a_hot_group(no_skew_join):
    from marquee.operators import above_group_mean

    df = _skewed(no_skew_join).withColumn("price", F.col("v") / 100.0)
    out = above_group_mean(df, ["g"], "price", mean_name="m", exact_scale=2)
    assert max(_partition_sizes(out)) < ROWS / 10


def test_ranges_are_even_and_the_same_every_time(spark):
    from marquee.operators.ranges import sort_keys, with_range

    df = _skewed(spark)
    keys = sort_keys(["g", F.col("v").desc(), "id"], df.columns)
    one = with_range(df, keys, "r", ranges=20)
    sizes = [r["count"] for r in one.groupBy("r").count().collect()]
    assert 20 <= len(sizes) <= 41 and max(sizes) < 3 * ROWS / 20
    again = with_range(df.repartition(13, "v"), keys, "r", ranges=20)
    assert one.select("id", "r").exceptAll(again.select("id", "r")).count() == 0
    with pytest.raises(ValueError):
        sort_keys([F.col("v") + 1], df.columns)
