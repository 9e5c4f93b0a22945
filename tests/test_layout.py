"""Tables laid out by join key, late lookups and one-pass group means: rows equal, plans as intended."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from marquee.operators import key_filter, late_lookup, may_hold
from marquee.plans import movies, tables
from marquee.sources import MovieCatalog, bucket_files, detach_bucketed, read_tables, write_bucketed
from tests.test_plans import plan_of


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, old)


@pytest.fixture
def bucketed(no_broadcast, catalog, tmp_path):
    yield catalog.write_bucketed(str(tmp_path), 8)
    detach_bucketed(no_broadcast, str(tmp_path))


def final_plan(df) -> str:
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def joined_exchanges(plan: str) -> list[str]:
    """Exchanges that stand below a join in a plan's tree."""
    found, joins = [], []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        joins = [d for d in joins if d < depth]
        if "Exchange" in line and joins:
            found.append(line.strip())
        if "Join" in line:
            joins.append(depth)
    return found


@pytest.mark.parametrize("name", ["A5", "I7", "S4"])
def test_bucketed_joins_shuffle_nothing(bucketed, catalog, name):
    question = movies.QUESTIONS[name]
    assert sorted(map(repr, question(bucketed).collect())) == sorted(map(repr, question(catalog).collect()))
    plain = joined_exchanges(plan_of(question(catalog)))
    below = joined_exchanges(plan_of(question(bucketed)))
    if name == "A5":
        assert plain and not below
    else:  # only the exchange of an aggregate, or of the dealt groups, is left: none of a scanned table
        assert len(below) < len(plain)
        tree = plan_of(question(bucketed)).splitlines()
        for i, line in enumerate(tree):
            if "Exchange hashpartitioning(tconst" in line or "Exchange hashpartitioning(parentTconst" in line:
                assert "partial_" in tree[i + 1], line


def test_bucketed_tables_come_back_in_another_session(spark, catalog, tmp_path):
    root = str(tmp_path)
    catalog.write_bucketed(root, 4)
    detach_bucketed(spark, root)
    back = read_tables(spark.newSession(), root, "bucketed")
    for name, df in catalog.tables().items():
        assert sorted(map(repr, back.tables()[name].collect())) == sorted(map(repr, df.collect())), name
        assert [f.dataType for f in back.tables()[name].schema] == [f.dataType for f in df.schema]
    catalog.write_bucketed(root, 3)  # over the old one
    again = MovieCatalog.from_bucketed(spark, root)
    assert again.title_basics.count() == catalog.title_basics.count()
    detach_bucketed(spark, root)


def test_buckets_are_one_file_each_and_hold_all_rows(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(5000).select((F.col("id") % 700).alias("k"), "id")
    laid = write_bucketed({"t": df}, {"t": "k"}, root, 6)["t"]
    files = bucket_files(laid).collect()
    assert len(files) == 6 and sum(r["rows"] for r in files) == 5000
    with pytest.raises(ValueError):
        write_bucketed({"t": df}, {"t": "k"}, root, 0)
    assert write_bucketed({}, {}, root, 2) == {}
    detach_bucketed(spark, root)


def test_bucketed_question_joins_without_a_shuffle(no_broadcast):
    plan = plan_of(tables.l1_bucketed_order_lines(no_broadcast, "/root/testdata/sf0.001"))
    assert "SortMergeJoin" in plan and not joined_exchanges(plan)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_late_lookup_is_the_plain_join(spark, how):
    keys = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("zz", 5)], "k string, n int")
    table = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 2.5), (None, 3.0), ("c", 4.0)], "t string, v double")
    plain = keys.join(table, keys["k"] == table["t"], how).select("k", "n", "v")
    for bits in (32, 1 << 16):
        got = late_lookup(keys, table, "k", "t", how=how, columns=["v"], bits=bits)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))
    empty = keys.where("n > 9")
    assert late_lookup(empty, table, "k", "t", columns=["v"]).count() == 0


def test_key_filter_never_misses_and_seldom_errs(spark):
    keys = spark.range(0, 3000, 30).select(F.col("id").alias("k"))
    held = spark.range(20_000).where(may_hold(key_filter(keys, "k"), F.col("id")))
    ids = {r["id"] for r in held.collect()}
    assert set(range(0, 3000, 30)) <= ids
    assert len(ids) < 100 + 20_000 * 0.01
    full = key_filter(spark.range(50_000), "id", bits=64)  # a full bitmap lets all through
    assert spark.range(1000).where(may_hold(full, F.col("id"), bits=64)).count() == 1000


def test_s6_filters_both_tables_before_their_shuffle(no_broadcast, catalog):
    tree = plan_of(movies.s6_earliest_per_genre(catalog)).splitlines()
    seen = 0
    for i, line in enumerate(tree):
        if re.search(r"Exchange hashpartitioning\((__late_key|tconst|nconst)", line) and any("getbit" in x for x in tree[i : i + 4]):
            seen += 1
    assert seen >= 2  # title_crew and name_basics


@pytest.mark.parametrize("name", ["I6", "I7"])
def test_group_means_join_titles_and_ratings_once(no_broadcast, catalog, tmp_path, name):
    catalog.write_parquet(str(tmp_path))
    plan = final_plan(movies.QUESTIONS[name](MovieCatalog.from_parquet(no_broadcast, str(tmp_path))))
    assert len(re.findall(r"SortMergeJoin \[tconst", plan)) == 1
    assert "ReusedExchange" in plan
    assert len(re.findall(r"FileScan parquet", plan)) == 2


def test_numbering_starts_no_job(spark, catalog):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    for name in ("M3", "M4", "M6", "S6"):
        movies.QUESTIONS[name](catalog)
    assert set(tracker.getJobIdsForGroup(None)) == before
