"""CSV export round trip (X1) and the driver contract."""

from __future__ import annotations

import os
import tempfile

import __spark_entry__ as entry_mod
from marquee.plans import movies, registry


def test_export_round_trip(spark, catalog):
    out = tempfile.mkdtemp(prefix="marquee-export-")
    written = movies.x1_export(catalog, out)
    assert set(written) == set(movies.s_results(catalog))
    for name, path in written.items():
        assert os.path.isdir(path)
        back = spark.read.option("header", "true").csv(path)
        src = movies.s_results(catalog)[name]
        assert back.columns == src.columns
        assert back.count() == src.count()
    regions = spark.read.option("header", "true").option("inferSchema", "true").csv(written["top_regions"])
    assert sorted((r["region"], r["unique_titles"]) for r in regions.collect()) == [("DE", 4), ("FR", 1)]


def test_export_overwrites(spark, catalog):
    out = tempfile.mkdtemp(prefix="marquee-export-")
    movies.x1_export(catalog, out)
    movies.x1_export(catalog, out)  # second write replaces the first


def test_entry_contract(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["word", "p_partkey", "p_name", "p_retailprice", "p_size"]
    assert set(registry.QUERIES) <= set(entry_mod.queries())
    assert set(registry.QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def test_export_joins_array_columns(spark, catalog):
    from marquee.sources import export_csv

    out = tempfile.mkdtemp(prefix="marquee-export-")
    lists = spark.createDataFrame([("actor,music_department", ["Benedict Roe"]), ("music_department", ["Cy Poe"])],
                                  "containsMusic_Department string, fullName array<string>")
    written = export_csv({"music": lists}, out)
    back = spark.read.option("header", "true").csv(written["music"])
    got = sorted((r["containsMusic_Department"], r["fullName"]) for r in back.collect())
    assert got == [("actor,music_department", "Benedict Roe"), ("music_department", "Cy Poe")]


def test_a_failed_export_leaves_the_old_files_whole(spark, tmp_path):
    from pyspark.sql import functions as F

    from marquee.sources import export_csv, published, read_published

    out = str(tmp_path)
    good = {f"r{k}": spark.range(k + 1).toDF("id") for k in range(6)}
    first = export_csv(good, out)
    assert {n: p.rows for n, p in first.items()} == {f"r{k}": k + 1 for k in range(6)}
    newer = {f"r{k}": spark.range(100).toDF("id") for k in range(6)}
    newer["r3"] = spark.range(100).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    import pytest

    with pytest.raises(Exception, match="broken"):
        export_csv(newer, out)
    for k in range(6):
        assert spark.read.option("header", "true").csv(first[f"r{k}"]).count() == k + 1
    assert {n: p.rows for n, p in published(spark, out).items()} == {f"r{k}": k + 1 for k in range(6)}
    assert sorted(f for f in os.listdir(out) if not f.endswith(".crc")) == ["published.json", *[f"r{k}.csv" for k in range(6)]]
    newer["r3"] = good["r3"]
    export_csv(newer, out)
    assert published(spark, out)["r0"].rows == 100
    assert read_published(spark, out, "r3", "id long").count() == 4
    with pytest.raises(FileExistsError):
        export_csv(good, out, mode="error")
    with pytest.raises(ValueError):
        export_csv(good, out, mode="append")


def test_a_failed_move_puts_all_back(spark, tmp_path, monkeypatch):
    import pytest

    from marquee.sources import export_csv, published, sinks

    out = str(tmp_path)
    export_csv({"a": spark.range(1).toDF("id"), "b": spark.range(2).toDF("id")}, out)

    def broken(*_):
        raise OSError("no manifest")

    monkeypatch.setattr(sinks, "_write_manifest", broken)
    with pytest.raises(OSError, match="no manifest"):
        export_csv({"a": spark.range(9).toDF("id"), "b": spark.range(9).toDF("id")}, out)
    monkeypatch.undo()
    assert {n: spark.read.option("header", "true").csv(p).count() for n, p in published(spark, out).items()} == {"a": 1, "b": 2}


def test_rows_are_counted_by_the_write_itself(spark, catalog, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    from marquee.sources import export_csv

    df = spark.range(500, numPartitions=3).toDF("id")
    before = set(tracker.getJobIdsForGroup(None))
    assert export_csv({"n": df}, str(tmp_path))["n"].rows == 500
    assert len(set(tracker.getJobIdsForGroup(None)) - before) == 1
    written = movies.x1_export(catalog, str(tmp_path / "x1"))
    assert {n: p.rows for n, p in written.items()} == {n: df.count() for n, df in movies.s_results(catalog).items()}
