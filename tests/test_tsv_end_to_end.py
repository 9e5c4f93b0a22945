"""The fixture catalog written as tab-separated dumps, read back and queried."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

import pytest

from marquee.plans import movies
from marquee.schemas import FILE_NAMES, SCHEMAS
from marquee.sources import MovieCatalog
from tests.fixtures import ROWS

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _cell(v):
    return "\\N" if v is None else str(v)


@pytest.fixture(scope="module")
def dumps():
    d = tempfile.mkdtemp(prefix="marquee-dumps-")
    for table, schema in SCHEMAS.items():
        with open(os.path.join(d, FILE_NAMES[table]), "w", encoding="utf-8") as f:
            f.write("\t".join(schema.fieldNames()) + "\n")
            for row in ROWS[table]:
                f.write("\t".join(_cell(v) for v in row) + "\n")
    return d


def test_tsv_catalog_gives_the_same_answers(spark, catalog, dumps):
    from_tsv = MovieCatalog.from_tsv(spark, dumps)
    for qid, fn in movies.QUESTIONS.items():
        a = sorted(map(repr, fn(from_tsv).collect()))
        b = sorted(map(repr, fn(catalog).collect()))
        assert a == b, qid


def _cli(capsys, *args) -> str:
    """Run the command line in this process (on the test session) and return its output."""
    from marquee.__main__ import main

    assert main(list(args)) == 0
    return capsys.readouterr().out


def test_command_line(spark, dumps, capsys):
    out = _cli(capsys, "questions", "S3", "M5", "--dumps", dumps)
    assert "---- S3" in out and "rows: 2" in out


def test_parquet_round_trip(spark, dumps):
    out = tempfile.mkdtemp(prefix="marquee-parquet-")
    MovieCatalog.from_tsv(spark, dumps).write_parquet(out)
    back = MovieCatalog.from_parquet(spark, out)
    for table, schema in SCHEMAS.items():
        assert back.tables()[table].schema == schema
    assert sorted(map(repr, movies.s5_top5_per_genre(back).collect())) == sorted(
        map(repr, movies.s5_top5_per_genre(MovieCatalog.from_tsv(spark, dumps)).collect())
    )


def test_read_tables(spark, dumps):
    from marquee.sources import read_tables

    cat = read_tables(spark, dumps, "tsv")
    assert cat.title_basics.count() == len(ROWS["title_basics"])
    with pytest.raises(ValueError):
        read_tables(spark, dumps, "xml")


def test_audit_counts_unparsable_rows(spark, dumps, capsys):
    d = tempfile.mkdtemp(prefix="marquee-dumps-bad-")
    for name in os.listdir(dumps):
        with open(os.path.join(dumps, name), encoding="utf-8") as src, open(os.path.join(d, name), "w", encoding="utf-8") as dst:
            dst.write(src.read())
    with open(os.path.join(d, FILE_NAMES["title_ratings"]), "a", encoding="utf-8") as f:
        f.write("tt77\tnot-a-number\t10\n")
    out = _cli(capsys, "audit", "--dumps", d)
    assert f"title_ratings: rows {len(ROWS['title_ratings']) + 1}, rejected 1" in out
    assert f"title_basics: rows {len(ROWS['title_basics'])}, rejected 0" in out


def test_parquet_layout_sorted_for_row_group_pruning(spark, dumps):
    import glob

    import pyarrow.parquet as pq

    out = tempfile.mkdtemp(prefix="marquee-parquet-")
    MovieCatalog.from_tsv(spark, dumps).write_parquet(out)
    for f in glob.glob(os.path.join(out, "title_basics.parquet", "*.parquet")):
        types = pq.read_table(f, columns=["titleType"]).column("titleType").to_pylist()
        assert types == sorted(types, key=lambda t: (t is not None, t))  # NULLs first, then ascending


def test_command_line_reads_the_current_folder_by_default(dumps):
    out = subprocess.run(
        [sys.executable, "-m", "marquee", "statistics", "ST4", "--master", "local[2]"],
        cwd=dumps, env=dict(os.environ, PYTHONPATH=REPO), capture_output=True, text=True, timeout=300,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert "---- ST4" in out.stdout


def test_command_line_explain(spark, dumps, capfd):
    from marquee.__main__ import main

    assert main(["explain", "S5", "--dumps", dumps]) == 0
    out = capfd.readouterr().out  # the plan is printed by the JVM side of explain
    assert "---- S5" in out and "WindowGroupLimit" in out
