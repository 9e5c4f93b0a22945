"""TSV reader: declared schema, ``\\N`` as NULL, no quoting, corrupt-record capture."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from marquee.schemas import FILE_NAMES, SCHEMAS
from marquee.sources import MovieCatalog, read_tsv

SCHEMA = StructType(
    [
        StructField("tconst", StringType(), True),
        StructField("title", StringType(), True),
        StructField("year", IntegerType(), True),
        StructField("n", IntegerType(), True),
    ]
)

LINES = [
    "tconst\ttitle\tyear\tn",
    '"tt1\ta\t2000\t1',
    'tt2\t"Quoted" rest\t\\N\t2',
    'tt3\t"Open quote\t2001\t3',
    "tt4\tok\tabc\t4",
    "tt5\tx\t\t5",
]


def _write(lines, name="t.tsv"):
    d = tempfile.mkdtemp(prefix="marquee-tsv-")
    path = os.path.join(d, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_reader_fixture(spark):
    df = read_tsv(spark, _write(LINES), SCHEMA, corrupt_column="_corrupt")
    got = {r["tconst"]: r for r in df.collect()}
    assert (got['"tt1']["title"], got['"tt1']["year"], got['"tt1']["n"]) == ("a", 2000, 1)
    assert (got["tt2"]["title"], got["tt2"]["year"], got["tt2"]["n"]) == ('"Quoted" rest', None, 2)
    assert (got["tt3"]["title"], got["tt3"]["year"], got["tt3"]["n"]) == ('"Open quote', 2001, 3)
    assert (got["tt4"]["year"], got["tt4"]["n"]) == (None, 4)
    assert got["tt4"]["_corrupt"] == "tt4\tok\tabc\t4"
    assert (got["tt5"]["title"], got["tt5"]["year"], got["tt5"]["n"]) == ("x", None, 5)
    assert got["tt5"]["_corrupt"] is None


def test_declared_schema_is_kept(spark):
    df = read_tsv(spark, _write(LINES), SCHEMA)
    assert df.schema == SCHEMA


def test_catalog_from_tsv(spark):
    d = tempfile.mkdtemp(prefix="marquee-dumps-")
    for table, schema in SCHEMAS.items():
        header = "\t".join(schema.fieldNames())
        with open(os.path.join(d, FILE_NAMES[table]), "w", encoding="utf-8") as f:
            f.write(header + "\n")
    with open(os.path.join(d, FILE_NAMES["title_ratings"]), "a", encoding="utf-8") as f:
        f.write("tt1\t8.1\t1000\ntt2\t\\N\t5\n")
    cat = MovieCatalog.from_tsv(spark, d)
    assert set(cat.tables()) == set(SCHEMAS)
    rows = sorted(cat.title_ratings.collect())
    assert rows[0]["averageRating"] is not None and abs(rows[0]["averageRating"] - 8.1) < 1e-6
    assert rows[1]["averageRating"] is None
    for table, schema in SCHEMAS.items():
        assert cat.tables()[table].schema == schema


def test_rejected_rows_parse_every_column(spark):
    from marquee.sources import reject_count, rejected_rows

    df = read_tsv(spark, _write(LINES), SCHEMA, corrupt_column="_corrupt")
    assert [r["tconst"] for r in rejected_rows(df, "_corrupt").collect()] == ["tt4"]
    assert reject_count(df, "_corrupt").first()["rejected"] == 1
