"""Tables laid out by join key: bucketed and sorted Parquet.

A table written here is hash-dealt into ``buckets`` files by its join key and
sorted by it, and is attached to the session's catalog with that layout. Joins
of two such tables on their bucket keys read bucket by bucket: nothing is
shuffled. Set ``spark.sql.shuffle.partitions`` to the bucket count, so that an
aggregate on the other side of a join is dealt the same way and is shuffled
once, not twice.

Made for keys whose groups are small (title and person ids). A bucket cannot be
split at run time, so a table whose key may be hot belongs to ``hot_key_join``.

``root`` then holds one folder per table and ``_layout.parquet``, a row per
table, from which any later session attaches them again.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYOUT = "_layout.parquet"
LAYOUT_SCHEMA = "name string, key string, buckets int, ddl string"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def table_name(root: str, name: str) -> str:
    """The catalog name of a table under ``root``: one per folder, whatever the session."""
    code = hashlib.md5(root.rstrip("/").encode()).hexdigest()[:12]
    return f"marquee_{code}_{name}"


def write_bucketed(tables: Mapping[str, DataFrame], keys: Mapping[str, str], root: str, buckets: int) -> dict[str, DataFrame]:
    """Write every table to ``root/<name>.parquet`` in ``buckets`` files by
    ``keys[name]`` and return them attached. One file per bucket: rows are dealt
    by the same hash before the write, so a task writes one bucket only."""
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    layout, spark = [], None
    for name, df in tables.items():
        spark, key, path = df.sparkSession, keys[name], os.path.join(root, f"{name}.parquet")
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(table_name(root, name))}")  # external: its files stay until overwritten
        dealt = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite")
        dealt.format("parquet").option("path", path).saveAsTable(table_name(root, name))
        ddl = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
        layout.append((name, key, buckets, ddl))
    if spark is None:
        return {}
    spark.createDataFrame(layout, LAYOUT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(os.path.join(root, LAYOUT))
    return {name: spark.table(table_name(root, name)) for name in tables}


def attach_bucketed(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of ``write_bucketed`` under ``root``, with their layout. The
    layout file has one row per table."""
    found = {}
    for row in spark.read.schema(LAYOUT_SCHEMA).parquet(os.path.join(root, LAYOUT)).orderBy("name").collect():
        name = table_name(root, row["name"])
        path = os.path.join(root, f"{row['name']}.parquet").replace("'", "\\'")
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
        spark.sql(
            f"CREATE TABLE {_quoted(name)} ({row['ddl']}) USING parquet "
            f"CLUSTERED BY ({_quoted(row['key'])}) SORTED BY ({_quoted(row['key'])}) INTO {row['buckets']} BUCKETS "
            f"LOCATION '{path}'"
        )
        found[row["name"]] = spark.table(name)
    return found


def detach_bucketed(spark: SparkSession, root: str) -> None:
    """Forget the tables under ``root`` in this session's catalog; files stay."""
    for row in spark.read.schema(LAYOUT_SCHEMA).parquet(os.path.join(root, LAYOUT)).select("name").collect():
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(table_name(root, row['name']))}")


def bucket_files(df: DataFrame) -> DataFrame:
    """(file, rows) of a bucketed frame: how evenly its key deals rows."""
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"))
