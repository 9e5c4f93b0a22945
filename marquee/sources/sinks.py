"""CSV export of named results, published together.

Each result becomes a directory of part files written by the executors (no
data passes through the driver). All results are written beside the target
first; only when every one is complete are the directories moved into place,
and a manifest (``published.json``) names what was published. A run that fails
leaves the earlier files as they were.

Rows are counted by the pass that writes them. Array columns are joined to
strings first, because the CSV writer cannot store arrays.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from marquee.session import file_system

MANIFEST = "published.json"


class Published(str):
    """The path of a published result, and its ``rows``."""

    rows: int

    def __new__(cls, path: str, rows: int) -> Published:
        made = super().__new__(cls, path)
        made.rows = rows
        return made


def csv_ready(df: DataFrame, list_sep: str = ", ") -> DataFrame:
    """Join array columns to strings so the frame can be written as CSV."""
    cols = [
        F.array_join(F.col(f.name).cast("array<string>"), list_sep).alias(f.name)
        if isinstance(f.dataType, ArrayType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(cols)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and its row count as ``.get["rows"]`` once an action has run over
    it: the count is taken on the way, not by a job of its own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def export_csv(results: Mapping[str, DataFrame], out_dir: str, mode: str = "overwrite") -> dict[str, Published]:
    """Write every result to ``out_dir/<name>.csv`` with a header row, all or none.

    Iterates the mapping it is given, so a renamed result cannot be missed.
    Returns name -> written path, which also carries ``rows``. ``mode`` is
    ``overwrite`` or ``error`` (an existing result is an error before anything
    is written).
    """
    if mode not in ("overwrite", "error", "errorifexists"):
        raise ValueError(f"mode is overwrite or error, not {mode!r}")
    if not results:
        return {}
    spark = next(iter(results.values())).sparkSession
    target = {name: os.path.join(out_dir, f"{name}.csv") for name in results}
    for path in target.values():
        where, fs = file_system(spark, path)
        if mode != "overwrite" and fs.exists(where):
            raise FileExistsError(path)
    run = uuid.uuid4().hex
    aside = os.path.join(out_dir, f".staged-{run}")
    rows = {}
    try:
        for name, df in results.items():
            observed, seen = counted(csv_ready(df))
            observed.write.option("header", "true").csv(os.path.join(aside, f"{name}.csv"))
            rows[name] = seen.get["rows"]
        _publish(spark, out_dir, aside, target, run, rows)
    finally:
        where, fs = file_system(spark, aside)
        fs.delete(where, True)
    return {name: Published(path, rows[name]) for name, path in target.items()}


def _publish(spark: SparkSession, out_dir: str, aside: str, target: Mapping[str, str], run: str, rows: Mapping[str, int]) -> None:
    """Move the written results into place; if a move fails, move all back."""
    old, moved = os.path.join(out_dir, f".replaced-{run}"), []

    def move(source: str, to: str) -> None:
        (src, fs), (dst, _) = file_system(spark, source), file_system(spark, to)
        fs.mkdirs(dst.getParent())
        if not fs.rename(src, dst):
            raise OSError(f"could not move {source} to {to}")
        moved.append((source, to))

    try:
        for name, path in target.items():
            where, fs = file_system(spark, path)
            if fs.exists(where):
                move(path, os.path.join(old, f"{name}.csv"))
            move(os.path.join(aside, f"{name}.csv"), path)
        _write_manifest(spark, out_dir, {"run": run, "results": {n: {"path": f"{n}.csv", "rows": rows[n]} for n in target}})
    except Exception:
        for source, to in reversed(moved):
            (src, fs), (dst, _) = file_system(spark, to), file_system(spark, source)
            fs.rename(src, dst)
        raise
    finally:
        where, fs = file_system(spark, old)
        fs.delete(where, True)


def _write_manifest(spark: SparkSession, out_dir: str, told: dict) -> None:
    where, fs = file_system(spark, os.path.join(out_dir, MANIFEST))
    beside, _ = file_system(spark, os.path.join(out_dir, f".{MANIFEST}-{told['run']}"))
    out = fs.create(beside, True)
    try:
        out.write(bytearray(json.dumps(told, indent=1).encode()))
    finally:
        out.close()
    fs.delete(where, False)
    if not fs.rename(beside, where):
        raise OSError(f"could not write {where}")


def published(spark: SparkSession, out_dir: str) -> dict[str, Published]:
    """What the manifest of ``out_dir`` names: the results of one whole run (one
    short line per result is read)."""
    text = "\n".join(r["value"] for r in spark.read.text(os.path.join(out_dir, MANIFEST), wholetext=True).collect())
    return {n: Published(os.path.join(out_dir, r["path"]), r["rows"]) for n, r in json.loads(text)["results"].items()}


def read_published(spark: SparkSession, out_dir: str, name: str, schema: StructType | str) -> DataFrame:
    """A published result with its declared schema."""
    return spark.read.option("header", "true").schema(schema).csv(str(published(spark, out_dir)[name]))
