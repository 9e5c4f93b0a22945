"""The typed seven-table catalog.

A frozen dataclass of DataFrames instead of a dict that also carries the
session: callers never have to strip a non-table entry, and each field has
a declared schema.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from marquee.schemas import FILE_NAMES, SCHEMAS
from marquee.sources.bucketed import attach_bucketed, write_bucketed
from marquee.sources.readers import read_parquet, read_tsv


# Per-table write order, led by the columns the questions filter on.
WRITE_ORDER: dict[str, list[str]] = {
    "title_basics": ["titleType", "startYear"],
    "title_akas": ["region", "language"],
    "title_ratings": ["numVotes"],
    "name_basics": ["birthYear"],
    "title_principals": ["category"],
}

# The id each table is joined by, and so bucketed by.
JOIN_KEYS: dict[str, str] = {
    "name_basics": "nconst",
    "title_akas": "titleId",
    "title_basics": "tconst",
    "title_crew": "tconst",
    "title_episode": "tconst",
    "title_principals": "tconst",
    "title_ratings": "tconst",
}


@dataclass(frozen=True)
class MovieCatalog:
    name_basics: DataFrame
    title_akas: DataFrame
    title_basics: DataFrame
    title_crew: DataFrame
    title_episode: DataFrame
    title_principals: DataFrame
    title_ratings: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    @classmethod
    def from_tsv(
        cls,
        spark: SparkSession,
        root: str,
        file_names: dict[str, str] | None = None,
        corrupt_column: str | None = None,
    ) -> MovieCatalog:
        """Read the seven tab-separated dumps found under ``root``, each plain or
        gzipped (``name.basics.tsv`` or ``name.basics.tsv.gz``; keep one of them).

        ``corrupt_column`` appends a column holding the raw line of rows that
        did not parse (see ``readers.reject_count``).
        """
        names = file_names or FILE_NAMES
        return cls(
            **{
                t: read_tsv(spark, os.path.join(root, names[t]) + ("{,.gz}" if file_names is None else ""), schema, corrupt_column=corrupt_column)
                for t, schema in SCHEMAS.items()
            }
        )

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> MovieCatalog:
        """Read ``root/<table>.parquet`` for each table, cast to the declared schema."""
        return cls(
            **{t: read_parquet(spark, os.path.join(root, f"{t}.parquet"), schema) for t, schema in SCHEMAS.items()}
        )

    def write_parquet(
        self, root: str, mode: str = "overwrite", sort_within: dict[str, list[str]] | None = None
    ) -> dict[str, str]:
        """Write every table to ``root/<table>.parquet`` (executors write; nothing
        passes through the driver).

        The public dumps are gzipped text, which Spark cannot split: one task
        reads a whole file. Converting once gives splittable, column-pruned,
        filter-pushed scans for every later run (``from_parquet``).

        Each task sorts its rows by the table's ``sort_within`` columns before
        writing (no shuffle), so Parquet row-group min/max statistics let the
        questions' pushed filters skip row groups.
        """
        layout = WRITE_ORDER if sort_within is None else sort_within
        written = {}
        for name, df in self.tables().items():
            path = os.path.join(root, f"{name}.parquet")
            cols = layout.get(name)
            (df.sortWithinPartitions(*cols) if cols else df).write.mode(mode).parquet(path)
            written[name] = path
        return written

    def write_bucketed(self, root: str, buckets: int) -> MovieCatalog:
        """Write every table to ``root`` in ``buckets`` files by the id it is
        joined by (see ``sources.bucketed``), and return that catalog: joins on
        title ids then shuffle nothing."""
        return type(self)(**write_bucketed(self.tables(), JOIN_KEYS, root, buckets))

    @classmethod
    def from_bucketed(cls, spark: SparkSession, root: str) -> MovieCatalog:
        """The catalog that ``write_bucketed`` left under ``root``."""
        return cls(**attach_bucketed(spark, root))

    @classmethod
    def from_rows(cls, spark: SparkSession, rows: dict[str, list[tuple]]) -> MovieCatalog:
        """Build a catalog from in-memory rows (fixtures); missing tables are empty."""
        return cls(**{t: spark.createDataFrame(rows.get(t, []), schema) for t, schema in SCHEMAS.items()})


def read_tables(spark: SparkSession, root: str, fmt: str = "tsv") -> MovieCatalog:
    """The seven tables under ``root`` as a catalog; ``fmt`` is ``"tsv"``,
    ``"parquet"`` or ``"bucketed"``."""
    if fmt == "tsv":
        return MovieCatalog.from_tsv(spark, root)
    if fmt == "parquet":
        return MovieCatalog.from_parquet(spark, root)
    if fmt == "bucketed":
        return MovieCatalog.from_bucketed(spark, root)
    raise ValueError(f"unknown format {fmt!r}")
