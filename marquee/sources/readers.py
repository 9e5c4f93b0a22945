"""Declared-schema readers for tab-separated dumps and Parquet.

TSV options (fixed values): header row, tab separator, ``\\N`` as NULL, and
quoting turned off. The dumps do not quote fields, and Spark's default quote
character lets a stray leading ``"`` swallow the following tabs, shifting a
row's columns to NULL; ``quote=""`` reads such rows as written.

Malformed numbers become NULL (PERMISSIVE). Pass ``corrupt_column`` to keep
the raw line of such rows for auditing; the column is appended to the schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Reader options for the tab-separated dumps.
TSV_OPTIONS: dict[str, str] = {
    "header": "true",
    "sep": "\t",
    "nullValue": "\\N",
    "quote": "",
    "mode": "PERMISSIVE",
}


def read_tsv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    corrupt_column: str | None = None,
    **options: str,
) -> DataFrame:
    """Read one tab-separated dump with a declared schema (never inferred)."""
    opts = dict(TSV_OPTIONS, **options)
    if corrupt_column:
        schema = StructType(list(schema.fields) + [StructField(corrupt_column, StringType(), True)])
        opts["columnNameOfCorruptRecord"] = corrupt_column
    return spark.read.options(**opts).schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read Parquet; with a schema, columns are selected and cast to it."""
    df = spark.read.parquet(path)
    if schema is None:
        return df
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def rejected_rows(df: DataFrame, corrupt_column: str) -> DataFrame:
    """Rows of a ``read_tsv(..., corrupt_column=...)`` frame that did not parse,
    with every column. Count them with ``reject_count``.

    The CSV reader parses only the columns a query uses, so a row is known to
    be malformed only when every declared column is parsed (Spark also refuses
    queries that use the corrupt-record column alone).
    """
    return df.filter(F.col(corrupt_column).isNotNull())


def reject_count(df: DataFrame, corrupt_column: str) -> DataFrame:
    """The number of malformed rows as a one-row DataFrame (column ``rejected``).

    Counting ``when(corrupt IS NOT NULL, struct(all data columns))`` makes the
    scan parse every declared column, which is what flags a row as malformed.
    """
    data = [c for c in df.columns if c != corrupt_column]
    flagged = F.when(F.col(corrupt_column).isNotNull(), F.struct(*data))
    return df.groupBy().agg(F.count(flagged).alias("rejected"))
