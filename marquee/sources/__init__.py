"""Sources and sinks: declared-schema TSV/Parquet readers, the typed catalog,
the star-schema test tables and CSV export."""

from marquee.sources.bucketed import attach_bucketed, bucket_files, detach_bucketed, write_bucketed
from marquee.sources.catalog import MovieCatalog, read_tables
from marquee.sources.readers import TSV_OPTIONS, read_parquet, read_tsv, reject_count, rejected_rows
from marquee.sources.sinks import Published, counted, csv_ready, export_csv, published, read_published
from marquee.sources.star import STAR_TABLES, StarTables

__all__ = [
    "attach_bucketed",
    "bucket_files",
    "detach_bucketed",
    "write_bucketed",
    "MovieCatalog",
    "read_tables",
    "TSV_OPTIONS",
    "read_parquet",
    "read_tsv",
    "reject_count",
    "rejected_rows",
    "Published",
    "counted",
    "csv_ready",
    "export_csv",
    "published",
    "read_published",
    "STAR_TABLES",
    "StarTables",
]
