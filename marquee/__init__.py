"""marquee — Spark-native analytics over title / people / ratings catalogs.

Layout:
    marquee.session     session defaults and the shared folder
    marquee.schemas     the seven declared table schemas
    marquee.sources     TSV / Parquet readers, the typed catalog, CSV export
    marquee.functions   Column -> Column helpers (list columns, bins, years, exact means)
    marquee.operators   DataFrame -> DataFrame operators the questions reduce to
    marquee.plans       the business questions (movie catalog) and their
                        star-schema bindings with DuckDB oracle SQL
    marquee.streaming   intentionally empty: the source project has no streams

Every query is a lazy function returning a DataFrame; actions belong to callers.
"""

__version__ = "0.1.0"
