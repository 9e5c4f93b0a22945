"""Command line: run the questions, statistics, previews or export on a catalog.

    python -m marquee questions --dumps DIR [A1 S5 ...] [--rows 20] [--no-count]
    python -m marquee statistics --dumps DIR
    python -m marquee preview --dumps DIR [--rows 5]
    python -m marquee export --dumps DIR --out DIR
    python -m marquee convert --dumps DIR --out DIR   (dumps -> Parquet, once)
    python -m marquee convert --dumps DIR --out DIR --buckets 200   (laid out by join key)
    python -m marquee audit --dumps DIR                (rows and unparsable rows per dump)
    python -m marquee explain --parquet DIR S5 M3      (physical plans; nothing runs)

``--dumps`` reads the seven tab-separated dumps (default: the current folder);
``--parquet`` reads ``<table>.parquet`` directories instead, ``--bucketed`` what
``convert --buckets`` wrote. Results are shown with ``show`` (only
the first rows reach the driver) followed by a row-count job.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from marquee.plans import movies
from marquee.session import build_session
from marquee.sources.catalog import MovieCatalog
from marquee.sources.readers import reject_count

STATISTICS = ("ST1", "ST2", "ST3", "ST4", "ST5", "ST6")


def _catalog(spark, args) -> MovieCatalog:
    if args.parquet:
        return MovieCatalog.from_parquet(spark, args.parquet)
    if args.bucketed:
        return MovieCatalog.from_bucketed(spark, args.bucketed)
    return MovieCatalog.from_tsv(spark, args.dumps)


def _show(name: str, df, rows: int, count: bool) -> None:
    doc = (getattr(movies.QUESTIONS.get(name), "__doc__", None) or "").strip().splitlines()
    print(f"---- {name}" + (f": {doc[0]}" if doc else ""))
    df.show(rows, truncate=False)  # a top-k: only the first rows are kept anywhere
    if count:
        print(f"rows: {df.count()}")  # Spark drops the sort under a count


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="marquee")
    parser.add_argument("command", choices=["questions", "statistics", "preview", "export", "convert", "audit", "explain"])
    parser.add_argument("ids", nargs="*", help="question IDs (default: all)")
    src = parser.add_mutually_exclusive_group()
    src.add_argument("--dumps", help="folder with the seven .tsv dumps (default: the current folder)")
    src.add_argument("--parquet", help="folder with <table>.parquet")
    src.add_argument("--bucketed", help="folder that convert --buckets wrote")
    parser.add_argument("--buckets", type=int, default=None, help="convert: buckets per table (default: plain Parquet)")
    parser.add_argument("--out", help="output folder for export")
    parser.add_argument("--rows", type=int, default=None)
    parser.add_argument("--no-count", action="store_true")
    parser.add_argument("--master", default=None)
    args = parser.parse_args(argv)
    if not args.parquet and not args.dumps and not args.bucketed:
        args.dumps = "."  # the dumps next to where the command runs, like the original scripts

    owned = SparkSession.getActiveSession() is None  # stop only a session this command started
    spark = build_session(master=args.master)
    cat = _catalog(spark, args)
    count = not args.no_count
    if args.command == "questions":
        ids = args.ids or [k for k in movies.QUESTIONS if k not in STATISTICS]
        for qid in ids:
            _show(qid, movies.QUESTIONS[qid](cat), args.rows or 20, count)
    elif args.command == "statistics":
        for qid in args.ids or STATISTICS:
            _show(qid, movies.QUESTIONS[qid](cat), args.rows or 20, False)
    elif args.command == "preview":
        for name, df in movies.p1_previews(cat, args.rows or 5).items():
            print(f"---- {name}")
            df.show(truncate=False)
    elif args.command == "explain":
        for qid in args.ids or list(movies.QUESTIONS):
            print(f"---- {qid}")
            movies.QUESTIONS[qid](cat).explain("formatted")
    elif args.command == "audit":
        if not args.dumps:
            parser.error("audit reads the tab-separated dumps (--dumps)")
        raw = MovieCatalog.from_tsv(spark, args.dumps, corrupt_column="_corrupt_record")
        for name, df in raw.tables().items():
            rejected = reject_count(df, "_corrupt_record").first()["rejected"]
            print(f"{name}: rows {df.count()}, rejected {rejected}")
    elif args.command == "convert":
        if not args.out:
            parser.error("convert needs --out")
        if args.buckets:
            for name in cat.write_bucketed(args.out, args.buckets).tables():
                print(f"{name} -> {args.out} in {args.buckets} buckets")
        else:
            for name, path in cat.write_parquet(args.out).items():
                print(f"{name} -> {path}")
    else:
        if not args.out:
            parser.error("export needs --out")
        for name, path in movies.x1_export(cat, args.out).items():
            print(f"{name} -> {path} ({path.rows} rows)")
    if owned:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
