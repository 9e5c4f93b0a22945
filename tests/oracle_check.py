"""Compare a registered Spark query with its DuckDB oracle.

Columns are matched by name, rows as an order-insensitive multiset, values
exactly (no rounding): the bindings are written so both engines produce the
same values bit for bit.

    python -m tests.oracle_check [sf_dir] [ID ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

from marquee.sources.star import STAR_TABLES

# Spark simple type -> DuckDB type name it must match.
TYPE_MATCH = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in STAR_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t + '.parquet')}')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()))
    if isinstance(v, float):
        return ("num", v)
    if isinstance(v, (list, tuple)):
        return ("list", tuple(_norm(x) for x in v))
    if isinstance(v, (dt.datetime, dt.date)):
        return ("time", v.isoformat())
    return (type(v).__name__, v)


def _rows(names, rows, order):
    idx = [names.index(n) for n in order]
    return sorted((tuple(_norm(r[i]) for i in idx) for r in rows), key=repr)


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    d_names = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    d_types = {d[0]: str(d[1]) for d in rel.description}
    s_names = df.columns
    result = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows), "spark_sec": round(t1 - t0, 3)}
    if sorted(s_names) != sorted(d_names):
        result["error"] = f"columns differ: spark={s_names} oracle={d_names}"
        return result
    type_errors = []
    for f in df.schema.fields:
        want = TYPE_MATCH.get(f.dataType.simpleString())
        if want and d_types[f.name] != want:
            type_errors.append(f"{f.name}: spark {f.dataType.simpleString()} vs duckdb {d_types[f.name]}")
    if type_errors:
        result["error"] = "types differ: " + "; ".join(type_errors)
        return result
    order = sorted(s_names)
    a, b = _rows(s_names, s_rows, order), _rows(d_names, d_rows, order)
    if a != b:
        diff = [x for x in a if x not in b][:3], [x for x in b if x not in a][:3]
        result["error"] = f"values differ; spark-only {diff[0]} oracle-only {diff[1]}"
    return result


def main(argv: list[str]) -> int:
    from marquee.plans import registry
    from marquee.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(registry.QUERIES)
    spark = build_session(master="local[*]", shuffle_partitions=8)
    con = duck(sf_dir)
    sql = registry.oracle_sql()
    bad = 0
    for name in wanted:
        try:
            r = compare(spark, name, registry.QUERIES[name], sql[name], sf_dir, con)
        except Exception as exc:  # report and continue
            r = {"name": name, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        bad += "error" in r
        print(("FAIL " if "error" in r else "ok   ") + str(r), flush=True)
    print(f"{len(wanted) - bad}/{len(wanted)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
