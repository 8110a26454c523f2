"""Run registered Spark queries and their SQL statements side by side on DuckDB and compare.

Same check as the driver's: row count, column names, order-insensitive value hash.
Usage: python -m tests.oracle_compare [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    if isinstance(v, dict):
        return {k: _norm(x) for k, x in sorted(v.items())}
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr([_norm(r[i]) for i in order]) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


SPARK_TO_SQL = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
                "StringType()": "VARCHAR", "DateType()": "DATE", "BooleanType()": "BOOLEAN",
                "TimestampNTZType()": "TIMESTAMP", "ShortType()": "SMALLINT", "FloatType()": "FLOAT"}


def compare(spark, con, name: str, sf_dir: str) -> dict:
    from __spark_entry__ import oracle_sql, queries
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    sql = oracle_sql().get(name)
    if sql is None:
        out["oracle"] = "none"
        return out
    rel = con.sql(sql)
    otypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    ocols = list(rel.columns)
    orows = rel.fetchall()
    stypes = {f.name: SPARK_TO_SQL.get(repr(f.dataType), repr(f.dataType)) for f in sdf.schema.fields}
    out["types_match"] = stypes == otypes
    if not out["types_match"]:
        out["types"] = {c: (stypes.get(c), otypes.get(c)) for c in set(stypes) | set(otypes) if stypes.get(c) != otypes.get(c)}
    out.update(oracle_rows=len(orows), cols_match=sorted(scols) == sorted(ocols),
               hash_match=digest(scols, srows) == digest(ocols, orows))
    if not out["cols_match"]:
        out["cols"] = (sorted(scols), sorted(ocols))
    if not out["hash_match"] and len(srows) < 400:
        so = sorted(range(len(scols)), key=lambda i: scols[i])
        oo = sorted(range(len(ocols)), key=lambda i: ocols[i])
        a = sorted(repr([_norm(r[i]) for i in so]) for r in srows)
        b = sorted(repr([_norm(r[i]) for i in oo]) for r in orows)
        out["only_spark"] = [x for x in a if x not in b][:5]
        out["only_oracle"] = [x for x in b if x not in a][:5]
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from metricwatch.session import get_spark
    from __spark_entry__ import queries
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark = get_spark()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and go on
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("hash_match", r.get("oracle") == "none") and r.get("types_match", True) and "error" not in r
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
