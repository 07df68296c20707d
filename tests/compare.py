"""Run queries against their SQL counterparts in DuckDB.

    python tests/compare.py sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def normal(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, decimal.Decimal)):
        return float(v) if isinstance(v, decimal.Decimal) else int(v)
    if isinstance(v, float):
        return round(v, 9) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = [tuple(normal(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(keyed, key=repr)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def kind_of_spark(t) -> str:
    name = t.simpleString()
    return "decimal" if name.startswith("decimal") else name


DUCK_KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "HUGEINT": "hugeint",
}


def compare(spark, con, name, query, sql, sf_dir):
    """Problem text, or None if both sides agree."""
    df = query(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    want_cols, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    kinds = {
        f.name: (kind_of_spark(f.dataType), DUCK_KINDS.get(types[f.name], types[f.name]))
        for f in df.schema.fields
    }
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference:\n  spark {a}\n  sql   {b}"
    odd = {c: k for c, k in kinds.items() if k[0] != k[1] and not k[1].startswith("DECIMAL")}
    return f"types {odd}" if odd else None


def main() -> int:
    from exercises.oracle import ORACLE
    from exercises.queries import REGISTRY
    from strataflow.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    sf_dir = f"{os.environ.get('TESTDATA', '/root/testdata')}/{sf}"
    names = sys.argv[2:] or list(REGISTRY)
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLE:
                problem = compare(spark, con, name, REGISTRY[name], ORACLE[name], sf_dir)
            else:
                problem = f"no SQL; {REGISTRY[name](spark, sf_dir).count()} rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:800]}"
        bad += problem is not None
        print(f"{name:26s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
