"""Run registered queries and their SQL side by side: rows, column types and values.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark result and the SQL result; empty when nothing does."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    kinds = dict(zip(relation.columns, map(str, relation.types), strict=True))
    out = []
    if names != sorted(relation.columns):
        return [f"columns {names} != {sorted(relation.columns)}"]
    for f in df.schema.fields:
        if KINDS.get(f.dataType.simpleString()) != kinds[f.name]:
            out.append(f"type of {f.name}: {f.dataType.simpleString()} != {kinds[f.name]}")
    left = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    right = relation.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall()
    right = sorted(right, key=_key)
    if len(left) != len(right):
        out.append(f"rows {len(left)} != {len(right)}")
    wrong = [(a, b) for a, b in zip(left, right, strict=False) if a != b]
    close = sum(1 for a, b in wrong if all(_close(x, y) for x, y in zip(a, b, strict=True)))
    if wrong:
        out.append(f"{len(wrong)} rows differ ({close} only in the last digits), e.g. {names} {wrong[0]}")
    return out


def _close(x, y) -> bool:
    if isinstance(x, float) and isinstance(y, float):
        return math.isclose(x, y, abs_tol=2e-3)
    return x == y


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry

    from tidemark.session import get_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = get_session("compare", "local[8]", 8, spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in sql:
                found = differences(df, con, sql[name])
                note = "same" if not found else "; ".join(found)
                bad += bool(found)
            else:
                note = f"rows only: {df.collect()[:2]}"
        except Exception as error:  # noqa: BLE001
            bad += 1
            note = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{bad} with differences; SQL without query: {sorted(set(sql) - set(entry.queries()))}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
