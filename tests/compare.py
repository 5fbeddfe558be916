"""Exact comparison of a Spark result with its DuckDB oracle."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(path: str, inside: str = "") -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet{inside}'")
    return con


def _kind(arrow_type) -> str:
    text = str(arrow_type)
    return "string" if text in ("string", "large_string") else text


def _norm(value):
    import math
    from decimal import Decimal

    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, Decimal):
        return str(value.normalize())
    if isinstance(value, (list, tuple)):
        return [_norm(v) for v in value]
    if isinstance(value, dict):
        return sorted((k, _norm(v)) for k, v in value.items())
    return repr(value)


def compare(df, con, sql: str) -> str | None:
    """None when equal, otherwise a short description of the difference."""
    got = df.toArrow()
    want = con.execute(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"
    names = sorted(got.column_names)
    kinds = [(n, _kind(got.schema.field(n).type), _kind(want.schema.field(n).type)) for n in names]
    bad = [k for k in kinds if k[1] != k[2]]
    if got.num_rows != want.num_rows:
        return f"rows {got.num_rows} != {want.num_rows}"
    if bad:
        return f"types {bad}"
    rows = lambda t: sorted(tuple(_freeze(_norm(r[n])) for n in names) for r in t.select(names).to_pylist())
    a, b = rows(got), rows(want)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(diff)} rows differ, first {names}: {diff[0]}"
    return None


def _freeze(v):
    return repr(v)


def main(path: str, patterns: list[str]) -> int:
    sys.path.insert(0, ".")
    from storeops.plans import CATALOGUE
    from storeops.session import local_session

    spark = local_session()
    con = connect(path)
    failed = 0
    for name, q in CATALOGUE.items():
        if patterns and not any(name == p or name.startswith(p) for p in patterns):
            continue
        start = time.time()
        try:
            df = q.run(spark, path)
            if q.sql is None:
                n = df.count()
                print(f"rows  {name} {n} {time.time() - start:.2f}s", flush=True)
                continue
            problem = compare(df, con, q.sql)
            n = con.execute(f"select count(*) from ({q.sql})").fetchone()[0] if problem is None else -1
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:900]}"
        if problem:
            failed += 1
            print(f"FAIL  {name}: {problem}", flush=True)
        else:
            print(f"ok    {name} rows={n}{' EMPTY' if n == 0 else ''} {time.time() - start:.2f}s", flush=True)
    print(f"failed {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
