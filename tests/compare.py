"""Run registered queries against DuckDB: python tests/compare.py [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, (Decimal, float)):
        return None if math.isnan(v) else float(v)
    return v


# DuckDB type -> Spark type, for the types the queries return.
TYPES = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def type_differences(df, con, sql: str) -> str | None:
    wanted = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in con.execute(sql).description}
    wrong = [f"{c}: {t} vs {wanted[c]}" for c, t in df.dtypes if c in wanted and wanted[c] != t]
    return "types " + ", ".join(wrong) if wrong else None


def differences(spark_rows, spark_cols, con, sql: str) -> str | None:
    result = con.execute(sql)
    cols = [d[0] for d in result.description]
    if sorted(cols) != sorted(spark_cols):
        return f"columns {sorted(spark_cols)} vs {sorted(cols)}"
    order = sorted(cols)

    def normalized(rows, names):
        at = [names.index(c) for c in order]
        return sorted((tuple(_plain(r[i]) for i in at) for r in rows), key=repr)

    mine, theirs = normalized(spark_rows, spark_cols), normalized(result.fetchall(), cols)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows vs {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} of {len(mine)} rows differ, first {order} {wrong[0]}" if wrong else None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tenderlake.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    spark, con, oracle = local_session(8), database(sf_dir), oracle_sql()
    for name, run in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - started
            bad = "(rows only)"
            if name in oracle:
                bad = differences(rows, df.columns, con, oracle[name]) or type_differences(df, con, oracle[name])
            print(f"{name:28s} {took:6.2f}s {len(rows):7d} rows  {bad or 'ok'}", flush=True)
        except Exception as error:  # noqa: BLE001
            print(f"{name:28s} FAILED {type(error).__name__}: {str(error)[:600]}", flush=True)
