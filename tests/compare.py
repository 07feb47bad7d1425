"""Run queries beside their SQL and compare rows, names and values.

``python tests/compare.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _plain(v):
    if isinstance(v, (decimal.Decimal, int)) and not isinstance(v, bool):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v + 0.0:.10g}" if v else "0"
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return repr(v)


def as_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf: str, name: str, queries, oracle) -> str | None:
    """None when equal, else what differs."""
    df = queries[name](spark, sf)
    got = as_rows(df.columns, df.collect())
    if name not in oracle:
        return None if got else "no rows"
    rel = con.sql(oracle[name])
    want = as_rows(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    if not want and not got:
        return "the statement gives no rows"
    if got == want:
        kinds = {"bigint": "BIGINT", "double": "DOUBLE", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
        types = dict(zip(rel.columns, map(str, rel.types)))
        odd = [(f.name, f.dataType.simpleString(), types[f.name]) for f in df.schema.fields if kinds.get(f.dataType.simpleString()) != types[f.name]]
        odd = [o for o in odd if o[1] not in ("timestamp", "timestamp_ntz")]
        return f"types {odd}" if odd else None
    only_got = [r for r in got if r not in set(want)]
    only_want = [r for r in want if r not in set(got)]
    return f"{len(got)} rows, {len(want)} wanted; only here {only_got[:3]}; only there {only_want[:3]}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from veloflow.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf)
    bad = 0
    for name in names:
        started = time.perf_counter()
        try:
            problem = compare(spark, con, sf, name, queries(), oracle_sql())
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        spark.catalog.clearCache()
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name:28s} {time.perf_counter() - started:6.1f}s {'' if name in oracle_sql() else '(rows only)'} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} fine")
    return bad


if __name__ == "__main__":
    sys.exit(main())
