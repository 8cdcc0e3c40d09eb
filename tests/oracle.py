"""Compare registered queries with their SQL on DuckDB. Also usable from the command line:

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, (list, np.ndarray)):
        return tuple(_cell(x) for x in v)
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return int(v)
    if isinstance(v, (float, np.floating)):
        return round(float(v), 9)
    if isinstance(v, (pd.Timestamp, np.datetime64)):
        return str(pd.Timestamp(v))
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    return v


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    return sorted((tuple(_cell(v) for v in row) for row in pdf.itertuples(index=False, name=None)), key=repr)


def difference(spark, con, sf_dir: str, name: str, query, sql: str | None) -> tuple[str | None, int]:
    """What differs (None when nothing), and the number of rows."""
    mine = query(spark, sf_dir).toPandas()
    if sql is None:
        return None, len(mine)
    theirs = con.execute(sql).fetchdf()
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} != {sorted(theirs.columns)}", len(mine)
    a, b = canonical(mine), canonical(theirs)
    if a != b:
        in_a, in_b = set(a), set(b)
        only_a, only_b = [r for r in a if r not in in_b][:3], [r for r in b if r not in in_a][:3]
        return f"{len(a)} vs {len(b)} rows; only mine {only_a}; only SQL {only_b}", len(a)
    return None, len(a)


def main() -> None:
    from tidegauge.registry import ORACLES, QUERIES
    from tidegauge.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in names:
        t = time.time()
        try:
            diff, rows = difference(spark, con, sf_dir, name, QUERIES[name], ORACLES.get(name))
        except Exception as e:  # keep going: the list of failures is the result
            diff, rows = "".join(traceback.format_exception_only(e))[:600], -1
        bad += diff is not None
        kind = "" if name in ORACLES else " (no SQL)"
        print(f"{'FAIL' if diff else 'ok':4} {name}{kind} rows={rows} {time.time() - t:.1f}s {diff or ''}", flush=True)
    print(f"{len(names)} queries, {bad} failures")


if __name__ == "__main__":
    main()
