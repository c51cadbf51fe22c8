"""Run queries next to their SQL and compare values, column by column.

python tests/oracle.py [scale folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if str(frame[c].dtype).startswith("datetime"):
            frame[c] = frame[c].astype("datetime64[us]").astype(str)
        elif frame[c].dtype == object:
            frame[c] = frame[c].map(lambda v: None if v is None or v is pd.NaT else str(v))
    return frame.sort_values(list(frame.columns), na_position="first", kind="stable").reset_index(drop=True)


def compare(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    a, b = normal(spark_frame), normal(sql_frame)
    for c in a.columns:
        kinds = [x.dtype.kind if hasattr(x.dtype, "kind") else "O" for x in (a[c], b[c])]
        left, right = ([None if pd.isna(v) else v for v in x[c].tolist()] for x in (a, b))
        wrong = [(x, y) for x, y in zip(left, right) if x != y]
        if wrong:
            return f"{c}: {len(wrong)} differ, first {wrong[:3]} kinds {kinds}"
        if set(kinds) in ({"f", "i"}, {"f", "O"}, {"i", "O"}, {"b", "i"}) and not a[c].isna().any():
            return f"{c}: types {a[c].dtype} / {b[c].dtype}"
    return None


def main() -> int:
    from millrace.session import local_session
    from millrace.suite import registry

    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    registry.load()
    names = args or list(registry.QUERIES)
    spark = local_session("oracle")
    con = connect(folder)
    bad = 0
    for name in names:
        begin = time.time()
        try:
            got = registry.QUERIES[name](spark, folder)
            schema = got.dtypes
            got = got.toPandas()
            spent = time.time() - begin
            if name in registry.ORACLES:
                want = con.execute(registry.ORACLES[name]).df()
                problem = compare(got, want)
                verdict = "ok" if problem is None else "DIFF " + problem
            else:
                verdict = "rows only"
            if len(got) == 0:
                verdict += " EMPTY"
        except Exception as error:  # report and go on with the next query
            verdict, spent, got, schema = "ERROR " + str(error)[:700], time.time() - begin, [], []
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += verdict.startswith(("DIFF", "ERROR")) or "EMPTY" in verdict
        print(f"{name:32s} {spent:6.2f}s {len(got):7d} {verdict}", flush=True)
        if os.environ.get("SHOW"):
            print(schema, got.head(3) if len(got) else got, sep="\n")
    print(f"{len(names)} run, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
