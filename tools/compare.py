"""Run queries and their SQL side by side: compare.py SF_DIR [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadenza.oracles import ORACLES  # noqa: E402
from cadenza.queries import QUERIES  # noqa: E402
from cadenza.session import local_session  # noqa: E402


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]")
        elif df[c].dtype == object or str(df[c].dtype).startswith("str"):
            df[c] = df[c].astype(object).where(df[c].notna(), None)
    return df.sort_values(list(df.columns), ignore_index=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = int((~same).to_numpy().nonzero()[0][0])
            return f"{c}: {int((~same).sum())} differ, e.g. {a.loc[i].to_dict()} / {b.loc[i].to_dict()}"
        if str(a[c].dtype) != str(b[c].dtype):
            return f"{c}: type {a[c].dtype} / {b[c].dtype}"
    return ""


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def main(sf_dir: str, names: list[str]) -> int:
    spark, db, failures = local_session(8), database(sf_dir), 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in ORACLES:
                print(f"rows-only {name} {len(got)} rows {took:.1f}s", flush=True)
                continue
            start = time.time()
            want = db.execute(ORACLES[name]).fetchdf()
            problem = differences(got, want)
        except Exception as error:  # report and go on
            problem, took = f"{type(error).__name__}: {str(error)[:700]}", time.time() - start
            got = []
        failures += bool(problem)
        print(f"{'FAIL' if problem else 'ok'} {name} {len(got)} rows {took:.1f}s sql {time.time() - start:.1f}s {problem}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
