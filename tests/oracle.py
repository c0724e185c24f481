"""Compare registered queries with their SQL twins: ``python tests/oracle.py [sf_dir] [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _ordered(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(by=list(df.columns), na_position="first").reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}"
    got, want = _ordered(got), _ordered(want)
    for c in got.columns:
        a, b = got[c], want[c]
        if a.isna().any() or b.isna().any():  # integers with nulls come in several types
            a, b = (x.astype("float64") if x.dtype.kind in "iuf" else x for x in (a, b))
        if a.dtype.kind in "iuf" and b.dtype.kind in "iuf":
            if a.dtype.kind != b.dtype.kind or a.dtype.itemsize != b.dtype.itemsize:
                return f"{c}: types {a.dtype} and {b.dtype}"
            bad = ~((a == b) | (a.isna() & b.isna()))
        else:
            bad = ~((a.astype(str) == b.astype(str)) | (a.isna() & b.isna()))
        if bad.any():
            at = bad.idxmax()
            return f"{c}: {int(bad.sum())} values, first {a[at]!r} and {b[at]!r}"
    return None


if __name__ == "__main__":
    from conftest import make_session

    import __spark_entry__ as reg

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    session, con, sqls = make_session(), connect(folder), reg.oracle_sql()
    for name, query in reg.queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            got = query(session, folder).toPandas()
            spent = time.time() - t
            if name not in sqls:
                print(f"{name:24s} rows {len(got):7d} {spent:6.1f}s", flush=True)
                continue
            t = time.time()
            verdict = difference(got, con.execute(sqls[name]).df()) or "ok"
            print(f"{name:24s} rows {len(got):7d} {spent:6.1f}s sql {time.time() - t:5.1f}s {verdict}", flush=True)
        except Exception as error:  # report and go on with the next query
            print(f"{name:24s} FAILED {str(error)[:600]}", flush=True)
