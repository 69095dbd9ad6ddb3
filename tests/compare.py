"""Run queries against their SQL on a second engine: ``python tests/compare.py [names]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normalized(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind in "iub" and not df[c].hasnans:
            df[c] = df[c].astype("int64")
        elif df[c].dtype.kind in "iubf":
            df[c] = df[c].astype("float64")
        else:
            df[c] = df[c].map(lambda v: "\0" if v is None or v is pd.NA else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} / {sorted(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} / {len(sql_df)}"
    a, b = normalized(spark_df), normalized(sql_df)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = same.idxmin()
            return f"{c}: {(~same).sum()} of {len(a)} differ, first\n  {a.loc[i].to_dict()}\n  {b.loc[i].to_dict()}"
    return None


def main() -> None:
    import __spark_entry__ as e
    from ratingloom.sources.session import local_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con, sql = local_session(os.environ.get("CPUS", "8")), connect(folder), e.oracle_sql()
    names = sys.argv[1:] or list(e.queries())
    for name in names:
        start = time.time()
        try:
            got = e.queries()[name](spark, folder).toPandas()
            mid = time.time()
            if name in sql:
                want = con.execute(sql[name]).df()
                diff = difference(got, want)
                print(f"{name:32s} {'ok' if diff is None else 'DIFF ' + diff} rows={len(got)} spark={mid-start:.1f}s sql={time.time()-mid:.1f}s", flush=True)
            else:
                print(f"{name:32s} rows-only rows={len(got)} spark={mid-start:.1f}s", flush=True)
        except Exception as ex:  # noqa: BLE001
            print(f"{name:32s} ERROR {type(ex).__name__} {str(ex)[:600]}", flush=True)


if __name__ == "__main__":
    main()
