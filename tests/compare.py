"""Run catalog queries in Spark and their check SQL in DuckDB, and compare the rows.

    python -m tests.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels".split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime64"):
            df[c] = df[c].astype("datetime64[us]").astype("string")
        elif df[c].dtype == bool or str(df[c].dtype) == "boolean":
            df[c] = df[c].astype("string").str.lower()
        elif pd.api.types.is_numeric_dtype(df[c]):
            df[c] = df[c].astype("float64") + 0.0
        else:
            df[c] = df[c].map(lambda v: None if v is None or v is pd.NaT or v is np.nan else str(v)).astype("string")
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    mine = _canonical(spark_df.toPandas())
    theirs = _canonical(con.execute(sql).fetchdf())
    if list(mine.columns) != list(theirs.columns):
        return f"columns {list(mine.columns)} against {list(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for c in mine.columns:
        a, b = mine[c], theirs[c]
        if a.dtype == "float64" or b.dtype == "float64":
            unequal = ~((a == b) | (a.isna() & b.isna()))
        else:
            unequal = ~((a.fillna("\0") == b.fillna("\0")))
        if unequal.any():
            i = unequal.idxmax()
            return f"{int(unequal.sum())} of {len(mine)} rows differ in {c}; first: {mine.loc[i].to_dict()} / {theirs.loc[i].to_dict()}"
    return None if len(mine) else "equal, but both are empty"


def main(argv: list[str]) -> int:
    from gridloom.catalog import CHECKS, QUERIES
    from gridloom.session import build_session

    folder, names = argv[0], argv[1:] or list(QUERIES)
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "compare", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name in names:
        begun = time.time()
        try:
            result = QUERIES[name](spark, folder)
            if name in CHECKS:
                note = difference(result, con, CHECKS[name])
            else:
                note = f"rows only: {result.count()}"
        except Exception as error:  # noqa: BLE001 - reported per query
            note = f"{type(error).__name__}: {str(error)[:1500]}"
        wrong = bool(note) and not note.startswith("rows only")
        bad += wrong
        print(f"{'BAD ' if wrong else 'ok  '}{name} {time.time() - begun:.1f}s {note or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
