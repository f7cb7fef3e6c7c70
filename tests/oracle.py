"""Comparison of a query with its SQL in DuckDB, whatever the order of rows and columns."""

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if isinstance(v, (list, np.ndarray)):
            return str(list(v))
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and np.isnan(v):
            return "~"
        return repr(round(float(v), 9)) if isinstance(v, (int, float, np.integer, np.floating)) and not isinstance(v, (bool, np.bool_)) else str(v)

    names = sorted(df.columns)
    return sorted(tuple(map(cell, row)) for row in df[names].itertuples(index=False, name=None))


def assert_same(query, sql: str, spark, sf_dir: str) -> None:
    ours, theirs = query(spark, sf_dir).toPandas(), connection(sf_dir).sql(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours) == plain(theirs)
