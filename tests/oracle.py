"""Comparison of a query with its SQL on the same tables."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def value(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return "null"
    if isinstance(v, str):
        return v
    if str(v) in ("True", "False"):
        return str(v)
    number = float(v)
    return str(int(number)) if number == int(number) else repr(round(number, 9))


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(value(v) for v in r) for r in frame.itertuples(index=False))


def assert_same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got), rows(want)
    assert len(a) == len(b)
    differ = [(x, y) for x, y in zip(a, b) if x != y][:3]
    assert not differ, differ
