"""Comparison of a DataFrame with DuckDB SQL over the same tables."""

import glob
import os

import duckdb


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return value


def same_as_duckdb(frame, sql, sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{files}')")
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    order = [frame.columns.index(n) for n in sorted(names)]
    theirs = sorted((tuple(plain(r[names.index(n)]) for n in sorted(names)) for r in result.fetchall()), key=str)
    ours = sorted((tuple(plain(r[i]) for i in order) for r in frame.collect()), key=str)
    assert ours == theirs
