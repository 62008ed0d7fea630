"""Row-by-row comparison of a Spark result with DuckDB's answer."""

import glob
import os

import duckdb


def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(r[i] for i in order) for r in rows], key=repr)


def assert_same(df, con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    want = _rows(names, result.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(got) == len(want), f"{len(got)} rows, expected {len(want)}"
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, f"{len(different)} rows differ, first: {different[0]}"
