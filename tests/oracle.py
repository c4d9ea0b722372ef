"""Runs a query and its SQL on the same tables and compares rows."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for t in TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return c


def compare(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    rows, columns = df.collect(), df.columns
    out = duck(sf_dir).sql(sql)
    assert sorted(columns) == sorted(out.columns)
    a = sorted(tuple(repr(r[columns.index(c)]) for c in sorted(columns)) for r in rows)
    b = sorted(tuple(repr(r[out.columns.index(c)]) for c in sorted(columns)) for r in out.fetchall())
    assert len(a) == len(b)
    assert a == b
