"""Compare a query's rows with those of its SQL."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def cells(row):
    out = []
    for x in row:
        if x is None or isinstance(x, float) and math.isnan(x):
            out.append("null")
        else:
            out.append(f"{x:.6f}" if isinstance(x, float) else str(x))
    return tuple(out)


def run_sql(sql, views=None):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    for name, table in (views or {}).items():
        con.register("_new", table)
        con.execute(f"CREATE OR REPLACE TABLE own_{name} AS SELECT * FROM _new")
        con.execute(f"DROP VIEW IF EXISTS {name}")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM own_{name}")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(cells([r[i] for i in order]) for r in cur.fetchall())


def run_spark(df):
    names = sorted(df.columns)
    return names, sorted(cells(r) for r in df.select(*names).collect())


def same(df, sql, views=None):
    (a, rows_a), (b, rows_b) = run_spark(df), run_sql(sql, views)
    assert a == b
    assert len(rows_a) == len(rows_b)
    assert rows_a == rows_b
