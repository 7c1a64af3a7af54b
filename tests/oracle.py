"""Comparison of a query's rows with DuckDB's over the same tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def differences(spark, query, sql: str, sf_dir: str = "/root/testdata/sf0.001") -> list:
    """Columns, types or rows in which both differ."""
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    found = con.sql(sql)
    if sorted(found.columns) != names:
        return [names, found.columns]
    types = dict(zip(found.columns, map(str, found.types)))
    wrong = [(c, t, types[c]) for c, t in df.dtypes if TYPES.get(t, t) != types[c]]
    mine = sorted(repr(tuple(r)) for r in df.select(*names).collect())
    theirs = sorted(map(repr, found.project(", ".join(f'"{n}"' for n in names)).fetchall()))
    return wrong + [x for x in zip(mine, theirs) if x[0] != x[1]][:3] + ([(len(mine), len(theirs))] if len(mine) != len(theirs) else [])
