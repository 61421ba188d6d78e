"""Rows of a Spark query and of its DuckDB twin, made comparable."""

import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(d):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 9) + 0.0
    return x if x is None or isinstance(x, (int, bool)) else str(x)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(v[k]) for k in order) for v in values), key=str)
