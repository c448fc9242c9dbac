"""Compare queries with their SQL on DuckDB, as sets of rows."""

import math
import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v + 0.0, 9)
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    return v


def same(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    out = connect(sf_dir).sql(sql)
    names = sorted(df.columns)
    assert names == sorted(out.columns), (names, sorted(out.columns))
    ours = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str)
    order = [list(out.columns).index(c) for c in names]
    theirs = sorted((tuple(plain(r[i]) for i in order) for r in out.fetchall()), key=str)
    assert len(ours) == len(theirs), (len(ours), len(theirs))
    bad = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    assert not bad, (len(bad), bad[:3])
    return len(ours)
