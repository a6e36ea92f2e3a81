"""Row-for-row comparison of a query with its SQL in DuckDB."""

import glob
import os
from collections import Counter


def flat(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple((k, flat(x)) for k, x in sorted(v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(map(flat, v))
    return str(v) if hasattr(v, "tzinfo") else v


def connect(d):
    import duckdb

    c = duckdb.connect()
    for p in glob.glob(f"{d}/*.parquet"):
        src = f"{p}/*.parquet" if os.path.isdir(p) else p
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{src}')")
    return c


def same(spark, d, query, sql):
    df = query(spark, d)
    cols = sorted(df.columns)
    got = Counter(tuple(flat(r[c]) for c in cols) for r in df.collect())
    res = connect(d).execute(sql)
    names = [x[0] for x in res.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = Counter(tuple(flat(r[i]) for i in at) for r in res.fetchall())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
