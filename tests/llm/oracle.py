"""A query's rows beside those of its SQL counterpart, as sorted tuples."""

import duckdb

from funnelspark.llm.queries import ORACLES, QUERIES


def both(spark, folder, name, tables):
    ours = QUERIES[name](spark, folder)
    columns = sorted(ours.columns)
    got = sorted((tuple(r[c] for c in columns) for r in ours.collect()), key=repr)
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    named = [d[0] for d in cursor.description]
    assert sorted(named) == columns
    order = [named.index(c) for c in columns]
    return got, sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
