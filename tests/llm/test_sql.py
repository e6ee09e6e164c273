"""The queries that SQL can express equal their DuckDB SQL, at sf0.001."""
import json

import duckdb
import pytest

from wardline.llm import queries

SF = "/root/testdata/sf0.001"


def lines(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(json.dumps([round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order]) for r in rows)


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert lines(df.columns, [tuple(r) for r in df.collect()]) == lines(cols, res.fetchall())
