import duckdb
import pytest

import __spark_entry__
from tarnlake.llm import queries

TABLES = ("documents", "pages", "labels", "embeddings")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_sql(spark, tiny, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    df = queries.QUERIES[name](spark, tiny)
    found = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*names).collect())
    assert got == sorted(repr(r) for r in found.fetchall())


def test_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
