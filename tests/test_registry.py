import hashlib
import re

import duckdb
import pytest

import __spark_entry__
from tarnlake.functions.pii import PATTERNS
from tarnlake.plans import jobs, operations, registry  # noqa: F401  (they register their queries)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees_with_sql(spark, tiny, duck, name):
    df = registry.QUERIES[name](spark, tiny)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*cols).collect())
    found = duck.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(repr(tuple(r[i] for i in at)) for r in found.fetchall())


def test_pii_queries_cover_every_pattern(spark, tmp_path):
    texts = ["ssn 123-45-6789 here", "not 000-12-3456 666-12-3456 912-12-3456 123-00-4567 123-45-0000", "x@y.org 10.0.0.1", "4111111111111111"]
    texts += ["call 212-555-0199", "+971-50-123-4567", "784-1990-1234567-1", "665-01-0001 and 899-99-1000", None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    run = lambda name: registry.QUERIES[name](spark, str(tmp_path)).collect()
    hits = {n: sum(re.search(p.regex, x or "", re.A) is not None for x in texts) for n, p in PATTERNS.items()}
    assert {r.pii_type: r.matches for r in run("pii_scan")} == hits and hits["ssn"] == 2 and min(hits.values()) > 0
    assert [r.sensitivity for r in run("pii_classify")] == [5]
    want = {}
    for i, x in enumerate(texts):
        for p in PATTERNS.values():
            x = x and re.sub(p.regex, p.mask, x, flags=re.A)
        want[i] = None if x is None else hashlib.md5(x.encode()).hexdigest()
    assert {r.doc_id: r.masked for r in run("pii_mask_all")} == want
    sql = registry.ORACLE_SQL["pii_mask_all"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert dict(duckdb.connect().execute(sql).fetchall()) == want


def test_pii_classify_sees_a_lone_ssn(spark, tmp_path):
    spark.createDataFrame([(1, "x@y.org"), (2, "123-45-6789")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    (r,) = registry.QUERIES["pii_classify"](spark, str(tmp_path)).collect()
    assert (r.classification, r.sensitivity) == ("financial", 5)


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert rows and rows[0].total_leads > 10
    assert set(registry.QUERIES) <= set(__spark_entry__.queries()) and set(registry.ORACLE_SQL) <= set(__spark_entry__.oracle_sql())
