"""Nulls, empty and very long texts, repeated rows, no rows and clashing names
in the operators on documents."""

import random

import pytest
from pyspark.sql import functions as F

from tarnlake.llm.bpe import decode_documents, encode_documents
from tarnlake.llm.lines import dedup_lines
from tarnlake.llm.packing import pack_documents
from tarnlake.llm.quality import compression_quality
from tarnlake.llm.simhash import near_duplicate_components, near_duplicate_groups

RND = random.Random(12)
LONG = " ".join(f"w{RND.randint(0, 9999)}" for _ in range(150_000)) + "\n" + "line\n" * 20_000
TEXTS = [(None, None), (None, "a b"), (1, None), (1, ""), (2, "x y z"), (2, "x y z"), (2, "x y z!"), (3, LONG), (3, LONG), (4, " \n\t "), (5, "e\u0301 \U0001f642")]
CLASH = ["id", "key", "row", "spans", "fp", "_tk", "_id", "piece", "part", "ids", "ratio", "kept", "n_lines", "component", "group", "tokens"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(i, t) for i, t in TEXTS], "doc_id long, text string")
    return df.selectExpr("*", *[f"'{c}!' AS {c}" for c in CLASH])


def one_each(rows, *cols):
    """One result for each (id, text); equal rows have equal ones."""
    found = {}
    for r in rows:
        found.setdefault((r.doc_id, r.raw), set()).add(tuple(r[c] for c in cols))
    assert len(rows) == len(TEXTS) and all(len(v) == 1 for v in found.values())
    return {k: next(iter(v)) for k, v in found.items()}


@pytest.mark.parametrize(
    ("run", "cols"),
    [
        (lambda d: compression_quality(d), ["n_words", "kept"]),
        (lambda d: dedup_lines(d), ["n_lines", "n_removed_lines"]),
        (lambda d: near_duplicate_components(d), ["fingerprint", "component_id"]),
        (lambda d: near_duplicate_groups(d), ["group"]),
        (lambda d: decode_documents(encode_documents(d)), ["n_tokens", "decoded"]),
    ],
)
def test_every_row_has_its_result(docs, run, cols):
    out = run(docs.withColumn("raw", F.col("text")))
    got = one_each(out.collect(), *cols)
    kept = [c for c in CLASH if c in out.columns and c not in ("fp", "ids", "ratio", "kept", "n_lines", "group")]
    assert kept and all(r[c] == f"{c}!" for r in out.select(kept).collect() for c in kept)
    if "n_words" in cols:
        assert got[1, None] == got[1, ""] == (0, False) and got[3, LONG][0] == 170_000
    if "n_lines" in cols:
        assert got[1, None] == (0, 0) and got[1, ""] == (1, 0) and got[3, LONG] == (20_002, 19_999)
    if "component_id" in cols:
        assert got[1, None] == got[1, ""] == ("0" * 16, 1) and got[None, None] == ("0" * 16, 1) and got[4, " \n\t "][1] == 1
    if "decoded" in cols:
        assert all(bytes(v[1]) == (k[1] or "").encode() for k, v in got.items())
    assert run(docs.limit(0).withColumn("raw", F.col("text"))).count() == 0


def test_packing_takes_every_row(docs):
    rows = pack_documents(docs).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert len([r for r in by_doc[1] if r.length == 1]) == 2 and len(by_doc[2]) == 3 and {r.gap for r in rows} == {0}
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
