import zlib

import numpy as np
import public_tokenizers as P
import zstandard
from tokenizers import Tokenizer

import corpus_pipeline
from tarnlake.llm.quality import CHUNK, CHUNK_SHARE, LEVEL, band
from tests.llm import brute


def kept_by_quality(text):
    if brute.base_measures(text)[-1]:
        return False
    z, data = zstandard.ZstdCompressor(level=LEVEL), text.encode()
    ratio = lambda b: len(z.compress(b)) / len(b)
    inside = lambda b: band(len(b))[0] <= ratio(b) <= band(len(b))[1]
    chunks = [data[i : i + CHUNK] for i in range(0, len(data) - CHUNK + 1, CHUNK)]
    out = sum(not inside(c) for c in chunks) if len(chunks) > 1 else 0
    return inside(data) and out <= CHUNK_SHARE * len(chunks)


def expected(docs):
    docs = [(i, t) for i, t in docs if kept_by_quality(t)]
    docs = [(i, t) for i, _, _, t in brute.lines(docs)]
    least = brute.components([(i, brute.fingerprint(t)) for i, t in docs])
    docs = [(i, t) for i, t in docs if least[i] == i]
    words = {}
    for i, n, gone, sha in brute.substring(docs):
        words[i] = n - gone, sha
    return words


def test_pipeline_matches_brute_force(spark, tiny):
    import hashlib

    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    df, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = corpus_pipeline.materialize(stage(spark, df, tiny), name)
        assert df.columns == columns
    rows = df.collect()
    assert {r.doc_id: (len(brute.words(r.text)), hashlib.sha256(" ".join(brute.words(r.text)).encode()).hexdigest()) for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)
    peer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {r.doc_id: np.array([*peer.encode(r.text, add_special_tokens=False).ids, 2], "<u4") for r in rows}
    packed = corpus_pipeline.STAGES[-1][1](spark, df, tiny).collect()
    for r in packed:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    assert sum(r.length for r in packed) == sum(map(len, ids.values()))
    assert corpus_pipeline.run(spark, tiny).count() == len(packed)


def test_near_dedup_keeps_one_of_repeated_rows(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(4, text, "a"), (4, text, "a"), (7, text.upper(), "b"), (9, "something else altogether here", "c"), (None, text, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 4, 9]


def test_near_dedup_keeps_each_text_of_a_shared_id(spark):
    one, two = "one two three four five six seven eight nine ten", "red green blue white black brown pink grey gold plum"
    rows = [(4, one, "a"), (4, one, "b"), (4, two, "a"), (4, "no copies of this text are anywhere else", "a"), (7, one.upper(), "b"), (8, two.upper(), "b"), (9, two, "c")]
    rows += [(5, f"text number {i} of many under one id {i * i} {i % 7}x", "d") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id != 5) == sorted({(i, t) for i, t, _ in rows if i == 4})
    fives = [(t, brute.fingerprint(t)) for i, t, _ in rows if i == 5]
    groups = set(brute.components([(k, fp) for k, (_, fp) in enumerate(fives)]).values())
    assert sum(r.doc_id == 5 for r in got) == len(groups) > 1


def test_empty_documents(spark, tiny):
    df = spark.read.parquet(f"{tiny}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        df = corpus_pipeline.materialize(stage(spark, df, tiny), "empty") if stage is not corpus_pipeline.best_fit_packing else stage(spark, df, tiny)
    assert df.count() == 0


def test_columns_of_any_name_pass_every_stage(spark, tiny):
    """Columns named like the stages' own, null and very long texts, repeats."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{tiny}/documents.parquet").limit(60)
    long = docs.limit(1).withColumns({"doc_id": F.lit(10_001).cast("long"), "text": F.expr("repeat(concat(text, ' '), 200)")})
    odd = docs.limit(2).withColumns({"doc_id": F.lit(10_002).cast("long"), "text": F.lit(None).cast("string")})
    own = ["_text", "_rest", "row", "id", "text_hash", "rest_hash", "fp", "group", "least", "key"]
    docs = docs.unionByName(long).unionByName(odd).withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in own})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tiny)
        assert out.columns == docs.columns
        for r in out.select("doc_id", *own).collect():
            assert [r[c] for c in own] == [f"{c}-{r.doc_id}" for c in own]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, tiny).where("doc_id = 10001").count() >= 1
