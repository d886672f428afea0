import random
import string

import pyarrow.parquet as pq
import pytest
import zstandard
from pyspark.sql import functions as F

from tarnlake.llm.components import connected_components
from tarnlake.llm.lines import dedup_lines
from tarnlake.llm.quality import LEVEL, compression_quality, measure
from tarnlake.llm.simhash import covering_masks, fingerprint, near_duplicate_components, signed, similarity_links
from tarnlake.llm.substring import dedup_substrings
from tests.llm import brute

DOC = "doc_id long, text string, lang string"


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def passages():
    """Texts with shared passages, copies, nulls, empties and rim cases."""
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    say = lambda n: [rnd.choice(vocab) for _ in range(n)]
    shared, other, line = say(80), say(50), say(49)
    out = [(1, " ".join(say(30) + shared + say(20))), (2, " ".join(shared)), (3, " ".join(say(10) + shared[10:75] + say(60)))]
    out += [(4, " ".join(other)), (5, "\t".join(say(5) + other + say(3))), (6, " ".join(line)), (7, " ".join(say(9) + line))]
    out += [(8, None), (9, ""), (10, "  \n "), (None, " ".join(shared)), (11, out[0][1]), (12, "a " * 200), (13, "a " * 120 + "b")]
    out += [(14, " ".join(shared + shared)), (14, " ".join(shared + shared)), (15, " ".join(other + say(4) + shared[:60]))]
    out += [(0, " ".join(say(3) + shared[25:]))]
    for i in range(20, 60):
        mix = say(rnd.randint(0, 40)) + (shared[rnd.randint(0, 20) :] if i % 3 else other) + say(rnd.randint(0, 40))
        out.append((i, " ".join(mix)))
    return out


def test_substring_matches_brute_force(spark, passages):
    df = spark.createDataFrame([(i, t, "x") for i, t in passages], DOC)
    got = rows_of(dedup_substrings(df, keep=["doc_id"]), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.substring(passages), key=repr)
    whole = dedup_substrings(df).collect()
    for r in whole:
        assert r.text is None if r.doc_id == 8 else len(brute.words(r.text)) == r.n_words - r.n_removed
    assert dedup_substrings(df).columns == ["doc_id", "text", "lang", "n_words", "n_removed", "kept_sha256"]


def test_substring_removes_nothing_by_colliding_hashes(spark, passages):
    """With hashes of a few bits most paths and windows collide; words decide."""
    df = spark.createDataFrame(passages, "doc_id long, text string")
    want = {r[0]: r for r in brute.substring(passages)}
    true = {(i, n): gone for i, n, gone, _ in brute.substring(passages)}
    for bits in (3, 10):
        for r in dedup_substrings(df, bits=bits).collect():
            assert r.n_removed <= true[r.doc_id, r.n_words]
            assert r.n_removed < true[r.doc_id, r.n_words] or r.kept_sha256 == want[r.doc_id][3] or r.doc_id is None


def test_substring_long_chain_of_copies(spark):
    """Long equal texts, whole and in part, at many places."""
    rnd = random.Random(8)
    long = [f"w{rnd.randint(0, 5000)}" for _ in range(12000)]
    rows = [(i, " ".join(long)) for i in (1, 2, 3)] + [(4, " ".join(long[3000:9000])), (5, " ".join(["x"] * 300)), (6, " ".join(["x"] * 400))]
    rows += [(7, " ".join(long[100:170] + ["y"] + long[170:260])), (8, " ".join(long[::-1]))]
    got = rows_of(dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.substring(rows), key=repr)


def test_substring_clashing_columns(spark):
    names = ["id", "key", "row", "spots", "_key", "_sid", "n_words"]
    df = spark.createDataFrame([(1, " ".join(["a"] * 60)), (2, " ".join(["a"] * 60))], "doc_id long, text string").selectExpr("*", *[f"'{n}!' AS {n}" for n in names])
    for r in dedup_substrings(df).collect():
        assert all(r[n] == f"{n}!" for n in names[:-1]) and r.n_words == 60 and r.n_removed == (0 if r.doc_id == 1 else 60)


def test_substring_on_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    want = brute.substring([(r.doc_id, r.text) for r in docs.collect()])
    got = rows_of(dedup_substrings(docs, keep=["doc_id"]), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(want, key=repr)
    assert sum(x[2] for x in want) > 0


def test_substring_empty_and_clash(spark):
    df = spark.createDataFrame([], DOC + ", n_words int, seed int, key string")
    assert dedup_substrings(df).count() == 0
    one = spark.createDataFrame([(1, "a b", "x", 5, 6, "k")], DOC + ", n_words int, seed int, key string")
    r = dedup_substrings(one).first()
    assert (r.n_words, r.seed, r.key) == (2, 6, "k")


def test_simhash_on_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    prints = [(r.doc_id, brute.fingerprint(r.text)) for r in docs.collect()]
    least = brute.components(prints)
    want = sorted(((i, f"{fp:016x}", least[i]) for i, fp in prints), key=repr)
    assert rows_of(near_duplicate_components(docs), "doc_id", "fingerprint", "component_id") == want


def test_simhash_edges(spark):
    texts = [(5, None), (4, ""), (3, " \n"), (7, "One two"), (8, "one TWO"), (9, "one two three four"), (9, "one two three four")]
    df = spark.createDataFrame([(*t, "x", 1) for t in texts] + [(None, "one two", "x", 1)], DOC + ", fp int")
    got = rows_of(near_duplicate_components(df), "doc_id", "component_id")
    assert got == sorted([(5, 3), (4, 3), (3, 3), (7, 7), (8, 7), (9, 9), (9, 9), (None, 7)], key=repr)
    assert near_duplicate_components(df.limit(0)).count() == 0
    assert fingerprint("É a b") != fingerprint("é a b")


def test_covering_masks_miss_no_pair():
    from itertools import combinations

    masks = covering_masks(3)
    assert len(masks) == 15
    for at in combinations(range(64), 3):
        d = sum(1 << i for i in at)
        assert any(m & d == 0 for m in masks)


@pytest.mark.parametrize("block", [1, 8, 4096])
def test_links_exact_for_any_block(spark, block):
    rnd = random.Random(9)
    base = [rnd.getrandbits(64) for _ in range(4)]
    prints = {b ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 5))) & ((1 << 64) - 1) for b in base for _ in range(40)}
    pairs = list(enumerate(sorted(prints)))
    nodes = spark.createDataFrame([(i, signed(x)) for i, x in pairs], "id long, fp long")
    labels = dict(tuple(r) for r in connected_components(similarity_links(nodes, 3, block)).select("id", "component").collect())
    want = brute.components(pairs)
    assert {i: labels.get(i, i) for i, _ in pairs} == want


def test_components_long_path_and_star(spark):
    links = [(i, i + 1) for i in range(100, 180)] + [(7, i) for i in range(300, 400)]
    df = spark.createDataFrame(links, "src long, dst long")
    got = dict(tuple(r) for r in connected_components(df).select("id", "component").collect())
    assert got == {**{i: 100 for i in range(100, 181)}, 7: 7, **{i: 7 for i in range(300, 400)}}
    assert connected_components(df.limit(0)).count() == 0


def test_quality_matches_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    extra = [(-1, None), (-2, ""), (-3, " \t\n"), (-4, "x " * 50), (-5, "a b c d e\na b c d e\n\n \n"), (-6, "é ü ñ |<>| word " * 3)]
    more = spark.createDataFrame(extra, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    want = sorted(((i, *brute.base_measures(t)) for i, t in ((r.doc_id, r.text) for r in more.collect())), key=repr)
    found = compression_quality(more)
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows_of(found, *cols) == want
    assert found.where("base_failed and kept").count() == 0


def test_quality_bands(spark):
    import base64

    noise = base64.b64encode(random.Random(1).randbytes(6000)).decode()
    noise = " ".join(noise[i : i + 9] for i in range(0, len(noise), 9))
    turns = " ".join(f"row {i % 97} of the same table again" for i in range(900))
    df = spark.createDataFrame([(1, noise), (2, turns)], "doc_id long, text string")
    got = {r.doc_id: r for r in compression_quality(df).collect()}
    assert not got[1].base_failed and not got[1].kept
    assert not got[2].kept
    assert compression_quality(df, only_kept=True).count() == 0
    assert compression_quality(df.limit(0)).count() == 0


def spaced_noise(alphabet, n_bytes, seed=3):
    rnd, out = random.Random(seed), ""
    while len(out) < n_bytes:
        out += "".join(rnd.choices(alphabet, k=rnd.randint(4, 10))) + " "
    return out[:n_bytes]


@pytest.mark.parametrize(
    "alphabet, lengths",
    [
        (string.ascii_letters + string.digits + "+/", (200, 300, 400, 600, 800, 1200, 3000, 6000, 12000, 30000)),
        ("".join(map(chr, range(33, 127))), (175, 200, 300, 400, 600, 800, 1200, 3000, 6000, 12000, 30000)),
        (string.ascii_lowercase + string.digits, (800, 1200, 1600, 3000, 6000, 12000, 30000)),
        (string.ascii_lowercase, (1600, 3000, 6000, 12000, 30000)),
        ("0123456789abcdef", (4096, 6000, 12000, 30000)),
    ],
)
def test_quality_rejects_noise_of_each_length(alphabet, lengths):
    zstd = zstandard.ZstdCompressor(level=LEVEL)
    for n in lengths:
        base_failed, kept = measure(spaced_noise(alphabet, n), zstd)[-2:]
        assert not base_failed and not kept, n


def test_quality_rejects_texts_that_are_part_noise():
    docs = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    labels = pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pylist()
    clean = {r["doc_id"] for r in labels if r["quality"] == 1}
    zstd = zstandard.ZstdCompressor(level=LEVEL)
    prose = max((r["text"].encode() for r in docs if r["doc_id"] in clean), key=lambda b: (measure(b.decode(), zstd)[-1], len(b)))
    cut = lambda n: prose[:n].decode(errors="ignore")
    alnum = string.ascii_lowercase + string.digits
    for n_noise, n_prose in ((4000, 4096), (8192, 8192), (24576, 24576), (2000, 12288), (8192, 24576)):
        noise = spaced_noise(alnum, n_noise)
        for text in (cut(n_prose) + noise, noise + cut(n_prose)):
            m = measure(text, zstd)
            assert not m[-2] and not m[-1], (n_noise, n_prose)
    m = measure(cut(4096 * 2 + 500), zstd)
    assert m[-1] and (m[-4], m[-3]) == (0, 3)


def test_quality_keeps_labelled_clean(spark):
    sf = "/root/testdata/sf0.01"
    docs = compression_quality(spark.read.parquet(f"{sf}/documents.parquet"), keep=["doc_id"])
    both = docs.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    clean = both.where("quality = 1")
    assert clean.where("kept").count() >= 0.995 * clean.count()


def test_lines_match_brute_force(spark, tiny):
    a, b = "one\ntwo\nthree\nfour\nfive", "zero\ntwo \nthree\n four\nsix"
    texts = [(1, a), (2, b), (3, a), (3, a), (4, "x\nx\nx\nx\nx"), (5, None), (6, ""), (7, "\n\n\n\n"), (8, "one\ntwo"), (9, "\n".join([a] * 3))]
    table = [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    docs = texts + table
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], DOC + ", n_lines int")
    got = rows_of(dedup_lines(df), "doc_id", "n_lines", "n_removed_lines", "text")
    assert got == sorted(brute.lines(docs), key=repr)
    assert dedup_lines(df.limit(0)).count() == 0
    null_id = df.withColumn("doc_id", F.lit(None).cast("long"))
    assert dedup_lines(null_id).count() == len(docs)


def test_texts_without_an_id_link_others(spark):
    """1 and 3 are linked through a text without an id only."""
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(300)]

    def bits(a, b):
        return (brute.fingerprint(a) ^ brute.fingerprint(b)).bit_count()

    for _ in range(4000):
        a = [rnd.choice(words) for _ in range(60)]
        b, c = list(a), list(a)
        b[rnd.randrange(60)] = "x"
        c = list(b)
        c[rnd.randrange(60)] = "y"
        a, b, c = map(" ".join, (a, b, c))
        if bits(a, b) <= 3 and bits(b, c) <= 3 and bits(a, c) > 3:
            break
    df = spark.createDataFrame([(1, a), (None, b), (3, c), (None, "alone in the world"), (7, "another text")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicate_components(df).where("text != 'alone in the world'").collect()}
    assert bits(a, c) > 3 and got == {1: 1, None: 1, 3: 1, 7: 7}
    assert near_duplicate_components(df).where("text = 'alone in the world'").first().component_id is None
