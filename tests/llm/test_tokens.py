import base64
import random
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tarnlake.llm.bpe import RANKS, codec, decode_documents, encode_documents, merge_piece
from tarnlake.llm.packing import VOCABULARY, Work, _tokenizer, best_fit, complete_bins, cut, fillings, least_bins, pack_documents, places


@pytest.fixture(scope="module")
def peer():
    with open(P.path(RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = ["", " ", "\n", " \n", "a\n\n b", "a  b", "a \n b", "  lead", "trail  ", "tab\tx \t y", "don't 's 'S", " x 　y", "\x1c a\x1f b"]
ODD += ["\0 a \0", "<|endoftext|> x", "日本語 テキスト", "🙂🙂 👩‍👩‍👧", "a" * 3000, "ab" * 700 + " " * 400, "1234567 12 ", "x" * 65 + " " + "é" * 40, "\r\n\r\n"]


def test_encode_as_tiktoken(peer):
    own = codec(P.path(RANKS))
    coded = own.encode(ODD)
    for text, ids in zip(ODD, coded, strict=True):
        want = peer.encode_ordinary(text)
        assert list(struct.unpack(f"<{len(want)}I", ids)) == want, text[:40]
        assert own.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(" \n\tabcdeéß'sx1.,! 日🙂\0"), max_size=60), st.text(max_size=30))
def test_encode_any_text(a, b):
    own = codec(P.path(RANKS))
    peer = Tokenizer.from_file(P.path(VOCABULARY))
    peer.encode_special_tokens = True
    for text in (a, b, a + b):
        want = np.array(peer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert own.encode([text]) == [want]
        assert _tokenizer(P.path(VOCABULARY)).encode([text]) == [want]


def test_trees_agree_with_single_tree():
    own, rnd = codec(P.path(RANKS)), random.Random(3)
    pieces = [bytes(rnd.choice(b"the anionger\xc3\xa9st") for _ in range(rnd.randint(1, 64))) for _ in range(400)]
    got = own.trees.merge(pieces)
    assert got == [np.array(merge_piece(p, own.ranks), "<u4").tobytes() for p in pieces]


def test_round_trip_on_table(spark, tiny, peer):
    import hashlib

    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    more = spark.createDataFrame([(-1, None, "x"), (-2, "", "x"), (-2, "", "x")], "doc_id long, text string, ids string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    for r in decode_documents(encode_documents(docs)).collect():
        want = peer.encode_ordinary(r.text or "")
        assert r.n_tokens == len(want)
        assert hashlib.sha256(bytes(r.ids)).digest() == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).digest()
        assert bytes(r.decoded) == (r.text or "").encode()
    assert encode_documents(docs.limit(0)).count() == 0


def optimum(items, capacity):
    """Least bins by trying every place for every item."""
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                bins[k] += items[i]
                go(i + 1, bins)
                bins[k] -= items[i]
        bins.append(items[i])
        go(i + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


def check_packing(items, capacity, packing):
    counts = np.bincount(items, minlength=capacity + 1)
    used = np.zeros_like(counts)
    for k, fill in packing.steps:
        assert k > 0 and sum(fill) <= capacity
        np.add.at(used, list(fill), k)
    assert (used == counts).all()
    assert packing.sequences == sum(k for k, _ in packing.steps) >= packing.bound


def test_bin_completion_reaches_optimum():
    rnd = random.Random(11)
    for _ in range(200):
        capacity = rnd.choice([10, 30, 100, 1024])
        most = max(1, capacity * rnd.choice([2, 5, 10]) // 10)
        items = sorted((rnd.randint(1, most) for _ in range(rnd.randint(1, 11))), reverse=True)
        found = complete_bins(np.bincount(items, minlength=capacity + 1), capacity)
        check_packing(items, capacity, found)
        assert found.sequences == found.bound == optimum(items, capacity)


def test_bin_completion_finds_planted_packings():
    known = [454, 370, 354, 333, 282, 256, 179, 166, 149, 133, 124, 122, 68, 44, 38]
    assert complete_bins(np.bincount(known, minlength=1025)).sequences == 3
    rnd = random.Random(5)
    for _ in range(300):
        items, n = [], rnd.choice([3, 4])
        for _ in range(n):
            cuts = sorted(rnd.sample(range(1, 1024), rnd.choice([3, 4])))
            items += [b - a for a, b in zip([0, *cuts], [*cuts, 1024], strict=True)]
        found = complete_bins(np.bincount(items, minlength=1025))
        check_packing(items, 1024, found)
        assert found.sequences == found.bound == n


def test_fillings_are_all_undominated_ones():
    """Against every subset, dominance tried on every part of it."""
    from itertools import combinations

    rnd = random.Random(2)
    for _ in range(60):
        room = rnd.randint(3, 25)
        items = [rnd.randint(1, room) for _ in range(rnd.randint(1, 8))]
        counts = np.bincount(items, minlength=room + 1).tolist()
        subsets = {tuple(sorted(c, reverse=True)) for k in range(1, len(items) + 1) for c in combinations(items, k) if sum(c) <= room}

        def dominated(f, counts=counts, room=room):
            spare = [s for s in range(1, room + 1) if counts[s] > f.count(s)]
            parts = [p for k in range(len(f) + 1) for p in combinations(f, k)]
            return any(sum(p) <= x <= sum(p) + room - sum(f) and p != (x,) for x in spare for p in parts)

        want = {f for f in subsets if not dominated(f)}
        for few_first in (True, False):
            got = list(fillings(counts, room, room, Work(10**9), few_first))
            assert len(got) == len(set(got)) and {tuple(sorted(f, reverse=True)) for f in got} == want


def test_large_histogram_near_bound():
    rnd = np.random.default_rng(1)
    counts = np.zeros(1025, np.int64)
    counts[1:] = rnd.poisson(40, 1024)
    found = complete_bins(counts, search_steps=20_000)
    check_packing(np.repeat(np.arange(1025), counts), 1024, found)
    assert found.bound == least_bins(counts, 1024) <= found.sequences <= found.bound * 1.001
    assert found.sequences <= sum(k for k, _ in best_fit(counts.tolist(), 1024))
    assert sum(s[2] for s in places(found.steps)) == counts.sum()
    assert complete_bins(np.zeros(1025, np.int64)).steps == []
    assert list(fillings([0] * 6, 5, 5, Work(9))) == [()]
    hot = counts * 0
    hot[[300, 424, 600]] = 10**9, 10**6, 5
    found = complete_bins(hot)
    assert found.sequences == 5 + 999_995 + -(-(10**9 - 2 * 999_995) // 3) and found.sequences >= found.bound


def test_cut():
    assert cut(1, 4) == [(0, 1)] and cut(4, 4) == [(0, 4)] and cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_pack_on_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    more = spark.createDataFrame([(None, "x y"), (-2, None), (-3, ""), (-4, "a b"), (-4, "a b")], "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    peer = Tokenizer.from_file(P.path(VOCABULARY))
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append([*peer.encode(r.text or "", add_special_tokens=False).ids, 2])
    rows = pack_documents(docs, with_ids=True).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length <= 4096
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spots in by_seq.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 1024
    assert set(by_doc) == set(want)
    for i, all_ids in want.items():
        got = sorted(by_doc[i], key=lambda r: (r.piece, r.start))
        copies = len(all_ids)
        one = got[::copies]
        assert len(got) == copies * len(one)
        assert [r.piece for r in one] == list(range(len(one)))
        assert b"".join(bytes(r.ids) for r in one) == struct.pack(f"<{len(all_ids[0])}I", *all_ids[0])
        assert all(r.length == 1024 for r in one[1:]) and [r.start for r in one] == [s for s, _ in cut(len(all_ids[0]), 1024)]
    total = sum(r.length for r in rows)
    assert len(by_seq) <= -(-total // 1024) + 2
    assert pack_documents(docs.limit(0)).count() == 0
