"""Byte-level BPE encoding and decoding.

A piece's merges run on a segment tree over its byte positions: a leaf holds
the rank of the pair that starts there, inner nodes the least (rank, position),
so the root names the leftmost pair of lowest rank. A merge changes three
leaves: the pair itself, the one before and the one that is swallowed.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tarnlake.llm.text import row_map

RANKS = "byte_bpe_50k.tiktoken"
#: Pieces and chunks remembered by a Python worker; beyond it starts anew.
CACHE_ENTRIES = 800_000
CACHE_CHARS = 64
#: Pieces of more bytes are merged one by one.
WIDE = 64
NONE = 1 << 62

_TWO_WHITE = re.compile(r"\s\s")


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece by lowest-rank, leftmost merges."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    none = NONE
    size = 1 << (n - 1).bit_length()
    tree = [none] * (2 * size)
    get = ranks.get
    for i in range(n - 1):
        r = get(piece[i : i + 2])
        if r is not None:
            tree[size + i] = r * size + i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    after = list(range(1, n + 2))
    before = list(range(-1, n))

    def put(i: int, key: int) -> None:
        k = size + i
        tree[k] = key
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            best = a if a < b else b
            if tree[k] == best:
                return
            tree[k] = best
            k >>= 1

    while tree[1] != none:
        i = tree[1] % size
        j = after[i]
        end = after[j]
        after[i] = end
        put(j, none)
        if end < n:
            before[end] = i
            r = get(piece[i : after[end]])
            put(i, none if r is None else r * size + i)
        else:
            put(i, none)
        p = before[i]
        if p >= 0:
            r = get(piece[p:end])
            put(p, none if r is None else r * size + p)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class PairTrees:
    """The same merges for many short pieces at once, one tree per row."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        found = {
            ranks[t[:k]] << 20 | ranks[t[k:]]: r for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks
        }
        self.keys = np.array(sorted(found), np.int64)
        self.values = np.array([found[k] for k in self.keys.tolist()], np.int64)

    def _pair(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        key = left << 20 | right
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.values[i] * size + at, NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece; the pieces have at most WIDE bytes."""
        out: list[bytes] = [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if p in self.ranks:
                out[i] = self.ranks[p].to_bytes(4, "little")
            elif p:
                classes.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
        for size, members in classes.items():
            for ids, i in zip(self._merge_class([pieces[i] for i in members], size), members, strict=True):
                out[i] = ids
        return out

    def _merge_class(self, pieces: list[bytes], size: int) -> list[bytes]:
        m, none = len(pieces), NONE
        n = np.fromiter(map(len, pieces), np.int64, m)
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(m, size)
        ids = np.zeros((m, size + 1), np.int64)
        ids[:, :size] = self.single[raw]
        at = np.arange(size - 1)
        tree = np.full((m, 2 * size), none)
        real = at[None, :] < n[:, None] - 1
        tree[:, size : 2 * size - 1] = np.where(real, self._pair(ids[:, : size - 1], ids[:, 1:size], at[None, :], size), none)
        level = size
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half
        after = np.tile(np.arange(1, size + 3), (m, 1))
        before = np.tile(np.arange(-1, size + 1), (m, 1))
        alive = np.arange(size + 1)[None, :] < n[:, None]
        act = np.flatnonzero(tree[:, 1] != none)
        while len(act):
            root = tree[act, 1]
            i, token = root % size, root // size
            j = after[act, i]
            end = after[act, j]
            ids[act, i], after[act, i], before[act, end], alive[act, j] = token, end, i, False
            tree[act, size + j] = none
            inside = end < n[act]
            tree[act, size + i] = np.where(inside, self._pair(token, ids[act, np.minimum(end, size)], i, size), none)
            p = before[act, i]
            prior = p >= 0
            p = np.where(prior, p, i)
            ahead = self._pair(ids[act, p], token, p, size)
            tree[act, size + p] = np.where(prior, ahead, tree[act, size + i])
            for leaf in (j, i, p):
                k = (size + leaf) >> 1
                while k[0]:
                    tree[act, k] = np.minimum(tree[act, 2 * k], tree[act, 2 * k + 1])
                    k = k >> 1
            act = act[tree[act, 1] != none]
        flat = ids.astype("<u4")
        return [flat[r][alive[r]].tobytes() for r in range(m)]


def chunks(text: str) -> list[str] | None:
    """Cut a text at single white space so that no match of the pattern crosses
    a cut, or None if white space stands side by side. A lone space belongs to
    what follows it; a lone line feed is a match of its own."""
    if "\0" in text or _TWO_WHITE.search(text):
        return None
    return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")


class PieceCache:
    """Ids of whole texts from the ids of their pieces, each worked out once.

    ``encode_pieces`` gives the packed ids of pattern matches. Chunks and
    pieces met before are remembered up to a bound, then forgotten together.
    """

    def __init__(self, encode_pieces: Callable[[list[str]], list[bytes]], pattern: str = public_tokenizers.PATTERN):
        self.encode_pieces = encode_pieces
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as packed little-endian unsigned 32-bit integers."""
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        known = self.known
        cut = [chunks(t or "") for t in texts]
        cut = [self.pattern.findall(t) if c is None else c for c, t in zip(cut, texts, strict=True)]
        new = {p for c in cut for p in c if p not in known}
        pieces = {p: self._matches(p) for p in new}
        fresh = list({q for found in pieces.values() for q in found if q not in known})
        known.update(zip(fresh, self.encode_pieces(fresh), strict=True))
        for p, found in pieces.items():
            if p not in known:
                known[p] = b"".join([known[q] for q in found])
        out = [b"".join(map(known.__getitem__, c)) for c in cut]
        for p in {*new, *fresh}:
            if len(p) > CACHE_CHARS:
                del known[p]
        return out

    def _matches(self, chunk: str) -> list[str]:
        """Matches of the pattern; letters after at most one space are one."""
        if chunk.isalpha() or (chunk[:1] == " " and chunk[1:].isalpha()):
            return [chunk]
        return self.pattern.findall(chunk)


class ByteBPE:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.trees = PairTrees(self.ranks)
        self.encode = PieceCache(self._pieces).encode
        self.vocab = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            self.vocab[i] = token

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        data = [p.encode() for p in pieces]
        out = self.trees.merge([p if len(p) <= WIDE else b"" for p in data])
        for i, p in enumerate(data):
            if len(p) > WIDE:
                out[i] = np.array(merge_piece(p, self.ranks), "<u4").tobytes()
        return out

    def decode(self, ids: bytes | None) -> bytes:
        return b"".join(map(self.vocab.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


@lru_cache(maxsize=4)
def codec(path: str) -> ByteBPE:
    return ByteBPE(path)


def encode_documents(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Append ``ids`` (packed little-endian uint32) and ``n_tokens``.

    Null text counts as empty: no ids. Special tokens are ordinary text. Equal
    rows get equal ids. A column of these names is replaced. One scan, one
    Arrow map, no shuffle; texts of any length are cut into pieces by the
    pattern and each piece costs its length times a logarithm. Pieces of up to
    WIDE bytes are merged side by side, longer ones alone: by the same merges.
    """
    path = path or public_tokenizers.path(RANKS)
    new = T.StructType([T.StructField("ids", T.BinaryType(), False), T.StructField("n_tokens", T.LongType(), False)])

    def run(rows: list[tuple]) -> Iterator[tuple]:
        for ids in codec(path).encode([text for (text,) in rows]):
            yield ids, len(ids) // 4

    return row_map(docs, run, [text_col], new, keep, 128)


def decode_documents(coded: DataFrame, ids_col: str = "ids", keep: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Append ``decoded``, the bytes that the packed ids stand for (null: none)."""
    path = path or public_tokenizers.path(RANKS)
    new = T.StructType([T.StructField("decoded", T.BinaryType(), False)])
    return row_map(coded, lambda rows: ((codec(path).decode(ids),) for (ids,) in rows), [ids_col], new, keep, 128)
