"""Plain, slow versions of the operators, for comparison on small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def substring(docs, span=50):
    """docs: list of (doc_id, text) -> {index: (n_words, n_removed, sha)}."""
    first = {}
    for i, t in docs:
        w = words(t)
        for p in range(len(w) - span + 1):
            k = tuple(w[p : p + span])
            if i is not None and (k not in first or i < first[k]):
                first[k] = i
    out = []
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - span + 1):
            if i is not None and first[tuple(w[p : p + span])] < i:
                gone[p : p + span] = [True] * span
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lowered)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(prints, radius=3):
    """prints: list of (id, fingerprint) -> {id: least reachable id}."""
    least = {i: i for i, _ in prints}
    changed = True
    near = [(a, b) for a, x in prints for b, y in prints if a < b and (x ^ y).bit_count() <= radius]
    while changed:
        changed = False
        for a, b in near:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


def base_measures(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i : i + 5])] > 1:
            hit.update(range(i, i + 5))
    seen, dup = set(), 0
    for x in text.split("\n"):
        if words(x):
            dup += x in seen
            seen.add(x)
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), failed


def lines(docs, window=3):
    """docs: list of (doc_id, text) -> list of (doc_id, n_lines, n_removed, kept text)."""
    trim = " \t\r\x0b\x0c"
    first = {}
    places = defaultdict(list)
    for i, t in docs:
        x = [] if t is None else [y.strip(trim) for y in t.split("\n")]
        for p in range(len(x) - window + 1):
            k = tuple(x[p : p + window])
            if any(k):
                places[i, t].append((p, k))
                first[k] = min(first.get(k, (i, p)), (i, p))
    out = []
    for i, t in docs:
        x = [] if t is None else t.split("\n")
        gone = {q for p, k in places[i, t] if first[k] < (i, p) for q in range(p, p + window)}
        kept = None if t is None else "\n".join(y for q, y in enumerate(x) if q not in gone)
        out.append((i, len(x), len(gone), kept))
    return out
