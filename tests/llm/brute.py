"""Brute-force versions of the operators, in plain Python."""

import hashlib
from collections import Counter

import xxhash


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def simhash(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(rows, radius=2):
    """doc_id -> (fingerprint, smallest doc_id reachable), over all pairs."""
    prints = {d: simhash(t) for d, t in rows}
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: (f"{prints[d]:016x}", find(d)) for d in ids}


def substring(texts, window):
    """(n_words, n_removed, kept_sha256) of each text of the list."""
    words = [(t or "").encode().split() for t in texts]
    counts = Counter(
        tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1)
    )
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), sha(kept)))
    return out
