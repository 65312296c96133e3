"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import numpy as np
import xxhash


def repeated_stretches(docs, length, units, within):
    """Units of each document covered by a window that also starts earlier."""
    cut = [(doc_id, units(text or "")) for doc_id, text in sorted(docs, key=lambda row: row[0])]
    first = {}
    for doc_id, sequence in cut:
        for at in range(len(sequence) - length + 1):
            first.setdefault(sequence[at : at + length], (doc_id, at))
    gone = {}
    for doc_id, sequence in cut:
        hidden = set()
        for at in range(len(sequence) - length + 1):
            place = first[sequence[at : at + length]]
            if place < (doc_id, at) if within else place[0] < doc_id:
                hidden |= set(range(at, at + length))
        gone[doc_id] = (sequence, hidden)
    return gone


def spans(hidden):
    return sum(1 for at in hidden if at - 1 not in hidden)


def fingerprint(text, size):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(shingle, 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(prints, most):
    """Smallest id reachable over pairs of fingerprints that differ in ``most`` bits at most."""
    root = {doc_id: doc_id for doc_id, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, p) in enumerate(prints):
        for b, q in prints[k + 1 :]:
            if (p ^ q).bit_count() <= most:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {doc_id: find(doc_id) for doc_id in root}


def nearest_distance(item, text):
    """Smallest edit distance of ``item`` to any part of ``text``."""
    above = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        row = [i]
        for j, y in enumerate(text, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return min(above)


def segmentations(word, probabilities, unknown):
    """Summed probability of all ways to cut a word."""
    ways = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            part = word[start:end]
            chance = probabilities.get(part, unknown if end == start + 1 else 0.0)
            ways[end] += ways[start] * chance
    return ways[-1]


def nearest(vectors, query, most):
    rows = [(float(np.sqrt(((np.array(v, dtype=float) - np.array(vectors[query], dtype=float)) ** 2).sum())), i) for i, v in vectors.items() if i != query]
    return sorted(rows)[:most]
