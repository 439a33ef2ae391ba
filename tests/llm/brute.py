"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import hashlib
from collections import Counter


def words(text):
    return (text or "").encode().split()


def without_repeats(texts, width):
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, width=5):
    w = [x.lower() for x in words(text)]
    if not w:
        return set()
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))}


def components(rows, percent=80):
    """(id, number of shingles, component) per row; rows are told apart by position."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                label[find(i)] = find(j)
    low = {}
    for i, (id_, _) in enumerate(rows):
        if id_ is not None:
            low[find(i)] = min(low.get(find(i), id_), id_)
    return [(id_, len(sets[i]), low.get(find(i))) for i, (id_, _) in enumerate(rows)]
