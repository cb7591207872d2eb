"""Plain versions of operators, for small tables."""

import zlib
from collections import Counter

import numpy as np


def union_find(nodes, links):
    root = {v: v for v in nodes}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {v: find(v) for v in nodes}


def weighted_jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def bags_of(texts):
    return {i: Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for i, t in texts.items() if (w := (t or "").lower().split())}


def near_classes(texts, least=0.8):
    """Class of each text by comparing all pairs."""
    bags = bags_of(texts)
    return union_find(texts, [(a, b) for a in bags for b in bags if a < b and weighted_jaccard(bags[a], bags[b]) >= least])


def check_packing(rows, ids, size):
    """Every id lies in one piece, sequences have no gaps and are not too long; returns the share of padding."""
    at, sequences = {}, {}
    for doc, start, length, crc, total, sequence, offset in rows:
        assert at.get(doc, 0) == start and length > 0 and total == len(ids[doc])
        assert crc == zlib.crc32(np.asarray(ids[doc][start : start + length], "<u4").tobytes())
        at[doc] = start + length
        sequences.setdefault(sequence, []).append((offset, length))
    assert at == {k: len(v) for k, v in ids.items()}
    padding = 0
    for pieces in sequences.values():
        used = 0
        for offset, length in sorted(pieces):
            assert offset == used
            used += length
        assert used <= size
        padding += 0 if used & (used - 1) == 0 else size - used
    return padding / max(1, sum(map(len, ids.values())))


def without(text, lines):
    return "\n".join(x for k, x in enumerate(text.split("\n")) if k not in set(lines))


def lines_to_delete(texts, least=5):
    """Non-empty lines by all repeated runs; empty ones by the repeated runs that can't be shorter at one end."""
    place, out = {}, {}
    for ident in sorted(texts):
        lines = [x.strip() for x in (texts[ident] or "").split("\n")]
        sizes = [len(x.split()) for x in lines]
        runs = {(i, j) for i in range(len(lines)) for j in range(i, len(lines)) if lines[i] and lines[j] and sum(sizes[i : j + 1]) >= least}
        for i, j in sorted(runs):
            body = tuple(x for x in lines[i : j + 1] if x)
            first = place.setdefault(body, (ident, i, j))
            if ident > first[0] or i > first[2]:
                total = sum(sizes[i : j + 1])
                shortest = total - sizes[i] < least or total - sizes[j] < least
                out.setdefault(ident, set()).update(k for k in range(i, j + 1) if lines[k] or shortest)
    return {k: sorted(v) for k, v in out.items()}
