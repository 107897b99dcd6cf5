"""Plain statements of what the operators compute."""

import itertools
from collections import defaultdict


def shingle_set(text, k=5):
    words = (text or "").encode().lower().split()
    if len(words) >= k:
        return frozenset(tuple(words[j : j + k]) for j in range(len(words) - k + 1))
    return frozenset([tuple(words)] if words else [])


def near_components(rows, percent=80):
    """doc_id to (set size, smallest id reached), all pairs compared."""
    sets = {i: shingle_set(t) for i, t in rows}
    holders = defaultdict(list)
    for i, found in sets.items():
        for gram in found:
            holders[gram].append(i)
    common = defaultdict(int)
    for ids in holders.values():
        for a, b in itertools.combinations(sorted(ids), 2):
            common[a, b] += 1
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}
