"""Brute-force helpers of the tests."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict


def split(text):
    """Words after lower-casing A-Z, as bytes."""
    return (text or "").encode().lower().split()


def shingle_sets(texts, size=5):
    sets = {}
    for key, text in texts.items():
        words = split(text)
        sets[key] = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    return sets


def linked_groups(sets, percent=85):
    """The smallest id reachable from each, by counting all overlaps."""
    owners = defaultdict(list)
    for key, members in sets.items():
        for shingle in members:
            owners[shingle].append(key)
    shared = Counter()
    for keys in owners.values():
        for i, a in enumerate(keys):
            for b in keys[:i]:
                shared[min(a, b), max(a, b)] += 1
    parent = {key: key for key in sets}

    def find(key):
        while parent[key] != key:
            key = parent[key]
        return key

    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {key: find(key) for key in sets}


def fold(doc_id, folds):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds
