"""Brute-force counterparts on plain Python values."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k=5):
    words = WORD.findall(text)
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def without_repeats(rows, window=13):
    """(words, removed, digest) of (id, text) rows."""
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    first = {}
    for d, words in split:
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, words in split:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        left = [w for w, g in zip(words, gone) if not g]
        out.append((d, len(words), len(words) - len(left), hashlib.sha256(" ".join(left).encode()).hexdigest()))
    return sorted(out)


def links(rows, threshold=0.8):
    """(id, class, links) of (id, text) rows with ids of their own."""
    sets = [shingle_set(t or "") for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for shingle in s:
            holders[shingle].append(i)
    common = Counter((a, b) for held in holders.values() for i, a in enumerate(held) for b in held[i + 1:])
    pairs = [p for p, n in common.items() if n / (len(sets[p[0]]) + len(sets[p[1]]) - n) >= threshold]
    return classes([d for d, _ in rows], pairs)


def classes(ids, pairs):
    root, count = list(range(len(ids))), Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        count[a] += 1
        count[b] += 1
        x, y = find(a), find(b)
        if x != y:
            root[max((ids[x], x), (ids[y], y))[1]] = min((ids[x], x), (ids[y], y))[1]
    return sorted((ids[i], ids[find(i)], count[i]) for i in range(len(ids)))
