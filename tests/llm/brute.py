"""Plain versions of the operators' contracts, for small tables."""

import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def words(text):
    return (text or "").encode().lower().split()


def contamination(docs, bench, n=13):
    """docs, bench: lists of (id, text)."""
    windows = defaultdict(set)
    for i, t in bench:
        w = item_words(t)
        k = min(n, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[a : a + k])].add(str(i))
    lengths, out = {len(w) for w in windows}, []
    for i, t in docs:
        w, hit, items = item_words(t), set(), set()
        for k in lengths:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in windows:
                    hit.update(range(a, a + k))
                    items |= windows[tuple(w[a : a + k])]
        out.append((i, len(w), len(hit), sorted(items), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def shingles(text, n):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[a : a + n]) for a in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def components(docs, n, percent):
    """{doc_id: (set size, smallest id reachable)} over all pairs."""
    sets = {i: shingles(t, n) for i, t in docs}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def unigram(docs, held):
    """N, V and {doc_id: (n_tokens, n_known, base)}."""
    import math

    counts = Counter()
    for i, t in docs:
        if not held(i):
            counts.update([*words(t), None])
    total, kinds = sum(counts.values()), len(counts)
    out = {}
    for i, t in docs:
        w = [*words(t), None]
        out[i] = (len(w), sum(counts[x] > 0 for x in w), sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w))
    return total, out


def fold(i, n):
    return zlib.crc32(b"" if i is None else str(i).encode()) % n
