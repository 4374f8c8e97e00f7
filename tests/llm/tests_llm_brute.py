"""Plain-Python versions of what the pipeline's stages do."""

import re


def words_of(text, pattern):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def components_of(texts, n, threshold):
    sets = {}
    for d, t in texts.items():
        w = words_of(t, r"[^\x20\x09-\x0D]+")
        sets[d] = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for d in sorted(sets):
        near = {}
        for g in sets[d]:
            for other in holders.get(g, ()):
                near[other] = near.get(other, 0) + 1
            holders.setdefault(g, []).append(d)
        for other, both in near.items():
            if 100 * both >= threshold * (len(sets[d]) + len(sets[other]) - both):
                a, b = sorted((root(d), root(other)))
                parent[b] = a
    return {d: root(d) for d in sets}


def hits_of(text, items, window):
    """Number of words and the places that an item's window covers."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    w = words_of(text, pattern)
    hit = set()
    runs = {}
    for item in items:
        b = words_of(item, pattern)
        n = min(window, len(b))
        if n:
            runs.setdefault(n, set()).update(tuple(b[i : i + n]) for i in range(len(b) - n + 1))
    for n, known in runs.items():
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in known:
                hit |= set(range(i, i + n))
    return len(w), hit
