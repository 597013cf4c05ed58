"""Brute-force versions of operators, on plain Python lists."""

from itertools import combinations


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, k):
    w = words(text)
    if len(w) >= k:
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    return {tuple(w)} if w else set()


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_components(docs, k, num, den):
    """{doc_id: (set size, component)} of (doc_id, text) rows."""
    sets = {d: shingles(t, k) for d, t in docs}
    links = []
    for a, b in combinations([d for d in sets if sets[d]], 2):
        x, y = sets[a], sets[b]
        if min(len(x), len(y)) * den >= max(len(x), len(y)) * num:
            both = len(x & y)
            if both * den >= (len(x) + len(y) - both) * num:
                links.append((a, b))
    comp = components(sets, links)
    return {d: (len(sets[d]), comp[d]) for d in sets}


def repeated_words(docs, n):
    """{doc_id: set of word positions in some run of n words that stands at an earlier place too}."""
    seen, out = set(), {}
    for d, t in sorted(docs):
        w = words(t)
        out[d] = set()
        for i in range(len(w) - n + 1):
            run = tuple(w[i : i + n])
            if run in seen:
                out[d] |= set(range(i, i + n))
            seen.add(run)
    return out
