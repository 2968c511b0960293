"""Plain, quadratic versions of the llm operators, for small inputs."""

from __future__ import annotations

import itertools

import numpy as np


def components(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def jaccard(rows, k, num, den):
    """{(doc_id, n_shingles, component_id)} of rows (doc_id, text)."""
    sets = {}
    for doc_id, text in rows:
        w = (text or "").encode().lower().split()
        size = min(k, len(w))
        sets[doc_id] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set()
    links = []
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and min(len(x), len(y)) * den >= max(len(x), len(y)) * num:
            shared = len(x & y)
            if den * shared >= num * (len(x) + len(y) - shared):
                links.append((a, b))
    comp = components(sets, links)
    return {(d, len(s), comp[d]) for d, s in sets.items()}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def similar_lines(lines, similarity=0.9):
    """All pairs (i < j) of lines whose edit similarity is reached."""
    size = np.array([len(x) for x in lines])
    kinds = sorted(set("".join(lines)))
    bags = np.array([[x.count(c) for c in kinds] for x in lines])
    out = []
    for i, x in enumerate(lines):
        most = (np.maximum(size[i + 1:], size[i]) * (1 - similarity) + 1e-9).astype(int)
        # an edit changes at most one count up and one down
        apart = bags[i + 1:] - bags[i]
        bound = np.maximum(np.maximum(apart, 0).sum(axis=1), np.maximum(-apart, 0).sum(axis=1))
        for j in np.flatnonzero(bound <= most).tolist():
            if levenshtein(x, lines[i + 1 + j]) <= most[j]:
                out.append((i, i + 1 + j))
    return out


def line_cuts(rows, similarity=0.9):
    """{doc_id: sorted cut line numbers} of rows (doc_id, text), ids distinct."""
    first, places = {}, {}
    for doc_id, text in sorted(rows):
        for i, line in enumerate((text or "").encode().lower().split(b"\n")):
            if words := line.split():
                norm = b" ".join(words)
                first.setdefault(norm, (doc_id, i))
                places.setdefault(norm, []).append((doc_id, i))
    norms = sorted(first)
    links = [(norms[i], norms[j]) for i, j in similar_lines([n.decode() for n in norms], similarity)]
    comp = components(norms, links)
    kept = {}
    for n in norms:
        kept[comp[n]] = min(kept.get(comp[n], first[n]), first[n])
    cuts = {}
    for n in norms:
        for place in places[n]:
            if place != kept[comp[n]]:
                cuts.setdefault(place[0], []).append(place[1])
    return {d: sorted(x) for d, x in cuts.items()}
