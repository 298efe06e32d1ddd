"""Plain small-data versions that the distributed operators are held against."""

import numpy as np


def brute_density(x, mcs, ms):
    """Labels of density clustering by the textbook top-down route; -1 is noise."""
    x = np.asarray(x, dtype=float)
    n = len(x)
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(dist, axis=1)[:, min(ms, n - 1)]
    reach = np.maximum(np.maximum(dist, core[:, None]), core[None])

    # Lightest edges first, ties by the lower ids, as in the distributed version.
    home, tree = list(range(n)), []
    for w, a, b in sorted((reach[a, b], a, b) for a in range(n) for b in range(a + 1, n)):
        if home[a] != home[b]:
            tree.append((w, a, b))
            old, new = home[b], home[a]
            home = [new if h == old else h for h in home]

    top, kids, leaves = list(range(n)), {}, {i: [i] for i in range(n)}
    for new, (w, a, b) in enumerate(tree, start=n):
        ra, rb = top[a], top[b]
        kids[new] = (ra, rb, 1 / max(w, 1e-12))
        leaves[new] = leaves[ra] + leaves[rb]
        for i in leaves[new]:
            top[i] = new
    root = max(kids)

    exits, parent, birth, todo, fresh = [], {0: None}, {0: 0.0}, [(root, 0)], 1
    while todo:
        node, name = todo.pop()
        while True:
            a, b, lam = kids[node]
            big = [c for c in (a, b) if len(leaves[c]) >= mcs]
            exits += [(i, name, lam) for c in (a, b) if c not in big for i in leaves[c]]
            if len(big) == 1:
                node = big[0]
                continue
            for c in big:
                parent[fresh], birth[fresh] = name, lam
                exits += [(None, name, lam)] * len(leaves[c])
                todo.append((c, fresh))
                fresh += 1
            break

    value = {c: sum(lam - birth[c] for _, name, lam in exits if name == c) for c in parent}
    below = {c: [d for d in parent if parent[d] == c] for c in parent}
    score, flag = {}, {}
    for c in sorted(parent, reverse=True):
        under = sum(score[d] for d in below[c])
        flag[c] = value[c] >= under and c != 0
        score[c] = max(value[c], under)
    labels = np.full(n, -1)
    for i, c, _ in exits:
        if i is None:
            continue
        while c is not None:
            if flag[c]:
                labels[i] = c
            c = parent[c]
    return labels


def groups(labels):
    """A labelling as a set of frozensets, noise apart."""
    found = {}
    for i, c in enumerate(labels):
        found.setdefault(int(c), set()).add(i)
    noise = found.pop(-1, set())
    return {frozenset(g) for g in found.values()}, noise


def brute_silhouette(x, labels):
    """Mean Euclidean silhouette over all rows."""
    x, labels = np.asarray(x, dtype=float), np.asarray(labels)
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    scores = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            scores.append(0.0)
            continue
        a = dist[i][same].sum() / (same.sum() - 1)
        b = min(dist[i][labels == other].mean() for other in set(labels) - {own})
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(scores))
