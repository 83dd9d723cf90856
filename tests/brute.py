"""Plain numpy versions of the clustering definitions, for small fixtures only."""

from __future__ import annotations

import numpy as np


def pairwise(x, metric="euclidean"):
    gap = x[:, None, :] - x[None, :, :]
    return np.abs(gap).sum(-1) if metric == "manhattan" else np.sqrt((gap * gap).sum(-1))


def components(adjacent):
    n = len(adjacent)
    label = np.full(n, -1)
    for start in range(n):
        if label[start] >= 0:
            continue
        label[start], stack = start, [start]
        while stack:
            i = stack.pop()
            for j in np.flatnonzero(adjacent[i] & (label < 0)):
                label[j] = start
                stack.append(j)
    return label


def dbscan(x, eps, min_samples, metric="euclidean"):
    near = pairwise(x, metric) <= eps
    core = near.sum(1) >= min_samples
    label = np.full(len(x), -1)
    ids = np.flatnonzero(core)
    comp = components(near[np.ix_(ids, ids)])
    numbers = {c: k for k, c in enumerate(dict.fromkeys(comp.tolist()))}
    label[ids] = [numbers[c] for c in comp]
    for i in np.flatnonzero(~core):
        reach = label[near[i] & core]
        if len(reach):
            label[i] = reach.min()
    return label


def reachability(x, k, metric="euclidean"):
    d = pairwise(x, metric)
    core = np.sort(d, axis=1)[:, k]
    m = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    return m, core


def mst_weight(m):
    n = len(m)
    seen, best, total = np.zeros(n, bool), np.full(n, np.inf), 0.0
    best[0] = 0.0
    for _ in range(n):
        i = int(np.argmin(np.where(seen, np.inf, best)))
        total += best[i]
        seen[i] = True
        best = np.minimum(best, m[i])
    return total


def hdbscan(x, least, k, metric="euclidean"):
    """Top-down condensed tree and excess of mass; label -1 is noise."""
    m, _ = reachability(x, k, metric)
    np.fill_diagonal(m, 0)
    clusters = []

    def grow(points, birth):
        me = {"birth": birth, "points": points, "stability": 0.0, "children": []}
        clusters.append(me)
        alive = points
        while True:
            sub = m[np.ix_(alive, alive)]
            tree_max = bottleneck(sub)
            density = 1 / max(tree_max, 1e-12)
            label = components(sub < tree_max)
            groups = [alive[label == g] for g in dict.fromkeys(label.tolist())]
            big = [g for g in groups if len(g) >= least]
            if len(big) >= 2:
                me["stability"] += len(alive) * (density - birth)
                me["children"] = [grow(g, density) for g in big]
                return me
            if not big:
                me["stability"] += len(alive) * (density - birth)
                return me
            me["stability"] += (len(alive) - len(big[0])) * (density - birth)
            alive = big[0]

    def bottleneck(sub):
        n = len(sub)
        seen, best, worst = np.zeros(n, bool), np.full(n, np.inf), 0.0
        best[0] = 0.0
        for _ in range(n):
            i = int(np.argmin(np.where(seen, np.inf, best)))
            worst = max(worst, best[i])
            seen[i] = True
            best = np.minimum(best, sub[i])
        return worst

    root = grow(np.arange(len(x)), 0.0)

    def choose(c):
        below = [choose(ch) for ch in c["children"]]
        mass = sum(v for v, _ in below)
        if c is not root and c["stability"] >= mass:
            return c["stability"], [c]
        return mass, [s for _, chosen in below for s in chosen]

    label = np.full(len(x), -1)
    for number, c in enumerate(choose(root)[1]):
        label[c["points"]] = number
    return label


def same_partition(a, b, ignore=()):
    keep = [i for i in range(len(a)) if i not in set(ignore)]
    pairs = {(a[i], b[i]) for i in keep}
    return len(pairs) == len({p for p, _ in pairs}) == len({q for _, q in pairs})


def silhouette(x, labels):
    d, out = pairwise(x), []
    for i, mine in enumerate(labels):
        own = (labels == mine) & (np.arange(len(x)) != i)
        if not own.any():
            out.append(0.0)
            continue
        a = d[i][own].mean()
        b = min(d[i][labels == o].mean() for o in set(labels.tolist()) if o != mine)
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.array(out)


def davies_bouldin(x, labels):
    ids = sorted(set(labels.tolist()))
    mu = np.array([x[labels == c].mean(0) for c in ids])
    s = np.array([np.sqrt(((x[labels == c] - mu[i]) ** 2).sum(1)).mean() for i, c in enumerate(ids)])
    d = pairwise(mu)
    if np.allclose(s, 0) or np.allclose(d, 0):
        return 0.0
    d[d == 0] = np.inf
    return float(((s[:, None] + s[None, :]) / d).max(1).mean()) if len(ids) > 1 else 0.0


def calinski_harabasz(x, labels):
    ids = sorted(set(labels.tolist()))
    all_mu, b, w = x.mean(0), 0.0, 0.0
    for c in ids:
        g = x[labels == c]
        b += len(g) * ((g.mean(0) - all_mu) ** 2).sum()
        w += ((g - g.mean(0)) ** 2).sum()
    return 1.0 if w == 0 else b * (len(x) - len(ids)) / (w * (len(ids) - 1))
