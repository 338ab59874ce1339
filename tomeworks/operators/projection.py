"""Maps of vectors: density clusters and two-dimensional layouts, block by block.

A block (a coarse cell, such as plans.normalise.cells gives) is laid out in one task and needs the square of its size in
memory, so blocks are to have a bounded size. All results follow from the vectors and the seed alone."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def distances(x: np.ndarray, metric: str = "euclidean") -> np.ndarray:
    if metric == "cosine":
        u = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        d = np.maximum(1 - u @ u.T, 0)
    elif metric == "euclidean":
        s = (x * x).sum(1)
        d = np.sqrt(np.maximum(s[:, None] + s - 2 * x @ x.T, 0))
    else:
        raise ValueError(f"no such metric: {metric}")
    np.fill_diagonal(d, 0)
    return d


def _spanning_tree(d: np.ndarray) -> list[tuple[float, int, int]]:
    """Edges of a minimum spanning tree by rising weight; ties go to the lower index."""
    n = len(d)
    best, source, inside, edges = d[0].copy(), np.zeros(n, int), np.zeros(n, bool), []
    inside[0] = True
    for _ in range(n - 1):
        j = int(np.where(inside, np.inf, best).argmin())
        edges.append((float(best[j]), int(source[j]), j))
        inside[j] = True
        closer = ~inside & (d[j] < best)
        best[closer], source[closer] = d[j][closer], j
    return sorted(edges)


def hdbscan(x: np.ndarray, min_cluster_size: int = 25, min_samples: int | None = None, metric: str = "euclidean") -> np.ndarray:
    """Cluster of each vector, numbered by first member; -1 is noise. Clusters are those of greatest excess of mass in the
    hierarchy of mutual reachability, the root not among them."""
    n = len(x)
    if n < 2 * min_cluster_size or n < 2:
        return np.full(n, -1)
    d = distances(x, metric)
    k = min(min_samples or min_cluster_size, n)
    core = np.partition(d, k - 1, axis=1)[:, k - 1]
    d = np.maximum(d, np.maximum(core[:, None], core))
    # the single-linkage tree: nodes n and up join two others
    top, left, right, height, size = list(range(n)), {}, {}, {}, dict.fromkeys(range(n), 1)

    def find(a: int) -> int:
        while top[a] != a:
            top[a] = top[top[a]]
            a = top[a]
        return a

    for w, a, b in _spanning_tree(d):
        a, b, new = find(a), find(b), len(top)
        top.append(new)
        top[a] = top[b] = new
        left[new], right[new], height[new], size[new] = a, b, w, size[a] + size[b]

    def leaves(node: int) -> list[int]:
        out, todo = [], [node]
        while todo:
            m = todo.pop()
            if m < n:
                out.append(m)
            else:
                todo += (left[m], right[m])
        return out

    # condensed clusters: a split counts where both sides are large enough, smaller sides fall out as points
    born, gain, split, members = {}, {}, {}, {}
    root = len(top) - 1
    todo = [(root, 0.0)]
    while todo:
        start, since = todo.pop()
        born[start], gain[start], split[start], members[start], node = since, 0.0, (), leaves(start), start
        while node >= n:
            level = 1 / max(height[node], 1e-12)
            a, b = left[node], right[node]
            large = [c for c in (a, b) if size[c] >= min_cluster_size]
            gain[start] += (size[node] - (size[large[0]] if len(large) == 1 else 0)) * (level - since)
            if len(large) == 2:
                split[start] = (a, b)
                todo += [(a, level), (b, level)]
            if len(large) != 1:
                break
            node = large[0]
    chosen: dict[int, list[int]] = {}
    for c in sorted(born):  # children come before their parents
        below = [m for s in split[c] for m in chosen[s]]
        within = sum(gain[s] for s in split[c])
        if split[c] and (c == root or within > gain[c]):
            chosen[c], gain[c] = below, within
        else:
            chosen[c] = [] if c == root else [c]
    out = np.full(n, -1)
    for i, c in enumerate(sorted(chosen[root], key=lambda c: min(members[c]))):
        out[members[c]] = i
    return out


def _pca(x: np.ndarray, size: int = 2) -> np.ndarray:
    """Leading components; of each, the greatest loading is positive."""
    c = x - x.mean(0)
    _, _, v = np.linalg.svd(c, full_matrices=False)
    v = v[:size] * np.sign(v[:size][np.arange(len(v[:size])), np.abs(v[:size]).argmax(1)])[:, None]
    out = c @ v.T
    return np.pad(out, ((0, 0), (0, size - out.shape[1])))


def _bandwidths(d: np.ndarray, target: float, weight: Callable[[np.ndarray, np.ndarray], np.ndarray], total: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The bandwidth of each row at which total(weight(row, bandwidth)) is the target, by bisection."""
    lo, hi, mid = np.zeros(len(d)), np.full(len(d), np.inf), np.ones(len(d))
    for _ in range(64):
        above = total(weight(d, mid[:, None])) > target
        hi, lo = np.where(above, mid, hi), np.where(above, lo, mid)
        mid = np.where(np.isinf(hi), mid * 2, (lo + hi) / 2)
    return mid


def tsne(x: np.ndarray, perplexity: float = 30.0, steps: int = 500, metric: str = "euclidean") -> np.ndarray:
    """Exact t-SNE in two dimensions from the leading components on."""
    n = len(x)
    if n < 4:
        return _pca(x) if n > 1 else np.zeros((n, 2))
    d = distances(x, metric) ** 2
    d /= max(float(np.median(d)), 1e-12)
    np.fill_diagonal(d, np.inf)

    def weight(d: np.ndarray, s: np.ndarray) -> np.ndarray:
        near = d.min(1, keepdims=True)
        p = np.exp(-(d - near) / np.maximum(s, 1e-12))
        return p / p.sum(1, keepdims=True)

    entropy = lambda p: -(p * np.log(np.maximum(p, 1e-300))).sum(1)
    p = weight(d, _bandwidths(d, np.log(min(perplexity, (n - 1) / 3)), weight, entropy)[:, None])
    p = np.maximum((p + p.T) / (2 * n), 1e-12)
    y = _pca(x)
    y = y / max(float(y[:, 0].std()), 1e-12) * 1e-4
    move, rate = np.zeros_like(y), max(n / 48, 50.0)
    gains = np.ones_like(y)
    for step in range(steps):
        q = 1 / (1 + distances(y) ** 2)
        np.fill_diagonal(q, 0)
        w = ((12 if step < steps // 4 else 1) * p - q / q.sum()) * q
        slope = 4 * (w.sum(1)[:, None] * y - w @ y)
        gains = np.maximum(np.where(np.sign(slope) == np.sign(move), gains * 0.8, gains + 0.2), 0.01)
        move = (0.5 if step < steps // 4 else 0.8) * move - rate * gains * slope
        y = y + move
        y -= y.mean(0)
    return y


def umap(x: np.ndarray, neighbors: int = 30, min_dist: float = 0.1, steps: int = 200, metric: str = "cosine", seed: int = 7) -> np.ndarray:
    """A two-dimensional layout of the fuzzy neighbour graph: near ones attract along its edges, random ones repel."""
    n = len(x)
    if n < 4:
        return _pca(x) if n > 1 else np.zeros((n, 2))
    d = distances(x, metric)
    np.fill_diagonal(d, np.inf)
    k = min(neighbors, n - 1)
    near = np.argsort(d, axis=1, kind="stable")[:, :k]
    dn = np.take_along_axis(d, near, 1)
    gap = lambda d, s: np.exp(-np.maximum(d - dn[:, :1], 0) / np.maximum(s, 1e-12))
    w = np.zeros((n, n))
    np.put_along_axis(w, near, gap(dn, _bandwidths(dn, np.log2(k) if k > 1 else 1.0, gap, lambda p: p.sum(1))[:, None]), 1)
    w = w + w.T - w * w.T
    # the curve 1 / (1 + a r^2b) that follows min_dist best, by least squares over a grid
    r = np.linspace(0, 3, 300)
    want = np.where(r < min_dist, 1, np.exp(-(r - min_dist)))
    a, b = min(((a, b) for a in np.geomspace(0.1, 10, 80) for b in np.linspace(0.4, 2, 65)), key=lambda ab: ((1 / (1 + ab[0] * r ** (2 * ab[1])) - want) ** 2).sum())
    i, j = np.nonzero(w)
    strength = w[i, j] / w.max()
    rng = np.random.default_rng(seed)
    y = _pca(x)
    y = y / max(float(np.abs(y).max()), 1e-12) * 10 + rng.normal(0, 1e-4, y.shape)
    for step in range(steps):
        alpha = 1 - step / steps
        now = rng.random(len(i)) < strength
        s, t = i[now], j[now]
        diff = y[s] - y[t]
        sq = np.maximum((diff**2).sum(1, keepdims=True), 1e-8)
        pull = np.clip(-2 * a * b * sq ** (b - 1) / (1 + a * sq**b) * diff, -4, 4)
        change = np.zeros_like(y)
        np.add.at(change, s, pull)
        other = rng.integers(0, n, (len(s), 5))
        diff = y[s][:, None] - y[other]
        sq = (diff**2).sum(2, keepdims=True)
        push = np.clip(2 * b / ((0.001 + sq) * (1 + a * sq**b)) * diff, -4, 4).sum(1)
        np.add.at(change, s, push)
        many = np.maximum(np.bincount(s, minlength=n), 1)[:, None]
        y = y + alpha * change / many
    return y


def cluster_map(df: DataFrame, block: str, item: str, vector: str, neighbors: int = 30, min_cluster_size: int = 25, layout: str = "umap", metric: str = "cosine") -> DataFrame:
    """block, item, cluster_id (-1: noise), x, y: a layout of each block (umap, tsne or pca) and the density clusters
    found in it. Null vectors are left out."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(item)
        x = np.stack(pdf[vector].map(np.asarray)).astype(float)
        if layout == "umap":
            y = umap(x, neighbors, metric=metric)
        elif layout == "tsne":
            y = tsne(x, neighbors, metric=metric)
        else:
            y = _pca(x) if len(x) > 1 else np.zeros((1, 2))
        return pd.DataFrame({block: pdf[block], item: pdf[item], "cluster_id": hdbscan(y, min_cluster_size).astype("int32"), "x": y[:, 0], "y": y[:, 1]})

    if layout not in ("umap", "tsne", "pca"):
        raise ValueError(f"no such layout: {layout}")
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.where(f"{vector} is not null").select(block, item, vector).groupBy(block).applyInPandas(run, f"{block} {kinds[block]}, {item} {kinds[item]}, cluster_id int, x double, y double")
