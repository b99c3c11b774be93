"""Random-projection trees over unit vectors, with overlap at every split.

A node splits its vectors by their projection on a random direction, which follows from the seed of the tree and the
node. The bounds are quantiles of the projections on both sides of the median; vectors between them go to both
children, so a near pair is parted only where it lies on both sides of the whole strip. A node is split until its part of
all vectors is at most the wanted leaf.
"""

from __future__ import annotations

import numpy as np

SPILL = 0.05  # of a node's vectors go to both children, on each side of the median
DEPTH = 10  # splits of one fit; larger leaves are fitted again by themselves
LEAST_SAMPLE = 16  # vectors on which a split may rest


def directions(tree: int, leaf: int, nodes: int, size: int) -> np.ndarray:
    """Directions of the nodes (in heap order, from 1) of the subtree below a leaf."""
    return np.random.Generator(np.random.PCG64([tree, leaf & 0xFFFFFFFF, leaf >> 32, 20240401])).standard_normal((nodes, size))


def fitted(sample: np.ndarray, tree: int, leaf: int, share: float) -> np.ndarray:
    """Bounds (nodes x 2) of a subtree, by its nodes in heap order, nan where there is no split.

    ``share``: part of the sample that a leaf may have.
    """
    nodes = 1 << DEPTH
    bounds = np.full((nodes, 2), np.nan)
    way = directions(tree, leaf, nodes, sample.shape[1])
    most = max(LEAST_SAMPLE, share * len(sample))
    open_ = {1: np.arange(len(sample))}
    while open_:
        node, at = open_.popitem()
        if len(at) <= most or node >= nodes:
            continue
        along = sample[at] @ way[node]
        low, high = np.quantile(along, [0.5 - SPILL, 0.5 + SPILL])
        left, right = along <= high, along > low
        if left.all() or right.all():  # many equal projections: no split parts them
            continue
        bounds[node] = low, high
        open_[2 * node], open_[2 * node + 1] = at[left], at[right]
    return bounds


def routed(vectors: np.ndarray, bounds: np.ndarray, tree: int, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the nodes of the subtree in which they end; a row between bounds ends in several."""
    way = directions(tree, leaf, len(bounds), vectors.shape[1])
    row, node = np.arange(len(vectors)), np.ones(len(vectors), np.int64)
    rows, nodes = [], []
    while len(row):
        inner = node < len(bounds)
        inner[inner] = ~np.isnan(bounds[node[inner], 0])
        rows.append(row[~inner])
        nodes.append(node[~inner])
        row, node = row[inner], node[inner]
        along = np.einsum("ij,ij->i", vectors[row], way[node])
        left, right = along <= bounds[node, 1], along > bounds[node, 0]
        row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
    return np.concatenate(rows) if rows else row, np.concatenate(nodes) if nodes else node
