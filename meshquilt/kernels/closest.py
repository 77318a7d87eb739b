"""Exact nearest points: uniform-grid search over triangles, blocked nearest neighbours (NumPy only)."""

from __future__ import annotations

import numpy as np


def on_triangles(p: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared distance, barycentric weights) of the nearest point of triangle k to point k. The best of three
    corners, three clamped edges and, where the foot lies inside, the plane."""
    best, weights = np.full(len(p), np.inf), np.zeros((len(p), 3))

    def offer(w):
        q = w[:, :1] * a + w[:, 1:2] * b + w[:, 2:] * c
        d = ((p - q) ** 2).sum(axis=1)
        better = d < best
        best[better], weights[better] = d[better], w[better]

    eye = np.eye(3)
    for k in range(3):
        offer(np.broadcast_to(eye[k], (len(p), 3)))
    corners = (a, b, c)
    for i, j in ((0, 1), (1, 2), (2, 0)):
        side = corners[j] - corners[i]
        t = np.clip(((p - corners[i]) * side).sum(axis=1) / np.maximum((side**2).sum(axis=1), 1e-300), 0, 1)
        w = np.zeros((len(p), 3))
        w[:, i], w[:, j] = 1 - t, t
        offer(w)
    u, v, x = b - a, c - a, p - a
    uu, vv, uv, xu, xv = ((m * n).sum(axis=1) for m, n in ((u, u), (v, v), (u, v), (x, u), (x, v)))
    det = uu * vv - uv * uv
    ok = det > 1e-300
    det = np.where(ok, det, 1)
    s, t = (vv * xu - uv * xv) / det, (uu * xv - uv * xu) / det
    w = np.stack((1 - s - t, s, t), axis=1)
    inside = ok & (w >= -1e-10).all(axis=1)
    w = np.clip(w, 0, None)
    w /= np.maximum(w.sum(axis=1, keepdims=True), 1e-300)
    w[~inside] = (1, 0, 0)
    offer(w)
    return best, weights


def surface(points: np.ndarray, vertices: np.ndarray, faces: np.ndarray, block: int = 1 << 18) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(face, barycentric weights, distance) of the nearest surface point of each point; ties: the smallest face. Faces are
    ordered by a lower bound on their distance (their sphere), so a block stops as soon as no face can be nearer."""
    a, b, c = (vertices[faces[:, k]] for k in range(3))
    centre = (a + b + c) / 3
    radius = np.sqrt(np.maximum.reduce([((q - centre) ** 2).sum(axis=1) for q in (a, b, c)]))
    n = len(points)
    face, weight, dist = np.zeros(n, np.int64), np.zeros((n, 3)), np.full(n, np.inf)
    step = max(1, block // max(len(faces), 1))
    for i in range(0, n, step):
        p = points[i : i + step]
        gap = np.sqrt(((p[:, None, :] - centre[None]) ** 2).sum(axis=2))
        near = gap - radius[None]
        upper = (gap + radius[None]).min(axis=1)  # some point of a face is at most this far
        at, f = np.nonzero(near <= upper[:, None] * (1 + 1e-9) + 1e-12)
        d, w = on_triangles(p[at], a[f], b[f], c[f])
        order = np.lexsort((f, d, at))
        first = order[np.concatenate(([True], at[order][1:] != at[order][:-1]))]
        face[i + at[first]], weight[i + at[first]], dist[i + at[first]] = f[first], w[first], np.sqrt(d[first])
    return face, weight, dist


def nearest(a: np.ndarray, b: np.ndarray, block: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """(index, distance) of the nearest row of b for each row of a; ties: the smallest index."""
    out, dist = np.zeros(len(a), np.int64), np.zeros(len(a))
    step = max(1, block // max(len(b), 1))
    for i in range(0, len(a), step):
        d = ((a[i : i + step, None, :] - b[None]) ** 2).sum(axis=2)
        out[i : i + step] = d.argmin(axis=1)
        dist[i : i + step] = np.sqrt(d.min(axis=1))
    return out, dist
