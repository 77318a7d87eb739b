"""Quadric edge collapse with provenance (Garland and Heckbert), union-find, winding repair (NumPy and heapq)."""

from __future__ import annotations

import heapq
import math
from operator import add

import numpy as np


def find(parent: list | np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return int(i)


def components(n: int, edges: np.ndarray) -> np.ndarray:
    """Dense component labels in the order of the smallest member."""
    parent = list(range(n))
    for a, b in np.asarray(edges).tolist():
        a, b = find(parent, a), find(parent, b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    roots = np.array([find(parent, i) for i in range(n)], np.int64)
    return np.unique(roots, return_inverse=True)[1]


def collapse(vertices: np.ndarray, faces: np.ndarray, target: int, least: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Collapse edges until ``target`` vertices are left or none can go: (vertices, faces, old vertex -> new vertex,
    history of (kept, removed)). A collapse must not flip a face, must keep the surface manifold around it, and never
    joins components, since only edges collapse."""
    # three and four numbers at a time: lists of Python floats are a multiple faster here than arrays of that size
    v = np.asarray(vertices, float).reshape(-1, 3).tolist()
    f = np.asarray(faces, np.int64).reshape(-1, 3).tolist()
    n = len(v)
    owner, alive, live = list(range(n)), [True] * len(f), [True] * n
    around: list[set] = [set() for _ in range(n)]
    uses: dict = {}
    quadric, normal = [[0.0] * 10 for _ in range(n)], []
    for k, tri in enumerate(f):
        for i in tri:
            around[i].add(k)
        for i, j in ((0, 1), (1, 2), (2, 0)):
            e = (min(tri[i], tri[j]), max(tri[i], tri[j]))
            uses[e] = uses.get(e, 0) + 1
        x, y, z = _normal(*(v[i] for i in tri))
        normal.append((x, y, z))
        size = math.sqrt(x * x + y * y + z * z)
        if size > 0:
            at = v[tri[0]]
            w = -(x * at[0] + y * at[1] + z * at[2]) / size
            x, y, z = x / size, y / size, z / size
            plane = [c * size for c in (x * x, x * y, x * z, x * w, y * y, y * z, y * w, z * z, z * w, w * w)]
            for i in set(tri):
                quadric[i] = list(map(add, quadric[i], plane))
    for i in range(n):
        live[i] = bool(around[i])
    border = {i for e, u in uses.items() if u == 1 for i in e}

    def offer(i, j):
        xx, xy, xz, xw, yy, yz, yw, zz, zw, ww = map(add, quadric[i], quadric[j])
        p, q = v[i], v[j]
        if i in border and j not in border:
            spots = (p,)
        elif j in border and i not in border:
            spots = (q,)
        else:
            spots = ([(p[0] + q[0]) / 2, (p[1] + q[1]) / 2, (p[2] + q[2]) / 2], p, q)
        best = None
        for s in spots:
            x, y, z = s
            cost = (x * xx + y * xy + z * xz + xw) * x + (x * xy + y * yy + z * yz + yw) * y + (x * xz + y * yz + z * zz + zw) * z + (x * xw + y * yw + z * zw + ww)
            if best is None or cost < best:
                best, spot = cost, s
        return max(best, 0.0), spot

    version = [0] * n
    heap = [(offer(i, j)[0], i, j, 0, 0) for i, j in sorted(uses)]
    heapq.heapify(heap)
    history, left = [], sum(live)
    while heap and left > max(target, least):
        _, i, j, vi, vj = heapq.heappop(heap)
        if not (live[i] and live[j]) or (version[i], version[j]) != (vi, vj):
            continue
        shared = around[i] & around[j]
        if not shared or (i in border and j in border and len(shared) != 1):
            continue
        ring = set().union(*[f[k] for k in around[i]]).intersection(set().union(*[f[k] for k in around[j]]))
        if len(ring - {i, j}) != len(shared):
            continue
        _, spot = offer(i, j)
        bad, turned = False, []
        for k in (around[i] | around[j]) - shared:
            o, p, q = f[k]
            a = normal[k]
            b = _normal(spot if o == i or o == j else v[o], spot if p == i or p == j else v[p], spot if q == i or q == j else v[q])
            if a[0] * b[0] + a[1] * b[1] + a[2] * b[2] <= 0:
                bad = True
                break
            turned.append((k, b))
        if bad:
            continue
        for k, b in turned:
            normal[k] = b
        v[i], quadric[i] = spot, list(map(add, quadric[i], quadric[j]))
        live[j], owner[j] = False, i
        left -= 1
        history.append((i, j))
        for k in shared:
            alive[k] = False
            for x in f[k]:
                around[x].discard(k)
        for k in list(around[j]):
            f[k] = [i if x == j else x for x in f[k]]
            around[i].add(k)
        around[j].clear()
        if j in border:
            border.add(i)
        version[i] += 1
        for x in set().union(*[f[k] for k in around[i]]) - {i}:
            a, b = min(i, x), max(i, x)
            heapq.heappush(heap, (offer(a, b)[0], a, b, version[a], version[b]))
    kept = np.flatnonzero(live)
    new = np.full(n, -1, np.int64)
    new[kept] = np.arange(len(kept))
    to = np.array([new[find(owner, i)] for i in range(n)], np.int64)
    out = np.array(v, float).reshape(-1, 3), np.array(f, np.int64).reshape(-1, 3)
    return out[0][kept], new[out[1][np.array(alive, bool)]], to, history


def _normal(a, b, c) -> tuple[float, float, float]:
    """The cross product of two sides."""
    ux, uy, uz, wx, wy, wz = b[0] - a[0], b[1] - a[1], b[2] - a[2], c[0] - a[0], c[1] - a[1], c[2] - a[2]
    return uy * wz - uz * wy, uz * wx - ux * wz, ux * wy - uy * wx


def by_component(vertices: np.ndarray, faces: np.ndarray, ratio: float, least: int = 4):
    """Each component to max(least, round(n ratio)) vertices; a component that comes out invalid stays as it was. The last
    return is 1 for components that were simplified."""
    edges = np.concatenate([faces[:, [0, 1]], faces[:, [1, 2]], faces[:, [2, 0]]])
    label = components(len(vertices), np.unique(np.sort(edges, axis=1), axis=0))
    out_v, out_f, to, base, done = [], [], np.full(len(vertices), -1, np.int64), 0, []
    for c in range(label.max(initial=-1) + 1):
        own = np.flatnonzero(label == c)
        place = np.full(len(vertices), -1, np.int64)
        place[own] = np.arange(len(own))
        f = place[faces[label[faces[:, 0]] == c]] if len(faces) else np.empty((0, 3), np.int64)
        if not len(f):
            continue
        want = max(least, round(len(own) * ratio))
        v2, f2, t2, _ = collapse(vertices[own], f, want, least) if len(own) > want else (vertices[own], f, np.arange(len(own)), [])
        ok = len(f2) > 0 and np.isfinite(v2).all()
        if not ok:
            v2, f2, t2 = vertices[own], f, np.arange(len(own))
        done.append(int(ok and len(v2) < len(own)))
        out_v.append(v2)
        out_f.append(f2 + base)
        to[own] = np.where(t2 >= 0, t2 + base, -1)
        base += len(v2)
    return np.concatenate(out_v or [np.empty((0, 3))]), np.concatenate(out_f or [np.empty((0, 3), np.int64)]), to, done


def consistent_winding(faces: np.ndarray) -> np.ndarray:
    """Faces flipped, breadth first in each component, so that neighbours use their edge in opposite directions."""
    f = faces.copy()
    by: dict = {}
    for k, tri in enumerate(f):
        for i in range(3):
            a, b = int(tri[i]), int(tri[(i + 1) % 3])
            by.setdefault((min(a, b), max(a, b)), []).append(k)
    seen = np.zeros(len(f), bool)
    for start in range(len(f)):
        queue = [] if seen[start] else [start]
        seen[start] = True
        while queue:
            k = queue.pop()
            for i in range(3):
                a, b = int(f[k][i]), int(f[k][(i + 1) % 3])
                for o in by[(min(a, b), max(a, b))]:
                    if not seen[o]:
                        seen[o] = True
                        t = f[o].tolist()
                        if (a, b) in ((t[0], t[1]), (t[1], t[2]), (t[2], t[0])):
                            f[o] = f[o][[0, 2, 1]]
                        queue.append(o)
    return f
