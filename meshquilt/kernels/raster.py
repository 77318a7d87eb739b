"""Software z-buffer: depth and face ids of a mesh in a pinhole view (NumPy only)."""

from __future__ import annotations

import numpy as np

#: Box pixels that are looked at at once.
PIXELS = 1 << 18


def project(vertices: np.ndarray, k: np.ndarray, r: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pixels and camera depth."""
    cam = vertices @ r.T + t
    z = cam[:, 2]
    safe = np.where(np.abs(z) > 1e-12, z, 1e-12)
    return (cam @ k.T)[:, :2] / safe[:, None], z


def boxes(px: np.ndarray, py: np.ndarray, area: np.ndarray, size) -> tuple[np.ndarray, np.ndarray]:
    """(low, high; high excluded; columns x, y) of the pixels that triangles can cover in pictures of ``size`` (width, height): px, py are (n, 3). A centre beyond the corners
    by a ten-thousandth of the extent has a weight below -5e-5, and the weights' rounding error is under 1e-5 where the area is over 1e-9 of the extent's square: such
    triangles need no centres outside. Slimmer ones keep a pixel around."""
    with np.errstate(all="ignore"):
        least, most = (np.clip(np.nan_to_num(np.stack((m(px, axis=1), m(py, axis=1)), axis=1)), -1e9, 1e9) for m in (np.min, np.max))
        extent = (most - least).max(axis=1)
        beyond = np.where(np.abs(area) > 1e-9 * (extent + 2) ** 2, np.maximum(1e-3, 1e-4 * extent), np.inf)[:, None]
        low, high = np.maximum(np.floor(least - 0.5), np.ceil(least - beyond - 0.5)), np.minimum(np.ceil(most + 0.5), np.floor(most + beyond + 0.5))
    return np.maximum(low, 0).astype(np.int64), np.minimum(high, size).astype(np.int64)


def rasterize(vertices, faces, k, r, t, width: int, height: int, cull: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(depth, +inf where nothing; face id, -1). Pixel centres at +0.5, weights of at least -1e-8, perspective-correct
    depth, strictly nearer wins, so of equal depths the first face stays. ``cull``: front faces only."""
    depth, ids = np.full(height * width, np.inf), np.full(height * width, -1, np.int64)
    px, z = project(vertices, k, r, t)
    faces = np.asarray(faces, np.int64).reshape(-1, 3)
    p, fz = px[faces], z[faces]
    area = (p[:, 1, 0] - p[:, 0, 0]) * (p[:, 2, 1] - p[:, 0, 1]) - (p[:, 1, 1] - p[:, 0, 1]) * (p[:, 2, 0] - p[:, 0, 0])
    drop = (fz <= 1e-8).any(axis=1) | (np.abs(area) < 1e-14)
    if cull:
        drop |= area >= 0
    use = np.flatnonzero(~drop)
    low, high = boxes(p[use, :, 0], p[use, :, 1], area[use], (width, height))
    some = (low < high).all(axis=1)
    use, low, high = use[some], low[some], high[some]
    wide = high[:, 0] - low[:, 0]
    cells = wide * (high[:, 1] - low[:, 1])
    stop = np.cumsum(cells)
    at = 0
    while at < len(use):  # faces in order, as many as have PIXELS box pixels, or one
        end = max(int(np.searchsorted(stop, (stop[at - 1] if at else 0) + PIXELS, "right")), at + 1)
        n = cells[at:end]
        i = np.repeat(np.arange(at, end), n)
        place = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        x, y = low[i, 0] + place % wide[i], low[i, 1] + place // wide[i]
        f = use[i]
        gx, gy, q, a, c = x + 0.5, y + 0.5, p[f], area[f], fz[f]
        w0 = ((q[:, 1, 0] - gx) * (q[:, 2, 1] - gy) - (q[:, 1, 1] - gy) * (q[:, 2, 0] - gx)) / a
        w1 = ((q[:, 2, 0] - gx) * (q[:, 0, 1] - gy) - (q[:, 2, 1] - gy) * (q[:, 0, 0] - gx)) / a
        w2 = 1 - w0 - w1
        inv = w0 / c[:, 0] + w1 / c[:, 1] + w2 / c[:, 2]
        ok = np.flatnonzero((w0 >= -1e-8) & (w1 >= -1e-8) & (w2 >= -1e-8) & (inv > 0))
        d, pixel, f = 1 / inv[ok], y[ok] * width + x[ok], f[ok]
        order = np.lexsort((f, d, pixel))
        d, pixel, f = d[order], pixel[order], f[order]
        first = np.flatnonzero(np.concatenate(([True], pixel[1:] != pixel[:-1]))) if len(pixel) else order
        first = first[d[first] < depth[pixel[first]]]
        depth[pixel[first]], ids[pixel[first]] = d[first], f[first]
        at = end
    return depth.reshape(height, width), ids.reshape(height, width)


def resize_nearest(image: np.ndarray, width: int, height: int) -> np.ndarray:
    y = np.minimum((np.arange(height) + 0.5) * image.shape[0] / height, image.shape[0] - 1).astype(int)
    x = np.minimum((np.arange(width) + 0.5) * image.shape[1] / width, image.shape[1] - 1).astype(int)
    return image[y[:, None], x[None, :]]
