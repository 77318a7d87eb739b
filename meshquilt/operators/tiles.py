"""A tiled rasteriser with vertex colours: triangles are binned to tiles of a view, tiles are drawn apart, pixels keep the nearest fragment.

Vertices are projected in Spark; a triangle becomes a row for every tile of ``TILE`` pixels that its box touches, so neither a picture nor a
model is ever held whole and a triangle that fills a large picture is spread over tasks. A task draws the rows it has, in batches: fragments at pixel centres
with weights of at least -1e-8, depth and colours perspective-correct; of the fragments of a pixel it keeps the nearest,
of equal ones that of the smallest face id. A grouped minimum by (depth, face) joins what tasks have of one pixel, so a tile that holds
most of a corpus is still the work of many tasks.

A model of at most ``MOST_DRAWN`` triangles and vertices over all views, whose pictures have ``MOST_PIXELS`` pixels at most, needs no tiles: it is one packed row, seen from all views
in the task that has it, and no triangle is repeated and no pixel shuffled. So a corpus of many small models costs one pass, and a large model the tiles.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshquilt.kernels import raster
from meshquilt.operators import views as VW
from meshquilt.sources.scratch import scratch, stored

TILE = 64
#: Triangles (and vertices) of a model times views, and pixels of its pictures, that one task draws without tiles.
MOST_DRAWN, MOST_PIXELS = 1 << 18, 1 << 18
COLOURS = ("r", "g", "b")
CORNERS = [f"{n}{i}" for n in ("px", "py", "z", *COLOURS) for i in range(3)]
OUT = "model_id bigint, view_id int, py int, px int, depth double, face_id bigint, r double, g double, b double"


def binned(vertices: DataFrame, faces: DataFrame, cameras: DataFrame, colours: DataFrame | None = None, cull: bool = False, tile: int = TILE) -> DataFrame:
    """model_id, view_id, fid, tile ty, tx, width, height and the corners' pixels, depths and colours, a row for each tile of each triangle. Triangles behind the camera
    or without area are left out, with ``cull`` those that face away too."""
    v = vertices.select("model_id", "vid", *(F.col(k).alias(f"w{k}") for k in "xyz"))
    if colours is not None:
        v = v.join(colours.select("model_id", "vid", *(F.col(c).cast("double").alias(c) for c in COLOURS)), ["model_id", "vid"], "left")
    t = faces.select("model_id", "fid", "i0", "i1", "i2")
    for i in range(3):
        tint = [(F.coalesce(c, F.lit(0.0)) if colours is not None else F.lit(0.0)).alias(f"{c}{i}") for c in COLOURS]
        t = t.join(v.select("model_id", F.col("vid").alias(f"i{i}"), *(F.col(f"w{k}").alias(f"w{k}{i}") for k in "xyz"), *tint), ["model_id", f"i{i}"])
    # the views come last: a triangle's corners are put together once, whatever the number of views
    t = t.join(cameras, "model_id") if "model_id" in cameras.columns else t.join(VW.layout(cameras), F.lit(True))
    for i in range(3):
        t = t.withColumns(dict(zip((f"px{i}", f"py{i}", f"z{i}"), VW.pixel(*(F.col(f"w{k}{i}") for k in "xyz")), strict=True)))
    area = (F.col("px1") - F.col("px0")) * (F.col("py2") - F.col("py0")) - (F.col("py1") - F.col("py0")) * (F.col("px2") - F.col("px0"))
    t = t.filter((F.least("z0", "z1", "z2") > 1e-8) & (F.abs(area) >= 1e-14) & (area < 0 if cull else F.lit(True)))
    place = lambda v, top: F.greatest(F.lit(0), F.least(v, F.col(top) - 1)).cast("int")  # noqa: E731  the picture's pixels
    box = lambda n: (F.least(*(f"{n}{i}" for i in range(3))), F.greatest(*(f"{n}{i}" for i in range(3))))
    (lx, hx), (ly, hy) = box("px"), box("py")
    seen = (hx >= 0) & (hy >= 0) & (lx <= F.col("width")) & (ly <= F.col("height"))
    span = lambda low, high, top: F.sequence(F.floor(place(F.floor(low - 0.5), top) / tile).cast("int"), F.floor(place(F.ceil(high + 0.5), top) / tile).cast("int"))
    return t.filter(seen).withColumn("ty", F.explode(span(ly, hy, "height"))).withColumn("tx", F.explode(span(lx, hx, "width"))).select("model_id", "view_id", "fid", "ty", "tx", "width", "height", *CORNERS)


def fragments(corner: dict[str, np.ndarray], low: np.ndarray, high: np.ndarray):
    """(row, x, y, depth, colours) of the fragments of triangles, each in its own pixel box (low, high: columns x, y; high excluded)."""
    wide = np.maximum(high - low, 0)
    n = wide[:, 0] * wide[:, 1]
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    x, y = low[row, 0] + place % wide[row, 0], low[row, 1] + place // wide[row, 0]
    px, py, z = (np.stack([corner[f"{c}{i}"] for i in range(3)], axis=1) for c in ("px", "py", "z"))
    area = (px[:, 1] - px[:, 0]) * (py[:, 2] - py[:, 0]) - (py[:, 1] - py[:, 0]) * (px[:, 2] - px[:, 0])
    gx, gy, qx, qy, a, c = x + 0.5, y + 0.5, px[row], py[row], area[row], z[row]
    w0 = ((qx[:, 1] - gx) * (qy[:, 2] - gy) - (qy[:, 1] - gy) * (qx[:, 2] - gx)) / a
    w1 = ((qx[:, 2] - gx) * (qy[:, 0] - gy) - (qy[:, 2] - gy) * (qx[:, 0] - gx)) / a
    w = np.stack((w0, w1, 1 - w0 - w1), axis=1)
    inverse = (w / c).sum(axis=1)
    ok = np.flatnonzero((w >= -1e-8).all(axis=1) & (inverse > 0))
    share = (w[ok] / c[ok]) / inverse[ok, None]
    tint = np.stack([(share * np.stack([corner[f"{k}{i}"] for i in range(3)], axis=1)[row[ok]]).sum(axis=1) for k in COLOURS], axis=1)
    return row[ok], x[ok], y[ok], 1 / inverse[ok], tint


KINDS = ("int64", "int32", "int32", "int32", "float64", "int64", "float64", "float64", "float64")


def _batch(columns):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(c, getattr(pa, k)()) for c, k in zip(columns, KINDS, strict=True)], [f.split()[0] for f in OUT.split(", ")])


def _nearest(depth: np.ndarray, fid: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Places of the nearest fragment of every pixel (``keys``), of equal ones that of the smallest face id."""
    order = np.lexsort((fid, depth, *keys[::-1]))
    key = np.stack(keys, axis=1)[order]
    return order[np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1)))] if len(order) else order


def _in_tiles(vertices: DataFrame, faces: DataFrame, cameras: DataFrame, colours: DataFrame | None, cull: bool, tile: int) -> DataFrame:
    """``drawn`` by tiles, for models of any size."""
    batch = max(16, (1 << 20) // (tile * tile))

    def rows(batches):
        for t in batches:
            get = {n: t.column(n).to_numpy(zero_copy_only=False) for n in t.schema.names}
            for at in range(0, t.num_rows, batch):
                g = {n: v[at : at + batch] for n, v in get.items()}
                size = np.stack((g["width"], g["height"]), axis=1).astype(np.int64)
                first = np.stack((g["tx"], g["ty"]), axis=1).astype(np.int64) * tile
                px, py = (np.stack([g[f"{n}{i}"] for i in range(3)], axis=1) for n in ("px", "py"))
                low, high = raster.boxes(px, py, (px[:, 1] - px[:, 0]) * (py[:, 2] - py[:, 0]) - (py[:, 1] - py[:, 0]) * (px[:, 2] - px[:, 0]), size)
                row, x, y, depth, tint = fragments(g, np.maximum(low, first), np.minimum(high, first + tile))
                best = _nearest(depth, g["fid"][row], g["model_id"][row], g["view_id"][row], y, x)
                r = row[best]
                yield _batch([g["model_id"][r], g["view_id"][r], y[best], x[best], depth[best], g["fid"][r], *tint[best].T])

    found = binned(vertices, faces, cameras, colours, cull, tile).mapInArrow(rows, OUT)
    best = found.groupBy("model_id", "view_id", "py", "px").agg(F.min(F.struct("depth", "face_id", *COLOURS)).alias("f"))
    return best.select("model_id", "view_id", "py", "px", "f.*")


def _whole(vertices: DataFrame, faces: DataFrame, views: list, colours: DataFrame | None, cull: bool) -> DataFrame:
    """``drawn`` of models that are a packed row each; ``views`` as of ``views._views``."""
    names = np.array([view[0] for view in views], np.int32)
    k, r, move = (np.array([view[i] for view in views], float) for i in (1, 2, 3))
    sizes = np.array([view[4:] for view in views], np.int64)

    def pictures(v, f, fids, tint):
        """view, y, x, depth, face id and colours of the covered pixels of one model."""
        cx, cy, cz = (r[:, i, 0, None] * v[:, 0] + r[:, i, 1, None] * v[:, 1] + r[:, i, 2, None] * v[:, 2] + move[:, i, None] for i in range(3))
        safe = np.where(np.abs(cz) > 1e-12, cz, 1e-12)
        px, py = ((k[:, i, 0, None] * cx + k[:, i, 1, None] * cy + k[:, i, 2, None] * cz) / safe for i in range(2))
        px, py, z = (c[:, f].reshape(-1, 3) for c in (px, py, cz))
        view, face = np.repeat(np.arange(len(views)), len(f)), np.tile(np.arange(len(f)), len(views))
        area = (px[:, 1] - px[:, 0]) * (py[:, 2] - py[:, 0]) - (py[:, 1] - py[:, 0]) * (px[:, 2] - px[:, 0])
        use = np.flatnonzero((z.min(axis=1) > 1e-8) & (np.abs(area) >= 1e-14) & ((area < 0) | (not cull)))
        low, high = raster.boxes(px[use], py[use], area[use], sizes[view[use]])
        some = (low < high).all(axis=1)
        use, low, high = use[some], low[some], high[some]
        stop = np.cumsum((high - low).prod(axis=1))
        found, at = [], 0
        while at < len(use):  # as many triangles as have ``raster.PIXELS`` box pixels, or one
            end = max(int(np.searchsorted(stop, (stop[at - 1] if at else 0) + raster.PIXELS, "right")), at + 1)
            u = use[at:end]
            corner = {f"{n}{i}": c[u, i] for n, c in (("px", px), ("py", py), ("z", z)) for i in range(3)} | {f"{n}{i}": tint[f[face[u], i], j] for j, n in enumerate(COLOURS) for i in range(3)}
            row, x, y, depth, shade = fragments(corner, low[at:end], high[at:end])
            fid, seen = fids[face[u[row]]], view[u[row]]
            best = _nearest(depth, fid, seen, y, x)
            found.append([c[best] for c in (seen, y, x, depth, fid, *shade.T)])
            at = end
        if len(found) < 2:
            return found[0] if found else None
        found = [np.concatenate(c) for c in zip(*found, strict=True)]
        best = _nearest(found[3], found[4], *found[:3])
        return [c[best] for c in found]

    def rows(batches):
        out, held = [], 0
        for t in batches:
            for i in range(t.num_rows):
                get = lambda name: t.column(name)[i].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                order = np.argsort(get("vids"))
                vids, v = get("vids")[order], np.stack([get(n) for n in "xyz"], axis=1)[order]
                tint = np.zeros((len(vids), 3))
                if t.column("cids")[i].is_valid:
                    cids = get("cids")
                    at = np.minimum(np.searchsorted(vids, cids), len(vids) - 1)
                    ok = vids[at] == cids
                    tint[at[ok]] = np.stack([get(n) for n in COLOURS], axis=1)[ok]
                named = np.stack([get(n) for n in ("i0", "i1", "i2")], axis=1)
                f = np.minimum(np.searchsorted(vids, named), len(vids) - 1)
                ok = (vids[f] == named).all(axis=1)  # a face whose corner names no vertex is not drawn
                columns = pictures(v, f[ok], get("fids")[ok], tint)
                if columns is not None:
                    out.append([np.full(len(columns[0]), t.column("model_id")[i].as_py()), names[columns[0]], *columns[1:]])
                    held += len(columns[0])
                if held >= 1 << 16:
                    yield _batch([np.concatenate(c) for c in zip(*out, strict=True)])
                    out, held = [], 0
        if out:
            yield _batch([np.concatenate(c) for c in zip(*out, strict=True)])

    def lists(df, ids, **columns):
        """A row a model: lists of the columns."""
        p = df.groupBy("model_id").agg(F.collect_list(F.struct(*(c.alias(n) for n, c in columns.items()))).alias("p"))
        return p.select("model_id", F.col("p")[next(iter(columns))].alias(ids), *(F.col(f"p.{n}") for n in list(columns)[1:]))

    number = lambda c, other: F.coalesce(F.col(c).cast("double"), F.lit(other))
    met = lists(vertices.dropna(subset=["vid"]), "vids", vid=F.col("vid"), **{n: number(n, float("nan")) for n in "xyz"})
    met = met.join(lists(faces.dropna(subset=["i0", "i1", "i2"]), "fids", **{n: F.col(n) for n in ("fid", "i0", "i1", "i2")}), "model_id")
    if colours is None:
        met = met.withColumn("cids", F.lit(None).cast("array<bigint>"))
    else:
        met = met.join(lists(colours.dropna(subset=["vid"]), "cids", vid=F.col("vid"), **{n: number(n, 0.0) for n in COLOURS}), "model_id", "left")
    return met.mapInArrow(rows, OUT)


def drawn(vertices: DataFrame, faces: DataFrame, cameras: DataFrame, colours: DataFrame | None = None, cull: bool = False, tile: int = TILE) -> DataFrame:
    """The covered pixels: model_id, view_id, py, px, depth, face_id and colours r, g, b (not rounded). ``colours``: model_id, vid, r, g, b. Cameras with a
    model_id, and models or pictures too large for one task, are drawn by tiles."""
    views = None if "model_id" in cameras.columns else VW._views(VW.layout(cameras))
    if not views or sum(w * h for *_, w, h in views) > MOST_PIXELS:
        return _in_tiles(vertices, faces, cameras, colours, cull, tile)
    many = lambda df: df.groupBy("model_id").agg(F.count("*").alias("n")).filter(F.col("n") * len(views) > MOST_DRAWN).select("model_id")
    large = stored(many(faces).union(many(vertices)).distinct(), scratch(vertices.sparkSession))
    if large.isEmpty():
        return _whole(vertices, faces, views, colours, cull)
    of = lambda how: [None if df is None else df.join(large, "model_id", how) for df in (vertices, faces, colours)]
    (sv, sf, sc), (lv, lf, lc) = of("left_anti"), of("left_semi")
    return _whole(sv, sf, views, sc, cull).unionByName(_in_tiles(lv, lf, cameras, lc, cull, tile))


def rounded_colours(pixels: DataFrame) -> DataFrame:
    """Colours as bytes: rounded half to even, from 0 to 255."""
    return pixels.withColumns({c: F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.rint(c))).cast("int") for c in COLOURS})


cloudpickle.register_pickle_by_value(sys.modules[__name__])
