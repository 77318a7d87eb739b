"""The tiled rasteriser against the whole-picture kernel, colours by hand, tiles of several sizes."""

import numpy as np
import pytest

from meshquilt.kernels import raster
from meshquilt.operators import tiles as TI
from meshquilt.operators import views as VW
from test_mesh import cube, mesh, sphere


def camera(spark, size, centre=(3.0, 0.2, 0.1), fov=60.0):
    rows = VW._rows([np.array(centre), np.array([0.3, -2.0, 1.5])], ["a", "b"], size, fov)
    return spark.createDataFrame(rows, VW.CAMERA), rows


def soup(seed, n=120):
    rng = np.random.default_rng(seed)
    v = (rng.uniform(-0.8, 0.8, (n, 1, 3)) + rng.normal(size=(n, 3, 3)) * rng.choice([0.02, 0.3, 1.5], (n, 1, 1))).reshape(-1, 3)
    return v, np.arange(3 * n).reshape(-1, 3)


@pytest.mark.parametrize(("tile", "size", "cull"), [(64, 96, False), (8, 40, True), (7, 33, False)])
def test_tiles_equal_the_whole_picture(spark, tile, size, cull):
    cams, rows = camera(spark, size)
    for model, (v, f) in enumerate((soup(1), sphere(2), cube())):
        dv, df = mesh(spark, v, f, model)
        got = {(r["view_id"], r["py"], r["px"]): (r["depth"], r["face_id"]) for r in TI.drawn(dv, df, cams, cull=cull, tile=tile).collect()}
        want = {}
        for view, _, k, r, t, w, h in rows:
            depth, ids = raster.rasterize(v, f, np.array(k).reshape(3, 3), np.array(r).reshape(3, 3), np.array(t), w, h, cull)
            want |= {(view, int(y), int(x)): (depth[y, x], int(ids[y, x])) for y, x in zip(*np.nonzero(ids >= 0), strict=True)}
        assert set(got) == set(want) and len(want) > 20
        assert all(abs(got[p][0] - want[p][0]) < 1e-9 for p in want)
        assert sum(got[p][1] != want[p][1] for p in want) <= len(want) // 50  # pixels on an edge of two faces


def test_colours_are_perspective_correct_and_the_nearest_wins(spark):
    rows = VW._rows([np.array((0.0, 0.0, 4.0))], ["top"], 21, 60.0)
    cams = spark.createDataFrame(rows, VW.CAMERA)
    v = np.array([[-1.5, -1.5, 2.0], [1.5, -1.5, -2.0], [0.0, 2.0, 0.0], [-9, -9, -5], [9, -9, -5], [0, 9, -5]], float)
    dv, df = mesh(spark, v, [[3, 4, 5], [0, 1, 2]], 5)
    tint = spark.createDataFrame([(5, i, *c) for i, c in enumerate([(255.0, 0.0, 0.0), (0.0, 255.0, 0.0), (0.0, 0.0, 255.0), *[(9.0, 9.0, 9.0)] * 3])], "model_id long, vid long, r double, g double, b double")
    got = {(r["px"], r["py"]): r for r in TI.drawn(dv, df, cams, tint, tile=5).collect()}
    view, _, k, r, t, w, h = rows[0]
    k, r, t = np.array(k).reshape(3, 3), np.array(r).reshape(3, 3), np.array(t)
    a, b, c = v[:3]
    seen = 0
    for (px, py), row in got.items():
        ray = r.T @ np.linalg.solve(k, [px + 0.5, py + 0.5, 1.0])  # the point of the plane that the pixel's ray meets
        origin, n = -r.T @ t, np.cross(b - a, c - a)
        s = n @ (a - origin) / (n @ ray)
        p = origin + s * ray
        w = np.linalg.solve(np.stack((a, b, c)).T, p) if abs(np.linalg.det(np.stack((a, b, c)))) > 1e-9 else np.linalg.lstsq(np.vstack((np.stack((a, b, c)).T, np.ones(3))), [*p, 1], rcond=None)[0]
        if (w > 1e-6).all():
            seen += 1
            assert row["face_id"] == 1 and np.allclose([row["r"], row["g"], row["b"]], 255 * w, atol=1e-6) and abs(row["depth"] - s) < 1e-9
        elif (w < -1e-6).any():
            assert row["face_id"] == 0 and abs(row["r"] - 9) < 1e-9
    assert seen > 10
    for r in TI.rounded_colours(TI.drawn(dv, df, cams, tint)).collect():
        assert all(isinstance(r[c], int) and 0 <= r[c] <= 255 for c in "rgb")


def test_a_large_triangle_is_spread_over_tiles(spark):
    cams, _ = camera(spark, 256, fov=20.0)
    dv, df = mesh(spark, np.array([[0, -50, -50], [0, 50, -50], [0, 0, 80]], float), [[0, 1, 2]])
    tiles = TI.binned(dv, df, cams.filter("view_id = 0"), tile=32)
    assert tiles.count() == 64 and TI.drawn(dv, df, cams.filter("view_id = 0"), tile=32).count() == 256 * 256


def test_nothing_to_draw(spark):
    cams, _ = camera(spark, 16)
    dv, df = mesh(spark, np.array([[0, 0, 0], [1, 0, 0], [2, 0, 0], [9, 9, 9], [9, 8, 9], [9, 9, 8]], float), [[0, 1, 2], [3, 4, 5], [0, 0, 1]])
    assert TI.drawn(dv, df, cams.filter("view_id = 0")).count() == 0 and TI.drawn(dv.limit(0), df, cams).count() == 0


def test_small_models_are_drawn_whole_and_equal_their_tiles(spark, monkeypatch):
    """What is packed is drawn without a row for each triangle, view and tile, and no pixel is shuffled; a large model beside it is drawn by tiles."""
    cams, _ = camera(spark, 40)
    meshes = [mesh(spark, *m, model) for model, m in enumerate((soup(3), sphere(2), cube()))]
    dv, df = meshes[0][0].union(meshes[1][0]).union(meshes[2][0]), meshes[0][1].union(meshes[1][1]).union(meshes[2][1])
    lost = df.union(spark.createDataFrame([(2, 99, 0, 1, 777)], df.schema))  # a corner that names no vertex
    tint = dv.filter("vid % 5 <> 0").select("model_id", "vid", *((dv.vid * n % 256).cast("double").alias(c) for n, c in ((3, "r"), (7, "g"), (11, "b"))))
    seen = {}
    real = TI.binned

    def watched(vertices, *rest):
        seen["tiles"] = sorted(r["model_id"] for r in vertices.select("model_id").distinct().collect())
        return real(vertices, *rest)

    monkeypatch.setattr(TI, "binned", watched)
    for cull in (False, True):
        got = {}
        for most in (TI.MOST_DRAWN, 700, 0):  # all packed; the soup and the sphere by tiles; all by tiles
            seen["tiles"] = []
            with monkeypatch.context() as m:
                m.setattr(TI, "MOST_DRAWN", most)
                got[most] = sorted(map(tuple, TI.drawn(dv, lost, cams, tint, cull, tile=8).collect()))
            assert seen["tiles"] == {0: [0, 1, 2], 700: [0], TI.MOST_DRAWN: []}[most]
        assert len(got[0]) > 500 and len({r[0] for r in got[0]}) == 3
        for rows in got.values():
            assert [r[:4] for r in rows] == [r[:4] for r in got[0]]
            assert np.allclose([r[4] for r in rows], [r[4] for r in got[0]], rtol=0, atol=1e-9)
            same = [(a, b) for a, b in zip(rows, got[0], strict=True) if a[5] == b[5]]
            assert len(same) >= len(rows) * 0.98 and all(np.allclose(a[6:], b[6:], atol=1e-5) for a, b in same)


def test_no_fragment_lies_outside_its_box():
    """The boxes hold every pixel that a wide one finds, slivers and far corners too."""
    rng = np.random.default_rng(9)
    size, hits = np.array([24, 20]), 0
    for spread, thin in ((0.4, 1.0), (3.0, 1e-3), (30.0, 1e-7), (2000.0, 1e-9), (1e6, 1.0)):
        p = rng.uniform(-2, 26, (400, 1, 2)) + rng.normal(size=(400, 3, 2)) * spread * np.array([1.0, thin])
        p[::4] = np.round(p[::4] * 2) / 2  # corners on pixel centres and edges
        corner = {f"{n}{i}": p[:, i, j] for j, n in enumerate(("px", "py")) for i in range(3)} | {f"{n}{i}": np.ones(400) for n in ("z", *TI.COLOURS) for i in range(3)}
        area = (p[:, 1, 0] - p[:, 0, 0]) * (p[:, 2, 1] - p[:, 0, 1]) - (p[:, 1, 1] - p[:, 0, 1]) * (p[:, 2, 0] - p[:, 0, 0])
        ok = np.abs(area) >= 1e-14
        corner, p, area = {n: c[ok] for n, c in corner.items()}, p[ok], area[ok]
        wide = np.maximum(np.floor(p.min(axis=1) - 0.5), 0).astype(int), np.minimum(np.ceil(p.max(axis=1) + 0.5), size).astype(int)
        want, got = (set(zip(*(a.tolist() for a in TI.fragments(corner, *box)[:3]), strict=True)) for box in (wide, raster.boxes(p[..., 0], p[..., 1], area, size)))
        assert got == want
        hits += len(want)
    assert hits > 1000
