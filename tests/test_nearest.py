"""The grid join for nearest surfaces against all pairs."""

import numpy as np
import pytest

from meshquilt.kernels import closest
from meshquilt.operators import nearest as N
from test_mesh import cube, mesh, sphere

VERTEX = "model_id bigint, vid bigint, x double, y double, z double"


def points(spark, model, p):
    return spark.createDataFrame([(model, i, *map(float, q)) for i, q in enumerate(p)], VERTEX)


def check(spark, v, f, p, model=3):
    dv, df = mesh(spark, v, f, model)
    got = {r["vid"]: r for r in N.surface_targets(points(spark, model, p), dv, df).collect()}
    face, w, d = closest.surface(np.asarray(p, float), v, f)
    assert len(got) == len(p)
    for i in range(len(p)):
        r = got[i]
        assert r["valid"] and r["reason"] is None and abs(r["surface_distance"] - d[i]) <= 1e-12 * max(1, d[i])
        target = (w[i][:, None] * v[f[face[i]]]).sum(axis=0)
        own = sum(r[f"w{k}"] * v[f[r["closest_face"], k]] for k in range(3))
        assert np.allclose(own, [r["tx"], r["ty"], r["tz"]], atol=1e-12)
        if np.linalg.norm(target - own) > 1e-9:  # another point as near
            assert abs(np.linalg.norm(own - np.asarray(p[i])) - d[i]) < 1e-9
        assert np.allclose([r["dx"], r["dy"], r["dz"]], own - p[i], atol=1e-12)
        n = np.linalg.norm([r["nx"], r["ny"], r["nz"]])
        assert abs(n - 1) < 1e-9 or n == 0


def test_points_near_far_and_on_the_surface(spark):
    rng = np.random.default_rng(1)
    v, f = sphere(2)
    p = np.concatenate((rng.normal(size=(60, 3)), v[:10], v[:20] * 1.01, rng.normal(size=(10, 3)) * 50, [[0, 0, 0]]))
    check(spark, v, f, p)


def test_triangles_of_very_different_sizes(spark):
    rng = np.random.default_rng(2)
    small = rng.uniform(-1, 1, (40, 1, 3)) + rng.normal(size=(40, 3, 3)) * 0.003
    large = rng.normal(size=(4, 3, 3)) * 20
    flat = np.array([[[1.0, 1, 1]] * 3, [[0, 0, 0], [1, 1, 1], [2, 2, 2]]])  # a point and a line
    v = np.concatenate((small, large, flat)).reshape(-1, 3)
    check(spark, v, np.arange(len(v)).reshape(-1, 3), rng.normal(size=(120, 3)) * rng.choice([0.1, 1, 10], (120, 1)))


def test_one_triangle_and_a_mesh_that_is_a_point(spark):
    check(spark, np.array([[0.0, 0, 0], [1e-3, 0, 0], [0, 1e-3, 0]]), np.array([[0, 1, 2]]), [[5.0, 5, 5], [0, 0, 0], [1e3, 0, 0]])
    check(spark, np.full((3, 3), 2.0), np.array([[0, 1, 2]]), [[2.0, 2, 2], [3, 2, 2], [-90, 2, 2]])


def test_what_cannot_be_projected_is_reported(spark):
    v, f = cube()
    dv, df = mesh(spark, v, f, 1)
    dv2, _ = mesh(spark, v, f, 2)
    q = points(spark, 1, [[2, 0, 0], [float("nan"), 0, 0], [float("inf"), 0, 0]]).unionByName(points(spark, 2, [[0, 0, 0]]))
    got = {(r["model_id"], r["vid"]): (r["valid"], r["reason"]) for r in N.surface_targets(q, dv.unionByName(dv2), df).collect()}
    assert got == {(1, 0): (True, None), (1, 1): (False, "non_finite_query_vertex"), (1, 2): (False, "non_finite_query_vertex"), (2, 0): (False, "model_without_faces")}
    stats = {r["model_id"]: (r["n"], r["n_missing"], r["max"]) for r in N.surface_distances(q, dv.unionByName(dv2), df).collect()}
    assert stats[2] == (1, 1, None) and stats[1][:2] == (3, 2)
    assert N.nearest_faces(q.limit(0), dv, df).count() == 0


@pytest.mark.parametrize("n", [400])
def test_pairs_stay_few(spark, n):
    """A point near the surface meets the triangles around it, not all of them."""
    v, f = sphere(4)
    dv, df = mesh(spark, v, f)
    seen = []
    real = N._measured
    try:
        N._measured = lambda pairs: (seen.append(pairs.count()), real(pairs))[1]
        p = v[:: max(1, len(v) // n)] * 1.001
        N.nearest_faces(points(spark, 0, p), dv, df).count()
    finally:
        N._measured = real
    assert sum(seen) < len(p) * len(f) / 20
