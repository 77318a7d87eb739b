"""Mesh operators on hand-made meshes, against NumPy, and by invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshquilt import schema
from meshquilt.kernels import closest, raster, simplify
from meshquilt.operators import correspond as C
from meshquilt.operators import digests as DG
from meshquilt.operators import geometry as G
from meshquilt.operators import metrics as M
from meshquilt.operators import subdivide as D
from meshquilt.operators import topology as T
from meshquilt.operators import validate as VA
from meshquilt.sources.corpus import Mesh, orders_mesh


def mesh(spark, vertices, faces, model=1):
    v = spark.createDataFrame([(model, i, *map(float, p)) for i, p in enumerate(vertices)], schema.VERTICES)
    f = spark.createDataFrame([(model, i, *map(int, t)) for i, t in enumerate(faces)], schema.FACES)
    return v, f


def faces_of(df):
    return [tuple(r[k] for k in ("i0", "i1", "i2")) for r in df.orderBy("fid").collect()]


def cube():
    v = [(x, y, z) for x in (-1, 1) for y in (-1, 1) for z in (-1, 1)]
    f = [(0, 1, 3), (0, 3, 2), (4, 6, 7), (4, 7, 5), (0, 4, 5), (0, 5, 1), (2, 3, 7), (2, 7, 6), (0, 2, 6), (0, 6, 4), (1, 5, 7), (1, 7, 3)]
    return np.array(v, float), np.array(f)


def sphere(steps):
    g = (1 + 5**0.5) / 2
    v = [(-1, g, 0), (1, g, 0), (-1, -g, 0), (1, -g, 0), (0, -1, g), (0, 1, g), (0, -1, -g), (0, 1, -g), (g, 0, -1), (g, 0, 1), (-g, 0, -1), (-g, 0, 1)]
    f = [(0, 11, 5), (0, 5, 1), (0, 1, 7), (0, 7, 10), (0, 10, 11), (1, 5, 9), (5, 11, 4), (11, 10, 2), (10, 7, 6), (7, 1, 8), (3, 9, 4), (3, 4, 2), (3, 2, 6), (3, 6, 8), (3, 8, 9), (4, 9, 5), (2, 4, 11), (6, 2, 10), (8, 6, 7), (9, 8, 1)]
    v, f = [np.array(p, float) / np.linalg.norm(p) for p in v], f
    for _ in range(steps):
        mid, new = {}, []

        def half(a, b):
            k = (min(a, b), max(a, b))
            if k not in mid:
                p = v[a] + v[b]
                mid[k] = len(v)
                v.append(p / np.linalg.norm(p))
            return mid[k]

        for a, b, c in f:
            x, y, z = half(a, b), half(b, c), half(c, a)
            new += [(a, x, z), (b, y, x), (c, z, y), (x, y, z)]
        f = new
    return np.array(v), np.array(f)


def test_compaction(spark):
    v, f = mesh(spark, np.arange(15).reshape(5, 3), [(0, 2, 4)])
    _, f2, remap = T.compaction(v, f)
    assert faces_of(f2) == [(0, 1, 2)]
    assert [r["new_vid"] for r in T.old_to_new(v, remap).orderBy("old_vid").collect()] == [0, -1, 1, -1, 2]


def test_midpoint_of_one_triangle(spark):
    v, f = mesh(spark, [(0, 0, 0), (1, 0, 0), (0, 1, 0), (8, 8, 8)], [(0, 1, 2)])
    v2, f2, parents, remap = D.midpoint(v, f)
    assert v2.count() == 6 and f2.count() == 4 and parents.count() == 3
    assert {i for t in faces_of(f2) for i in t} == set(range(6))
    assert VA.midpoint_rules(v.filter("vid < 3"), v2, parents, remap).count() == 0


def test_normalize_and_inverse(spark):
    pts = [(8, -3, 2), (12, -3, 2), (9, 5, -1), (11, 1, 7)]
    v, _ = mesh(spark, pts, [(0, 1, 2)])
    n, frames = G.normalize(v)
    p = np.array([(r.x, r.y, r.z) for r in n.orderBy("vid").collect()])
    assert 1 - 1e-5 <= np.linalg.norm(p, axis=1).max() <= 1 + 1e-6
    assert np.allclose((p.min(axis=0) + p.max(axis=0)) / 2, 0, atol=1e-7)
    back = np.array([(r.x, r.y, r.z) for r in G.denormalize(n, frames).orderBy("vid").collect()])
    assert np.allclose(back, pts, atol=1e-5)
    assert VA.unit_sphere_rules(n).count() == 0 and VA.unit_sphere_rules(v).count() == 2
    with pytest.raises(ValueError):
        G.normalize(v, "longest_side")
    with pytest.raises(ValueError):
        G.normalize(v, eps=0)


def test_cleanup_after_single_precision(spark):
    pts = np.float32([(1, 0, 0), (1 + 1e-8, 0, 0), (1, 1, 0), (0, 0, 1)])
    v, f = mesh(spark, pts, [(0, 1, 2), (0, 2, 3)])
    v2, f2, log = G.clean(v, f, version=1)
    assert faces_of(f2) == [(0, 1, 2)] and v2.count() == 3
    assert {r["step"]: r["removed"] for r in log.collect()}["small_area"] == 1


def test_cleanup_version_two(spark):
    v, f = mesh(spark, [(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (float("nan"), 0, 0)], [(0, 1, 2), (2, 1, 0), (0, 0, 1), (0, 1, 4), (0, 2, 3)])
    v2, f2, log = G.clean(v, f)
    assert f2.count() == 2 and v2.filter("isnan(x)").count() == 0
    assert {r["step"] for r in log.filter("removed > 0").collect()} == {"missing_or_non_finite", "repeated_index", "duplicate"}


@pytest.mark.parametrize(("n", "faces"), [(3, [(0, 1, 2)]), (4, [(0, 1, 2), (0, 2, 3)]), (7, [(0, 1, 2), (2, 3, 4), (4, 5, 6)]), (4, [(0, 1, 2)])])
def test_laplacian_against_dense(spark, n, faces):
    pts = np.random.default_rng(n).normal(size=(n, 3))
    v, f = mesh(spark, pts, faces)
    a = np.zeros((n, n))
    for t in faces:
        for i in range(3):
            a[t[i], t[(i + 1) % 3]] = a[t[(i + 1) % 3], t[i]] = 1
    d = a.sum(axis=1, keepdims=True)
    want = np.where(d > 0, pts - a @ pts / np.maximum(d, 1), 0)
    e = T.unique_edges(f)
    got = np.array([(r.lx, r.ly, r.lz) for r in G.laplacian(v, e).orderBy("vid").collect()])
    assert np.allclose(got, want, atol=1e-12)
    m = np.zeros((n, n))
    for r in G.laplacian_matrix(v, e).collect():
        m[r.row, r.col] = r.value
    assert np.allclose(m @ pts, want, atol=1e-12)


def test_orient_box(spark):
    c, f = cube()
    v, _ = mesh(spark, c * (2, 0.75, 1), f)
    out, frames = G.orient_and_normalize(v, "z", 2.0)
    p = np.array([(r.x, r.y, r.z) for r in out.collect()])
    assert np.allclose(np.ptp(p, axis=0).max(), 2) and np.allclose(p.min(axis=0) + p.max(axis=0), 0, atol=1e-12)
    assert frames.first()["scale"] == 0.5


def test_adaptive_subdivision(spark):
    v, f = mesh(spark, [(0, 0, 0), (4, 0, 0), (4, 4, 0), (0, 4, 0), (0.2, 0.2, 0)], [(0, 1, 4), (1, 2, 4), (2, 3, 4), (3, 0, 4)])
    area = lambda v, f: G.represented_area(v, G.face_areas(f, v)).agg(F.max("area"), F.sum("area")).first()
    most, total = area(v, f)
    v2, f2, history = D.adaptive(v, f, most / 5)
    most2, total2 = area(v2, f2)
    assert most2 <= most / 5 * (1 + 1e-12) and total2 == pytest.approx(total, abs=1e-12) and history[-1][1] == 0
    assert T.winding_conflicts(f2).count() == 0
    with pytest.raises(ValueError):
        D.adaptive(v, f, 1e-9, max_rounds=1)


@pytest.mark.parametrize("code", range(8))
def test_every_split_case_keeps_area_and_winding(spark, code):
    v, f = mesh(spark, [(0, 0, 0), (3, 0, 0), (0, 2, 0)], [(0, 1, 2)])
    edges = [(0, 1), (1, 2), (0, 2)]
    marked = spark.createDataFrame([(1, *e) for k, e in enumerate(edges) if code >> k & 1], schema.EDGES)
    v2, f2, _ = D.split_marked(v, f, marked)
    a = G.with_normal(G.face_points(f2, v2)).collect()
    assert len(a) == 1 + bin(code).count("1") and sum(r["area"] for r in a) == pytest.approx(3) and all(r["nz"] > 0 for r in a)


def test_components_winding_and_fragments(spark):
    c, f = cube()
    far = np.concatenate((c, c * 0.01 + 50))
    both = np.concatenate((f, f + 8))
    v, fd = mesh(spark, far, both)
    e = T.unique_edges(fd)
    labels = T.components(v, e)
    assert [r["component"] for r in labels.orderBy("vid").collect()] == [0] * 8 + [1] * 8
    sizes = T.component_faces(fd, labels).orderBy("component").collect()
    assert [(r["n_faces"], r["offset"]) for r in sizes] == [(12, 0), (12, 8)]
    assert not any(r["remote"] for r in G.remote_fragments(v, fd, labels).collect())  # half of the faces is not small
    m = T.mesh_metrics(v, fd).first()
    assert m["watertight"] and m["euler"] == 4
    flipped = both.copy()
    flipped[3] = flipped[3][::-1]
    _, bad = mesh(spark, far, flipped)
    assert T.winding_conflicts(bad).count() == 3
    assert T.winding_conflicts(C.repaired_winding(v, bad)).count() == 0


def test_thin_triangle_weights(spark):
    tri = np.array([(-0.88787812, 0.31478441, 0.26878771), (0.86925519, 0.31423566, 0.26878771), (-0.48902702, 0.31465983, 0.26878771)])
    q = np.array([(0.19011408, 0.31444776, 0.26878771)])
    d, w = closest.on_triangles(q, *(tri[None, k] for k in range(3)))
    assert (w >= 0).all() and w.sum() == pytest.approx(1, abs=1e-12)
    v, f = mesh(spark, tri, [(0, 1, 2)])
    qv, _ = mesh(spark, q, [(0, 0, 0)])
    cand = spark.createDataFrame([(1, 0, 0)], "model_id bigint, vid bigint, fid bigint")
    r = C.restricted_nearest(qv, cand, v, f).first()
    assert r["distance"] == pytest.approx(math.sqrt(d[0]), abs=1e-12) and r["w0"] + r["w1"] + r["w2"] == pytest.approx(1, abs=1e-12)


def test_nearest_surface_is_exact():
    v, f = sphere(1)
    p = np.random.default_rng(2).normal(size=(60, 3)) * 1.5
    _, _, got = closest.surface(p, v, f)
    every = np.array([[closest.on_triangles(q[None], *(v[t[k]][None] for k in range(3)))[0][0] for t in f] for q in p])
    assert np.allclose(got, np.sqrt(every.min(axis=1)), atol=1e-12)


def test_quadric_collapse_keeps_the_surface():
    v, f = sphere(2)
    nv, nf, to, history = simplify.collapse(v, f, 60)
    assert len(nv) == 60 and (to >= 0).all() and set(to) == set(range(60)) and len(history) == len(v) - 60
    uses = {}
    for t in nf:
        for i in range(3):
            uses[(t[i], t[(i + 1) % 3])] = uses.get((t[i], t[(i + 1) % 3]), 0) + 1
    assert set(uses.values()) == {1} and all((b, a) in uses for a, b in uses)  # closed and consistent
    assert np.abs(np.linalg.norm(nv, axis=1) - 1).max() < 0.2
    two = np.concatenate((v, v + 5))
    _, f2, to2, done = simplify.by_component(two, np.concatenate((f, f + len(v))), 0.3)
    assert len(done) == 2 and not set(to2[: len(v)]) & set(to2[len(v) :])


def test_simplified_with_provenance_targets(spark):
    pts, faces = sphere(2)
    v, f = mesh(spark, pts, faces)
    cv, cf, mapping = C.unpacked(C.simplified(v, f, 50))
    labels = T.components(v, T.unique_edges(f))
    assert C.split_clusters(mapping, labels).count() == 0
    clusters = C.clusters(v, cv, mapping)
    assert clusters.agg(F.sum("size")).first()[0] == len(pts) and clusters.filter("size = 0").count() == 0
    ev, _, parents = D.uniform(cv, cf)
    t = C.provenance_targets(ev, parents, v, f, mapping, labels)
    assert t.count() == ev.count() and t.agg(F.max("distance")).first()[0] < 0.35
    moved, alpha = C.registered(cv, mapping, v, f, labels, cf)
    assert alpha.first()["alpha"] >= 0.95 and moved.count() == 50
    assert C.simplified(v, f, 5000).filter("kind = 0").count() == len(pts)  # passes through


def test_perturbation_is_safe_and_deterministic(spark):
    c, faces = sphere(1)
    v, f = mesh(spark, c, faces)
    a, b, other = (G.perturb(v, f, s, std_h=0.3).orderBy("vid").collect() for s in (1, 1, 2))
    p, q, o = (np.array([r["offset"] for r in x]) for x in (a, b, other))
    assert np.allclose(p, q, atol=1e-12) and not np.allclose(p, o, atol=1e-3) and np.abs(p).max() > 1e-3
    after = spark.createDataFrame([(1, r["vid"], r["x"], r["y"], r["z"]) for r in a], schema.VERTICES)
    assert G.topology_change(v, after, f).filter("flipped OR collapsed").count() == 0


def test_geometry_hash_ignores_order_place_and_size(spark):
    c, f = cube()
    c = c * (1, 2, 3)
    p = np.random.default_rng(5).permutation(8)
    h = lambda a: DG.geometry_hash(*mesh(spark, a, f)).first()["geometry_hash"]
    assert h(c) == h(c[p] * 4 + 10) != h(c * (1, 2, 2))
    k = lambda a: DG.mesh_checksum(*mesh(spark, a, f)).first()["checksum"]
    assert k(c) != k(c[p])


def test_metrics_against_numpy(spark):
    m = orders_mesh(spark, "/root/testdata/sf0.001")
    rep = G.represented_area(m.vertices, G.face_areas(m.faces, m.vertices)).filter("model_id = 0")
    a = np.sort([r["area"] for r in rep.collect()])
    n = len(a)
    want = 2 * (np.arange(1, n + 1) * a).sum() / (n * a.sum()) - (n + 1) / n
    assert M.gini(rep, "area").first()["gini"] == pytest.approx(want)
    s = M.area_summary(rep).first()
    assert s["p95"] == pytest.approx(np.quantile(a, 0.95)) and s["n_zero"] == (a == 0).sum()
    zero = rep.withColumn("area", F.lit(0.0))
    assert math.isnan(M.gini(zero, "area").first()["gini"]) and M.gini(zero, "area", all_zero=0.0).first()["gini"] == 0
    flat = M.spearman(rep.withColumn("b", F.lit(1.0)), "area", "b").first()["spearman"]
    assert math.isnan(flat)


def test_zbuffer_cube():
    v, f = cube()
    k, r, t = np.array([[32.0, 0, 32], [0, 32, 32], [0, 0, 1]]), np.eye(3), np.array([0, 0, 4.0])
    depth, ids = raster.rasterize(v, f, k, r, t, 64, 64)
    assert depth[32, 32] == pytest.approx(3) and np.isinf(depth[0, 0]) and ids[0, 0] == -1
    assert (np.isfinite(depth) == (ids >= 0)).all()
    assert raster.resize_nearest(depth, 32, 32).shape == (32, 32)


def test_vertex_texture_is_smooth_and_metrics_count_components(spark, sf):
    whole = orders_mesh(spark, sf)
    m = Mesh(whole.vertices.filter("model_id < 2"), whole.faces.filter("model_id < 2"))
    rgb, stats = G.vertex_texture(m.vertices, m.faces, 3, 1)
    rows, again = sorted(rgb.collect()), sorted(G.vertex_texture(m.vertices.repartition(3), m.faces, 3, 1)[0].collect())
    assert rows == again and len(rows) == m.vertices.count()
    assert all(15 <= c <= 240 for r in rows for c in r[2:]) and len({r[2:] for r in rows}) > len(rows) // 2
    for s in stats.collect():
        assert s["r_std"] > 0.05 and 0 < s["neighbour_difference_mean"] < s["neighbour_difference_p95"]
    with pytest.raises(ValueError):
        G.vertex_texture(m.vertices, m.faces, 3, -1)
    labels = T.components(m.vertices, T.unique_edges(m.faces))
    want = {r[0]: r[1] for r in labels.groupBy("model_id").agg(F.count_distinct("component")).collect()}
    assert {r["model_id"]: r["n_components"] for r in T.mesh_metrics(m.vertices, m.faces, labels).collect()} == want
