"""Nearest surfaces, provenance-restricted targets, clusters, distances."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meshquilt.functions import vec as V
from meshquilt.kernels import closest, noise, packed, simplify
from meshquilt.operators import geometry as G
from meshquilt.operators import topology as T

COMPONENT_FALLBACK = 0.05


def point_triangle(p, a, b, c):
    """Struct(d2, w0, w1, w2): the nearest point of a triangle as Column expressions: the best of three corners, three
    clamped edges, and the foot where it lies inside."""

    def offer(w):
        q = tuple(w[0] * a[k] + w[1] * b[k] + w[2] * c[k] for k in range(3))
        d = V.sub(p, q)
        return F.struct(V.dot(d, d).alias("d2"), w[0].alias("w0"), w[1].alias("w1"), w[2].alias("w2"))

    zero, one = F.lit(0.0), F.lit(1.0)
    out = [offer((one, zero, zero)), offer((zero, one, zero)), offer((zero, zero, one))]
    for i, (s, e) in enumerate(((a, b), (b, c), (c, a))):
        side = V.sub(e, s)
        t = F.greatest(zero, F.least(one, V.dot(V.sub(p, s), side) / F.greatest(V.dot(side, side), F.lit(1e-300))))
        out.append(offer(((one - t, t, zero), (zero, one - t, t), (t, zero, one - t))[i]))
    u, v, x = V.sub(b, a), V.sub(c, a), V.sub(p, a)
    uu, vv, uv, xu, xv = V.dot(u, u), V.dot(v, v), V.dot(u, v), V.dot(x, u), V.dot(x, v)
    det = uu * vv - uv * uv
    s, t = (vv * xu - uv * xv) / det, (uu * xv - uv * xu) / det
    inside = (det > 1e-300) & (s >= -1e-10) & (t >= -1e-10) & (1 - s - t >= -1e-10)
    w1, w2 = F.greatest(s, zero), F.greatest(t, zero)
    w0 = F.greatest(1 - s - t, zero)
    total = w0 + w1 + w2
    foot = F.when(inside, offer((w0 / total, w1 / total, w2 / total)))
    return F.array_min(F.array_compact(F.array(*out, foot)))


def clusters(fine: DataFrame, coarse: DataFrame, mapping: DataFrame) -> DataFrame:
    """model_id, coarse_vid, size, offset (running, by coarse id) and the representative (nearest member, first on a tie).
    ``mapping``: model_id, vid, coarse_vid. Coarse vertices without a member appear with size 0."""
    c = coarse.select("model_id", F.col("vid").alias("coarse_vid"), *(F.col(k).alias(f"c{k}") for k in "xyz"))
    met = mapping.join(fine, ["model_id", "vid"]).join(c, ["model_id", "coarse_vid"])
    d = V.sub(V.vec("x", "y", "z"), V.vec("cx", "cy", "cz"))
    found = met.groupBy("model_id", "coarse_vid").agg(F.count("*").alias("size"), F.min(F.struct(V.dot(d, d).alias("d2"), "vid")).alias("b"))
    out = c.join(found, ["model_id", "coarse_vid"], "left").withColumn("size", F.coalesce("size", F.lit(0)))
    order = Window.partitionBy("model_id").orderBy("coarse_vid").rowsBetween(Window.unboundedPreceding, 0)
    return out.select("model_id", "coarse_vid", "size", (F.sum("size").over(order) - F.col("size")).alias("offset"), F.col("b.vid").alias("representative"))


def provenance_faces(faces: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fine faces by coarse vertex (model_id, coarse_vid, fid) and by coarse edge (model_id, u, w, fid)."""
    m = mapping.select("model_id", "vid", "coarse_vid")
    three = faces
    for k in range(3):
        three = three.join(m.select("model_id", F.col("vid").alias(f"i{k}"), F.col("coarse_vid").alias(f"c{k}")), ["model_id", f"i{k}"])
    near = F.array_distinct(F.array("c0", "c1", "c2"))
    by_vertex = three.select("model_id", "fid", F.explode(near).alias("coarse_vid"))
    ends = F.array(*(F.struct(F.least(a, b).alias("u"), F.greatest(a, b).alias("w")) for a, b in (("c0", "c1"), ("c1", "c2"), ("c0", "c2"))))
    by_edge = three.select("model_id", "fid", F.explode(F.array_distinct(ends)).alias("e")).filter("e.u <> e.w").select("model_id", "fid", "e.*")
    return by_vertex.select("model_id", "coarse_vid", "fid"), by_edge.select("model_id", "u", "w", "fid")


def restricted_nearest(query: DataFrame, candidates: DataFrame, vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """The nearest point among each vertex's candidate faces: model_id, vid, fid, distance, w0, w1, w2. ``candidates``:
    model_id, vid, fid: an equi-join prunes the pairs, a grouped minimum decides (ties: smallest face)."""
    pts = G.face_points(faces, vertices)
    met = query.select("model_id", "vid", F.col("x").alias("px"), F.col("y").alias("py"), F.col("z").alias("pz")).join(candidates, ["model_id", "vid"]).join(pts, ["model_id", "fid"])
    import pyarrow as pa

    names = [f"{p}{k}" for p in "pabc" for k in "xyz"]

    def rows(batches):
        for t in batches:
            p, a, b, c = (np.stack([t.column(3 + 3 * i + j).to_numpy(zero_copy_only=False) for j in range(3)], axis=1) for i in range(4))
            d2, w = closest.on_triangles(p, a, b, c)
            yield pa.RecordBatch.from_arrays([*t.columns[:3], pa.array(d2), *(pa.array(w[:, j]) for j in range(3))], ["model_id", "vid", "fid", "d2", "w0", "w1", "w2"])

    # one vectorised pass over the pairs: as Column expressions (``point_triangle``) the plan is the same, but compiles for long
    near = met.select("model_id", "vid", "fid", *names).mapInArrow(rows, "model_id bigint, vid bigint, fid bigint, d2 double, w0 double, w1 double, w2 double")
    one = near.groupBy("model_id", "vid").agg(F.min(F.struct("d2", "fid", "w0", "w1", "w2")).alias("b"))
    return one.select("model_id", "vid", F.col("b.fid").alias("fid"), F.sqrt("b.d2").alias("distance"), "b.w0", "b.w1", "b.w2")


def provenance_targets(expanded: DataFrame, parents: DataFrame, vertices: DataFrame, faces: DataFrame, mapping: DataFrame, labels: DataFrame, limit: float = COMPONENT_FALLBACK) -> DataFrame:
    """Targets of an expanded mesh on the fine one. A coarse vertex looks at the faces of its cluster (kind 0), a midpoint at
    those of its edge (kind 1); one that finds none within ``limit`` looks at the whole component of its cluster (2 and 3).
    ``expanded``: model_id, vid, x, y, z; ``parents``: model_id, child_vid, p0, p1; ``labels``: components of fine vertices."""
    by_vertex, by_edge = provenance_faces(faces, mapping)
    kids = parents.select("model_id", F.col("child_vid").alias("vid"), F.least("p0", "p1").alias("u"), F.greatest("p0", "p1").alias("w"))
    own = expanded.join(kids, ["model_id", "vid"], "left_anti")
    local = own.select("model_id", "vid").join(by_vertex.withColumnRenamed("coarse_vid", "vid"), ["model_id", "vid"])
    between = kids.join(by_edge, ["model_id", "u", "w"]).select("model_id", "vid", "fid")
    first = restricted_nearest(expanded, local.unionByName(between), vertices, faces)
    kind = expanded.select("model_id", "vid").join(kids.select("model_id", "vid", F.col("u").alias("anchor")), ["model_id", "vid"], "left")
    kind = kind.select("model_id", "vid", F.coalesce("anchor", "vid").alias("coarse_vid"), F.when(F.col("anchor").isNull(), 0).otherwise(1).alias("kind"))
    good = first.filter(F.col("distance") <= limit)
    rest = kind.join(good, ["model_id", "vid"], "left_anti")
    part = mapping.join(labels, ["model_id", "vid"]).groupBy("model_id", "coarse_vid").agg(F.min("component").alias("component"))
    face_part = faces.join(labels.withColumnRenamed("vid", "i0"), ["model_id", "i0"]).select("model_id", "fid", "component")
    wide = rest.join(part, ["model_id", "coarse_vid"]).join(face_part, ["model_id", "component"]).select("model_id", "vid", "fid")
    second = restricted_nearest(expanded, wide, vertices, faces).join(rest.select("model_id", "vid", (F.col("kind") + 2).alias("kind")), ["model_id", "vid"])
    return good.join(kind.select("model_id", "vid", "kind"), ["model_id", "vid"]).unionByName(second)


def packed_targets(vertices: DataFrame, faces: DataFrame, target: int, limit: float = COMPONENT_FALLBACK) -> DataFrame:
    """``simplified``, ``uniform`` of that and ``provenance_targets`` on the fine mesh, a model in one task: model_id, vid, kind, distance, fid, w0, w1, w2, and error
    in the one row of a model that cannot be worked."""

    def kernel(_model, _vids, v, fids, f):
        nv, nf, to = _collapsed(v, f, target, 4)
        edges = noise.edges_of(len(nv), nf)
        n, u = len(nv), edges[:, 0]
        points = np.concatenate((nv, (nv[u] + nv[edges[:, 1]]) / 2))
        anchor = np.concatenate((np.arange(n), u))
        # candidates: faces of a vertex's cluster, and those between the clusters of an edge
        c = to[f]
        place = np.flatnonzero((c >= 0).all(axis=1))
        c = c[place]
        key = np.concatenate([np.stack((c[:, k], place), axis=1) for k in range(3)])
        ends = np.sort(np.concatenate((c[:, [0, 1]], c[:, [1, 2]], c[:, [0, 2]])), axis=1)
        code, wanted = edges[:, 0] * n + edges[:, 1], ends[:, 0] * n + ends[:, 1]
        at = np.minimum(np.searchsorted(code, wanted), max(len(code) - 1, 0))
        met = code[at] == wanted if len(code) else np.zeros(len(wanted), bool)
        pairs = np.unique(np.concatenate((key, np.stack((n + at, np.tile(place, 3)), axis=1)[met])), axis=0)
        a, b, d = (v[f[:, k]] for k in range(3))
        vid, face, weight, dist = _nearest_of(points, pairs, a, b, d)
        good = dist <= limit
        found = [(vid[good], (vid[good] >= n).astype(np.int32), dist[good], face[good], weight[good])]
        rest = np.setdiff1d(np.arange(len(points)), vid[good])
        if len(rest) and len(f):
            label = simplify.components(len(v), noise.edges_of(len(v), f))
            part = np.full(n, len(v))
            np.minimum.at(part, to[to >= 0], label[to >= 0])
            for one in np.unique(part[anchor[rest]]):
                own, there = rest[part[anchor[rest]] == one], np.flatnonzero(label[f[:, 0]] == one)
                if not len(there):
                    continue
                if np.isfinite(points[own]).all() and np.isfinite(v[f[there]]).all():
                    k, w, far = closest.surface(points[own], v, f[there])
                    hit = (own, there[k], w, far)
                else:
                    hit = _nearest_of(points, np.stack((np.repeat(own, len(there)), np.tile(there, len(own))), axis=1), a, b, d)
                found.append((hit[0], np.where(hit[0] >= n, 3, 2).astype(np.int32), hit[3], hit[1], hit[2]))
        vid, kind, dist, face, weight = (np.concatenate(x) for x in zip(*found, strict=True))
        return {"vid": vid, "kind": kind, "distance": dist, "fid": fids[face], "w0": weight[:, 0], "w1": weight[:, 1], "w2": weight[:, 2]}

    return packed.each_model(packed.pack(vertices, faces), kernel, "vid bigint, kind int, distance double, fid bigint, w0 double, w1 double, w2 double")


def _nearest_of(points, pairs, a, b, c):
    """(point, face, weights, distance) of the nearest face among the pairs (point, face) of each point; ties: the smallest face."""
    d2, w = closest.on_triangles(points[pairs[:, 0]], a[pairs[:, 1]], b[pairs[:, 1]], c[pairs[:, 1]])
    order = np.lexsort((pairs[:, 1], d2, pairs[:, 0]))
    at = pairs[order, 0]
    first = order[np.flatnonzero(np.diff(at, prepend=-1))]
    return pairs[first, 0], pairs[first, 1], w[first], np.sqrt(d2[first])


def split_clusters(mapping: DataFrame, labels: DataFrame) -> DataFrame:
    """Coarse vertices whose members come from more than one component (there should be none)."""
    return mapping.join(labels, ["model_id", "vid"]).groupBy("model_id", "coarse_vid").agg(F.count_distinct("component").alias("n")).filter("n > 1")


def chamfer(a: DataFrame, b: DataFrame) -> DataFrame:
    """Mean nearest-vertex distance each way and their sum (all-pairs minimum inside a model in SQL; for large meshes use
    ``chamfer_packed``)."""
    p, q = a.select("model_id", F.col("vid").alias("i"), *(F.col(k).alias(f"a{k}") for k in "xyz")), b.select("model_id", F.col("vid").alias("j"), *(F.col(k).alias(f"b{k}") for k in "xyz"))
    d = V.norm(V.sub(V.vec("ax", "ay", "az"), V.vec("bx", "by", "bz")))
    met = p.join(q, "model_id").withColumn("d", d)
    one = met.groupBy("model_id", "i").agg(F.min("d").alias("d")).groupBy("model_id").agg(F.avg("d").alias("a_to_b"))
    two = met.groupBy("model_id", "j").agg(F.min("d").alias("d")).groupBy("model_id").agg(F.avg("d").alias("b_to_a"))
    return one.join(two, "model_id").withColumn("chamfer", F.col("a_to_b") + F.col("b_to_a"))


def chamfer_packed(a: DataFrame, b: DataFrame) -> DataFrame:
    """The same, one model at a time in blocks."""
    import pyarrow as pa

    def side(v, s):
        return v.groupBy("model_id").agg(*(F.collect_list(k).alias(f"{s}{k}") for k in "xyz"))

    def rows(batches):
        for t in batches:
            for i in range(t.num_rows):
                p, q = (np.stack([np.asarray(t.column(f"{s}{k}")[i].values) for k in "xyz"], axis=1) for s in "ab")
                x, y = closest.nearest(p, q)[1].mean(), closest.nearest(q, p)[1].mean()
                yield pa.RecordBatch.from_pydict({"model_id": pa.array([t.column("model_id")[i].as_py()], pa.int64()), "a_to_b": [x], "b_to_a": [y], "chamfer": [x + y]})

    return side(a, "a").join(side(b, "b"), "model_id").mapInArrow(rows, "model_id bigint, a_to_b double, b_to_a double, chamfer double")


def simplified(vertices: DataFrame, faces: DataFrame, target: int, least: int = 4) -> DataFrame:
    """Packed results of a whole-mesh collapse: model_id, one row per coarse vertex (kind 0: id, x, y, z), face (1: id, a, b, c)
    and fine vertex (2: id, coarse id). A mesh at or under the target passes through."""

    def kernel(_model, vids, v, _fids, f):
        return _kinds(vids, *_collapsed(v, f, target, least))

    return packed.each_model(packed.pack(vertices, faces), kernel, "kind int, id bigint, a double, b double, c double")


def _collapsed(v, f, target, least):
    nv, nf, to, _ = simplify.collapse(v, f, target, least) if len(v) > target else (v, f, np.arange(len(v)), [])
    if len(nv) < min(least, len(v)):
        raise ValueError(f"{len(nv)} vertices left, at least {least} asked for")
    return nv, nf, to


def simplified_by_component(vertices: DataFrame, faces: DataFrame, ratio: float, least: int = 4) -> DataFrame:
    def kernel(_model, vids, v, _fids, f):
        nv, nf, to, _ = simplify.by_component(v, f, ratio, least)
        return _kinds(vids, nv, nf, to)

    return packed.each_model(packed.pack(vertices, faces), kernel, "kind int, id bigint, a double, b double, c double")


def _kinds(vids, nv, nf, to):
    a = np.concatenate((nv, nf.astype(float), np.stack((to, to, to), axis=1).astype(float)))
    kind = np.concatenate((np.zeros(len(nv)), np.ones(len(nf)), np.full(len(to), 2))).astype(np.int32)
    return {"kind": kind, "id": np.concatenate((np.arange(len(nv)), np.arange(len(nf)), vids)).astype(np.int64), "a": a[:, 0], "b": a[:, 1], "c": a[:, 2]}


def failures(result: DataFrame) -> DataFrame:
    """model_id and reason of the models that a packed kernel could not work (``simplified``, ``rasters`` and others)."""
    return result.filter("error IS NOT NULL").select("model_id", F.col("error").alias("reason"))


def unpacked(result: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vertices, faces, mapping) of ``simplified``; ``failures`` has the models that are in none of them."""
    v = result.filter("kind = 0").select("model_id", F.col("id").alias("vid"), F.col("a").alias("x"), F.col("b").alias("y"), F.col("c").alias("z"))
    f = result.filter("kind = 1").select("model_id", F.col("id").alias("fid"), *(F.col(s).cast("bigint").alias(t) for s, t in zip("abc", ("i0", "i1", "i2"), strict=True)))
    m = result.filter("kind = 2 AND a >= 0").select("model_id", F.col("id").alias("vid"), F.col("a").cast("bigint").alias("coarse_vid"))
    return v, f, m


def repaired_winding(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Faces turned so that neighbours agree (per model; only models with a conflict are touched)."""

    def kernel(_model, vids, _v, fids, f):
        t = vids[simplify.consistent_winding(f)]
        return {"fid": fids, "i0": t[:, 0], "i1": t[:, 1], "i2": t[:, 2]}

    bad = T.winding_conflicts(faces).select("model_id").distinct()
    fixed = packed.each_model(packed.pack(vertices.join(bad, "model_id", "left_semi"), faces.join(bad, "model_id", "left_semi")), kernel, "fid bigint, i0 bigint, i1 bigint, i2 bigint")
    return faces.join(bad, "model_id", "left_anti").select("model_id", "fid", "i0", "i1", "i2").unionByName(fixed.filter("error IS NULL").select("model_id", "fid", "i0", "i1", "i2"))


def registered(coarse: DataFrame, mapping: DataFrame, vertices: DataFrame, faces: DataFrame, labels: DataFrame, coarse_faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Coarse vertices on the nearest point of their own fine component, blended so that no coarse face collapses: (targets,
    model_id and alpha)."""
    part = mapping.join(labels, ["model_id", "vid"]).groupBy("model_id", "coarse_vid").agg(F.min("component").alias("component"))
    face_part = faces.join(labels.withColumnRenamed("vid", "i0"), ["model_id", "i0"]).select("model_id", "fid", "component")
    cand = part.join(face_part, ["model_id", "component"]).select("model_id", F.col("coarse_vid").alias("vid"), "fid")
    hit = restricted_nearest(coarse, cand, vertices, faces).join(G.face_points(faces, vertices), ["model_id", "fid"])
    goal = hit.select("model_id", "vid", *((F.col("w0") * F.col(f"a{k}") + F.col("w1") * F.col(f"b{k}") + F.col("w2") * F.col(f"c{k}")).alias(k) for k in "xyz"))
    alpha = G.topology_safe_blend(coarse, goal, coarse_faces)
    both = coarse.join(goal.select("model_id", "vid", *(F.col(k).alias(f"t{k}") for k in "xyz")), ["model_id", "vid"]).join(alpha, "model_id")
    return both.select("model_id", "vid", *((F.col(k) + F.col("alpha") * (F.col(f"t{k}") - F.col(k))).alias(k) for k in "xyz")), alpha
