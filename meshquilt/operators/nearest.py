"""Nearest surface points by a spatial join: triangles and points meet on grid cells, in rounds of growing radius.

The grid is one per model; its cell is the mean extent of the model's triangles, or what they would have if they covered a side of its box. A triangle is entered once at the level
whose cell (a power of two times the mean) is no smaller than the triangle, so it lies in eight cells at most, however large it is. In a round
of radius R every point looks at the cells, of R or larger, that its box of radius R touches: 27 at most at a level. A pair that
shares several cells is kept in one of them, the lowest, and only where the triangle's box is within R. What comes out is every triangle within R of the point, so if the nearest one
is within R, it is the nearest of all, and the point is done. Only the others go into the next round, with a larger radius.

Everything is an equi-join on (model, level, cell) and a grouped minimum: a model spans as many tasks as its cells fill. A point far from
everything is found in the round whose radius reaches the surface, where it meets all triangles within that radius: work grows with
the surface near the point's own distance.

A model of at most ``MOST_PAIRS`` pairs of points and triangles needs no grid: it is one packed row, its pairs are pruned by the triangles' spheres in the task that has it, and nothing
is written or shuffled but the meshes, dealt out by model once. So a corpus of many small models costs one pass, and a large model the rounds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshquilt.functions import vec as V
from meshquilt.kernels import closest, packed
from meshquilt.operators import geometry as G
from meshquilt.sources.scratch import scratch, stored

assert packed  # registers the kernels to travel with the tasks
AXES = "xyz"
#: The radii of the rounds, as powers of two times the cell.
ROUNDS = (-2, 0, 1, 3, 5, 8, 12, 17, 24, 40, 80, 160, 330, 660)
#: A cell is no smaller than this part of the model's box.
FINEST = 1 << 20
#: Pairs of points and triangles of a model that one task meets without a grid.
MOST_PAIRS = 1 << 20
#: Boxes are wider than the radius by this, so that rounding loses no triangle.
WIDER = 1 + 1e-9
REASONS = ("model_without_faces", "non_finite_query_vertex")


def _all_finite(columns):
    out = V.finite(F.col(columns[0]))
    for c in columns[1:]:
        out = out & V.finite(F.col(c))
    return out


def _triangles(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Faces with finite corners, their box, the model's origin and cell, and their level."""
    t = G.face_points(faces.select("model_id", "fid", "i0", "i1", "i2"), vertices).filter(_all_finite([f"{p}{k}" for p in "abc" for k in AXES]))
    t = t.select("*", *(F.least(*(f"{p}{k}" for p in "abc")).alias(f"l{k}") for k in AXES), *(F.greatest(*(f"{p}{k}" for p in "abc")).alias(f"h{k}") for k in AXES))
    t = t.withColumn("extent", F.greatest(*(F.col(f"h{k}") - F.col(f"l{k}") for k in AXES)))
    box = t.groupBy("model_id").agg(F.avg("extent").alias("mean"), *(F.min(f"l{k}").alias(f"o{k}") for k in AXES), F.greatest(*(F.max(f"h{k}") - F.min(f"l{k}") for k in AXES)).alias("side"), F.count("*").alias("n"))
    cell = F.greatest("mean", F.col("side") / F.sqrt("n"), F.col("side") / FINEST)
    box = box.select("model_id", F.when(cell > 0, cell).otherwise(1.0).alias("cell"), *(f"o{k}" for k in AXES))
    level = F.when(F.col("extent") > F.col("cell"), F.ceil(F.log2(F.col("extent") / F.col("cell")) + 1e-9)).otherwise(0).cast("int")
    return t.join(box, "model_id").withColumn("level", level)


def _cells(low: str, high: str, size, slack):
    """Columns cl*, ch*: the first and last cell of a box on every axis; clamped, as triangles lie in cells from 0 to some ``FINEST``."""
    place = lambda v: F.floor(F.greatest(F.lit(-2.0), F.least(F.lit(4.0 * FINEST), v)))
    return [place((F.col(f"{e}{k}") + s * slack - F.col(f"o{k}")) / size).alias(f"{n}{k}") for n, e, s in (("cl", low, -1), ("ch", high, 1)) for k in AXES]


def _spread(rows: DataFrame, own: str) -> DataFrame:
    """A row for each cell of the box; ``own``: the prefix of the kept first cells."""
    out = rows
    for k in AXES:
        out = out.withColumn(f"g{k}", F.explode(F.sequence(f"cl{k}", f"ch{k}"))).withColumnRenamed(f"cl{k}", f"{own}{k}").drop(f"ch{k}")
    return out


def _measured(pairs: DataFrame) -> DataFrame:
    """model_id, vid, fid, d2, weights and point of every pair, in one vectorised pass."""
    import pyarrow as pa

    names = ["model_id", "vid", "fid", "d2", "w0", "w1", "w2", "tx", "ty", "tz"]

    def rows(batches):
        for t in batches:
            p, a, b, c = (np.stack([t.column(3 + 3 * i + j).to_numpy(zero_copy_only=False) for j in range(3)], axis=1) for i in range(4))
            d2, w = closest.on_triangles(p, a, b, c)
            q = w[:, :1] * a + w[:, 1:2] * b + w[:, 2:] * c
            yield pa.RecordBatch.from_arrays([*t.columns[:3], pa.array(d2), *(pa.array(np.ascontiguousarray(m[:, j])) for m in (w, q) for j in range(3))], names)

    columns = [f"{p}{k}" for p in "qabc" for k in AXES]
    return pairs.select("model_id", "vid", "fid", *columns).mapInArrow(rows, "model_id bigint, vid bigint, fid bigint, " + ", ".join(f"{n} double" for n in names[3:]))


NEAREST = "model_id bigint, vid bigint, fid bigint, " + ", ".join(f"{n} double" for n in ("d2", "w0", "w1", "w2", "tx", "ty", "tz"))


def _whole(query: DataFrame, vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """``nearest_faces`` of models that are a packed row each."""
    import pyarrow as pa

    names = [f.split()[0] for f in NEAREST.split(", ")]
    corners = ("i0", "i1", "i2")
    kinds = [pa.int64()] * 3 + [pa.float64()] * 7

    def rows(batches):
        for t in batches:
            for i in range(t.num_rows):
                get = lambda name: t.column(name)[i].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                vids, v = get("vids"), np.stack([get(k) for k in AXES], axis=1).astype(float)
                named = np.stack([get(k) for k in corners], axis=1)
                at = np.minimum(np.searchsorted(vids, named), len(vids) - 1)
                ok = ((vids[at] == named) & np.isfinite(v[at]).all(axis=2)).all(axis=1)
                p = np.stack([get(f"q{k}") for k in AXES], axis=1).astype(float)
                asked = np.isfinite(p).all(axis=1)
                if not ok.any() or not asked.any():
                    continue
                f, p = at[ok], p[asked]
                face, w, _ = closest.surface(p, v, f)
                a, b, c = (v[f[face, j]] for j in range(3))
                q = w[:, :1] * a + w[:, 1:2] * b + w[:, 2:] * c
                out = [np.full(len(p), t.column("model_id")[i].as_py()), get("qids")[asked], get("fids")[ok][face], ((p - q) ** 2).sum(axis=1), *w.T, *q.T]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x), kind) for x, kind in zip(out, kinds, strict=True)], names)

    nan = lambda df: df.select("model_id", "vid", *(F.coalesce(k, F.lit(float("nan"))).alias(k) for k in AXES))
    asked = nan(query).groupBy("model_id").agg(F.collect_list(F.struct("vid", *AXES)).alias("p")).select("model_id", F.col("p.vid").alias("qids"), *(F.col(f"p.{k}").alias(f"q{k}") for k in AXES))
    mesh = packed.pack(nan(vertices), faces.dropna(subset=[*corners]))
    return asked.join(mesh.filter("fids IS NOT NULL"), "model_id").mapInArrow(rows, NEAREST)


def nearest_faces(query: DataFrame, vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """The nearest face of every query vertex, exact, ties to the smallest face: model_id, vid, fid, d2, w0, w1, w2, tx, ty, tz. Vertices of a model
    without a usable face and vertices that are not finite have no row. Ids of a model's query vertices are unique."""
    n = [df.groupBy("model_id").agg(F.count("*").alias(c)) for df, c in ((query, "nq"), (faces, "nf"), (vertices, "nv"))]
    large = n[0].join(n[1], "model_id").join(n[2], "model_id").filter(F.greatest(F.col("nq") * F.col("nf"), "nv") > MOST_PAIRS).select("model_id")
    large = stored(large, scratch(query.sparkSession))
    if large.isEmpty():
        return _whole(query, vertices, faces)
    small = _whole(*(df.join(large, "model_id", "left_anti") for df in (query, vertices, faces)))
    return small.unionByName(_in_rounds(*(df.join(large, "model_id", "left_semi") for df in (query, vertices, faces))))


def _in_rounds(query: DataFrame, vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """``nearest_faces`` by the grid's rounds."""
    spark = query.sparkSession
    here = lambda df: stored(df, scratch(spark))
    t = here(_triangles(vertices, faces))
    box = t.select("model_id", "cell", *(f"o{k}" for k in AXES)).distinct()
    left = here(query.select("model_id", "vid", *(F.col(k).alias(f"q{k}") for k in AXES)).filter(_all_finite([f"q{k}" for k in AXES])).join(box, "model_id"))
    levels = here(t.groupBy("model_id").agg(F.collect_set("level").alias("levels")))  # at most a few dozen a model
    found = None
    for power in ROUNDS:
        if left.isEmpty():
            break
        size = F.col("cell") * F.pow(F.lit(2.0), F.col("level"))
        radius = F.col("cell") * F.lit(2.0**power)
        at = t.join(left.select("model_id").distinct(), "model_id", "left_semi").withColumn("level", F.greatest("level", F.lit(power)))
        at = _spread(at.select("model_id", "level", "fid", *(f"{p}{k}" for p in "abclh" for k in AXES), *_cells("l", "h", size, F.lit(0.0))), "t")
        now = levels.select("model_id", F.explode(F.array_distinct(F.transform("levels", lambda v: F.greatest(v, F.lit(power))))).alias("level"))
        look = left.join(now, "model_id").select("model_id", "level", "vid", *(f"q{k}" for k in AXES), (radius * WIDER).alias("reach"), *_cells("q", "q", size, radius * WIDER))
        met = _spread(look, "p").join(at, ["model_id", "level", *(f"g{k}" for k in AXES)])
        once = F.lit(True)
        for k in AXES:
            once = once & (F.col(f"g{k}") == F.greatest(f"t{k}", f"p{k}"))
        gaps = [F.greatest(F.col(f"l{k}") - F.col(f"q{k}"), F.col(f"q{k}") - F.col(f"h{k}"), F.lit(0.0)) for k in AXES]
        within = V.norm(gaps) <= F.col("reach")  # only triangles whose box is within the radius can be nearest there
        near = _measured(met.filter(once & within)).groupBy("model_id", "vid").agg(F.min(F.struct("d2", "fid", "w0", "w1", "w2", "tx", "ty", "tz")).alias("b")).select("model_id", "vid", "b.*")
        seen = here(left.select("model_id", "vid", "cell").join(near, ["model_id", "vid"]).filter(F.sqrt("d2") <= radius).drop("cell"))
        found = seen if found is None else found.unionByName(seen)
        left = here(left.join(seen.select("model_id", "vid"), ["model_id", "vid"], "left_anti"))
    if not left.isEmpty():
        raise ValueError("coordinates too far apart for the rounds")
    return spark.createDataFrame([], NEAREST) if found is None else found.select("model_id", "vid", "fid", "d2", "w0", "w1", "w2", "tx", "ty", "tz")


def surface_targets(query: DataFrame, vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """A row for every query vertex: closest_face, weights, target point, displacement, surface_distance, the vertex normals blended by
    the weights, ``valid``, and where it is not valid the ``reason`` (a model without a usable face, a vertex that is not finite)."""
    normals = G.vertex_normals(vertices, faces)
    near = nearest_faces(query, vertices, faces)
    corners = near.join(faces.select("model_id", "fid", "i0", "i1", "i2"), ["model_id", "fid"])
    for i in range(3):
        corners = corners.join(normals.select("model_id", F.col("vid").alias(f"i{i}"), *(F.col(f"n{k}").alias(f"n{i}{k}") for k in AXES)), ["model_id", f"i{i}"])
    blend = [F.col("w0") * F.col(f"n0{k}") + F.col("w1") * F.col(f"n1{k}") + F.col("w2") * F.col(f"n2{k}") for k in AXES]
    long = V.norm(blend)
    hit = corners.select("model_id", "vid", "fid", "d2", "w0", "w1", "w2", "tx", "ty", "tz", *((b / F.when(long == 0, 1.0).otherwise(long)).alias(f"n{k}") for b, k in zip(blend, AXES, strict=True)))
    out = query.select("model_id", "vid", *AXES).join(hit, ["model_id", "vid"], "left")
    valid = F.col("fid").isNotNull()
    return out.select(
        "model_id", "vid", F.col("fid").alias("closest_face"), "w0", "w1", "w2", "tx", "ty", "tz", *((F.col(f"t{k}") - F.col(k)).alias(f"d{k}") for k in AXES), F.sqrt("d2").alias("surface_distance"), "nx", "ny", "nz", valid.alias("valid"),
        F.when(~valid, F.when(_all_finite([*AXES]), REASONS[0]).otherwise(REASONS[1])).alias("reason"),
    )


def surface_distances(query: DataFrame, vertices: DataFrame, faces: DataFrame, points: int | None = None) -> DataFrame:
    """By model: points, points without a target, and mean, median, p90, p95, p99 and maximum of their distances. With ``points`` that many evenly
    spaced query vertices of a model are looked at, else all."""
    from meshquilt.operators.metrics import evenly_spaced

    asked = query if points is None else evenly_spaced(query, "vid", points)
    hit = asked.select("model_id", "vid").join(nearest_faces(asked, vertices, faces).select("model_id", "vid", F.sqrt("d2").alias("d")), ["model_id", "vid"], "left")
    p = lambda q: F.expr(f"percentile(d, {q})")
    return hit.groupBy("model_id").agg(F.count("*").alias("n"), F.count_if(F.col("d").isNull()).alias("n_missing"), F.avg("d").alias("mean"), p(0.5).alias("median"), p(0.9).alias("p90"), p(0.95).alias("p95"), p(0.99).alias("p99"), F.max("d").alias("max"))


def chamfer(a: DataFrame, b: DataFrame) -> DataFrame:
    """Mean distance of every vertex to the nearest one of the other set, each way, and their sum; vertices are triangles of three equal corners here. Models
    of one side only have nulls."""
    one = lambda v: v.select("model_id", F.col("vid").alias("fid"), *(F.col("vid").alias(f"i{i}") for i in range(3)))
    way = lambda p, q, name: nearest_faces(p, q, one(q)).groupBy("model_id").agg(F.avg(F.sqrt("d2")).alias(name))
    return way(a, b, "a_to_b").join(way(b, a, "b_to_a"), "model_id", "full").withColumn("chamfer", F.col("a_to_b") + F.col("b_to_a"))
