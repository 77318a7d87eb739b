"""Midpoint, marked-edge, uniform and area-adaptive subdivision; area of variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meshquilt.functions import vec as V
from meshquilt.operators import geometry as G
from meshquilt.operators import topology as T
from meshquilt.sources.scratch import kept_in_parts

EDGES_OF = (("e0", 0, 1), ("e1", 1, 2), ("e2", 2, 0))


def _midpoints(vertices: DataFrame, marked: DataFrame, order: str) -> DataFrame:
    """model_id, u, w, mid (ids after the last vertex, in ``order``), x, y, z of the marked edges."""
    last = vertices.groupBy("model_id").agg((F.max("vid") + 1).alias("n"))
    r = F.row_number().over(Window.partitionBy("model_id").orderBy(order, "u", "w")) - 1
    named = marked.withColumn("_r", r).join(last, "model_id").withColumn("mid", F.col("n") + F.col("_r"))
    p = vertices.select("model_id", F.col("vid").alias("u"), *(F.col(k).alias(f"p{k}") for k in "xyz"))
    q = vertices.select("model_id", F.col("vid").alias("w"), *(F.col(k).alias(f"q{k}") for k in "xyz"))
    out = named.join(p, ["model_id", "u"]).join(q, ["model_id", "w"])
    return out.select("model_id", "u", "w", "mid", *(((F.col(f"p{k}") + F.col(f"q{k}")) / 2).alias(k) for k in "xyz"))


def _edge_ids(faces: DataFrame, mids: DataFrame) -> DataFrame:
    """Faces with the midpoint ids of their three edges (null where an edge is not marked)."""
    out = faces
    m = mids.select("model_id", "u", "w", "mid")
    for name, a, b in EDGES_OF:
        key = out.withColumn("u", F.least(f"i{a}", f"i{b}")).withColumn("w", F.greatest(f"i{a}", f"i{b}"))
        out = key.join(m.withColumnRenamed("mid", name), ["model_id", "u", "w"], "left").drop("u", "w")
    return out


def _tri(*ids):
    return F.struct(*(F.col(i).alias(f"i{k}") for k, i in enumerate(ids)))


#: Children of a face by which of its edges are marked (bit 0: ab, bit 1: bc, bit 2: ca).
CHILDREN = {
    0: [("i0", "i1", "i2")],
    1: [("i0", "e0", "i2"), ("e0", "i1", "i2")],
    2: [("i0", "i1", "e1"), ("i0", "e1", "i2")],
    4: [("i0", "i1", "e2"), ("e2", "i1", "i2")],
    3: [("i0", "e0", "i2"), ("e0", "i1", "e1"), ("e0", "e1", "i2")],
    6: [("i0", "i1", "e1"), ("i0", "e1", "e2"), ("e2", "e1", "i2")],
    5: [("i0", "e0", "e2"), ("e0", "i1", "e2"), ("e2", "i1", "i2")],
    7: [("i0", "e0", "e2"), ("i1", "e1", "e0"), ("i2", "e2", "e1"), ("e0", "e1", "e2")],
}


def split_marked(vertices: DataFrame, faces: DataFrame, marked: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Conforming split of the marked edges (model_id, u, w): every face gives one to four triangles, and neighbours
    agree on the midpoint. Midpoints are numbered by edge key. (vertices, faces, parents)."""
    mids = _midpoints(vertices, marked.select("model_id", "u", "w").distinct(), "u")
    f = _edge_ids(faces, mids)
    code = sum((F.when(F.col(e).isNotNull(), 1 << k).otherwise(0) for k, e in enumerate(("e1", "e2"), 1)), F.when(F.col("e0").isNotNull(), 1).otherwise(0))
    kids = F.lit(None)
    for c, tris in CHILDREN.items():
        kids = F.when(code == c, F.array(*(_tri(*t) for t in tris))).otherwise(kids)
    out = f.select("model_id", "fid", F.posexplode(kids).alias("k", "t")).select("model_id", (F.col("fid") * 4 + F.col("k")).alias("fid"), "t.*")
    v = vertices.select("model_id", "vid", "x", "y", "z").unionByName(mids.select("model_id", F.col("mid").alias("vid"), "x", "y", "z"))
    return v, out, mids.select("model_id", F.col("mid").alias("child_vid"), F.col("u").alias("p0"), F.col("w").alias("p1"))


def uniform(vertices: DataFrame, faces: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return split_marked(vertices, faces, T.unique_edges(faces))


def midpoint(vertices: DataFrame, faces: DataFrame, steps: int = 1) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``steps`` rounds: one midpoint per edge in the order the faces first meet it (ab, bc, ca), coordinates in single
    precision, collapsed faces dropped, compacted. (vertices, faces, parents, vid_remap of the last round)."""
    n_vertices = vertices.count()
    keep = lambda df: kept_in_parts(df, n_vertices)
    parents = remap = None
    for k in range(steps):
        met = T.half_edges(faces).select("model_id", F.least("a", "b").alias("u"), F.greatest("a", "b").alias("w"), (3 * F.col("fid") + F.col("corner")).alias("seen"))
        mids = keep(_midpoints(vertices, met.groupBy("model_id", "u", "w").agg(F.min("seen").alias("seen")), "seen"))
        v = vertices.select("model_id", "vid", "x", "y", "z").unionByName(mids.select("model_id", F.col("mid").alias("vid"), "x", "y", "z"))
        v = keep(v.select("model_id", "vid", *(V.f32(F.col(k)).alias(k) for k in "xyz")))
        kids = F.array(_tri("i0", "e0", "e2"), _tri("i1", "e1", "e0"), _tri("i2", "e2", "e1"), _tri("e0", "e1", "e2"))
        f = _edge_ids(faces, mids).select("model_id", "fid", F.posexplode(kids).alias("k", "t")).select("model_id", (F.col("fid") * 4 + F.col("k")).alias("fid"), "t.*")
        f = keep(G.face_areas(f, v).filter("area > 0").select("model_id", "fid", "i0", "i1", "i2"))
        v, _, remap = T.compaction(v, f)
        vertices, remap = keep(v), keep(remap)
        faces = T.renumber(f, remap)
        faces = keep(faces) if k < steps - 1 else faces
        parents = mids.select("model_id", F.col("mid").alias("child_vid"), F.col("u").alias("p0"), F.col("w").alias("p1"))
    return vertices, faces, parents, remap


def adaptive(vertices: DataFrame, faces: DataFrame, max_area: float | DataFrame, max_rounds: int = 12, max_vertices: int | None = None):
    """Split all edges of the faces at vertices whose represented area is over ``max_area`` (a number, or model_id and
    max_area) until none is. (vertices, faces, history rows: round, oversized, vertices). Too many rounds or vertices: error."""
    n_vertices = vertices.count()
    keep = lambda df: kept_in_parts(df, n_vertices)
    limit = vertices.select("model_id").distinct().withColumn("max_area", F.lit(float(max_area))) if not isinstance(max_area, DataFrame) else max_area
    history = []
    for k in range(max_rounds + 1):
        rep = G.represented_area(vertices, G.face_areas(faces, vertices)).join(limit, "model_id")
        big = keep(rep.filter(F.col("area") > F.col("max_area") * (1 + 1e-12)).select("model_id", "vid"))
        n_big, n = big.count(), vertices.count()
        history.append((k, n_big, n))
        if not n_big:
            return vertices, faces, history
        if k == max_rounds or (max_vertices and n > max_vertices):
            raise ValueError(f"{n_big} vertices are still over the area limit after {k} rounds ({n} vertices)")
        spots = faces.select("model_id", "fid", F.explode(F.array("i0", "i1", "i2")).alias("vid")).join(big, ["model_id", "vid"], "left_semi").select("model_id", "fid").distinct()
        marked = T.unique_edges(faces.join(spots, ["model_id", "fid"], "left_semi"))
        v, f, _ = split_marked(vertices, faces, marked)
        vertices, faces = keep(v), keep(f)
    raise AssertionError
