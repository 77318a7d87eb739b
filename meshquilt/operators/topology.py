"""Edges, degrees, duplicates, compaction, winding, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meshquilt.sources.scratch import kept, scratch


def half_edges(faces: DataFrame) -> DataFrame:
    """The three directed edges of each face: model_id, fid, corner, a, b."""
    three = F.array(*(F.struct(F.lit(c).alias("corner"), F.col(f"i{c}").alias("a"), F.col(f"i{(c + 1) % 3}").alias("b")) for c in range(3)))
    return faces.select("model_id", "fid", F.explode(three).alias("e")).select("model_id", "fid", "e.*")


def unique_edges(faces: DataFrame) -> DataFrame:
    """Undirected edges, u < w, each once."""
    return half_edges(faces).select("model_id", F.least("a", "b").alias("u"), F.greatest("a", "b").alias("w")).filter("u <> w").distinct()


def neighbours(edges: DataFrame) -> DataFrame:
    """Both directions of every edge: model_id, vid, nb (one pass, no union of two scans)."""
    both = F.array(F.struct(F.col("u").alias("vid"), F.col("w").alias("nb")), F.struct(F.col("w").alias("vid"), F.col("u").alias("nb")))
    return edges.select("model_id", F.explode(both).alias("e")).select("model_id", "e.*")


def degree(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    n = neighbours(edges).groupBy("model_id", "vid").agg(F.count("*").alias("degree"))
    return vertices.select("model_id", "vid").join(n, ["model_id", "vid"], "left").select("model_id", "vid", F.coalesce("degree", F.lit(0)).alias("degree"))


def repeated_index():
    return (F.col("i0") == F.col("i1")) | (F.col("i1") == F.col("i2")) | (F.col("i0") == F.col("i2"))


def distinct_faces(faces: DataFrame, by_set: bool = False) -> DataFrame:
    """The first face of each ordered triple, or of each set of three indices."""
    key = F.sort_array(F.array("i0", "i1", "i2")) if by_set else F.array("i0", "i1", "i2")
    one = faces.groupBy("model_id", key.alias("k")).agg(F.min_by(F.struct("fid", "i0", "i1", "i2"), "fid").alias("f"))
    return one.select("model_id", "f.*")


def compaction(vertices: DataFrame, faces: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Drop unreferenced vertices: (vertices, faces, vid_remap); new ids are dense in the old order."""
    used = faces.select("model_id", F.explode(F.array("i0", "i1", "i2")).alias("vid")).distinct()
    kept = vertices.join(used, ["model_id", "vid"], "left_semi")
    order = Window.partitionBy("model_id").orderBy("vid")
    remap = kept.select("model_id", F.col("vid").alias("old_vid"), (F.row_number().over(order) - 1).cast("bigint").alias("new_vid"))
    moved = vertices.join(remap.withColumnRenamed("old_vid", "vid"), ["model_id", "vid"]).drop("vid").withColumnRenamed("new_vid", "vid")
    return moved.select(*vertices.columns), renumber(faces, remap), remap


def renumber(faces: DataFrame, remap: DataFrame) -> DataFrame:
    """Face indices through a vid_remap; faces that lose a vertex go."""
    out = faces
    for c in ("i0", "i1", "i2"):
        out = out.join(remap.select("model_id", F.col("old_vid").alias(c), F.col("new_vid").alias(f"n{c}")), ["model_id", c]).drop(c).withColumnRenamed(f"n{c}", c)
    return out.select(*faces.columns)


def old_to_new(vertices: DataFrame, remap: DataFrame) -> DataFrame:
    """Every old vertex with its new id, -1 if it was dropped."""
    r = remap.withColumnRenamed("old_vid", "vid")
    return vertices.select("model_id", "vid").join(r, ["model_id", "vid"], "left").select("model_id", F.col("vid").alias("old_vid"), F.coalesce("new_vid", F.lit(-1).cast("bigint")).alias("new_vid"))


def winding_conflicts(faces: DataFrame) -> DataFrame:
    """Directed edges that more than one face uses."""
    return half_edges(faces).groupBy("model_id", "a", "b").agg(F.count("*").alias("n")).filter("n > 1")


def mesh_metrics(vertices: DataFrame, faces: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Counts, watertightness (every undirected edge in two faces), Euler number and bounding box of each model; with the
    ``labels`` of ``components`` also n_components."""
    box = [f(c).alias(f"{n}_{c}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max))]
    v = vertices.groupBy("model_id").agg(F.count("*").alias("n_vertices"), *box)
    uses = half_edges(faces).groupBy("model_id", F.least("a", "b").alias("u"), F.greatest("a", "b").alias("w")).agg(F.count("*").alias("uses"))
    e = uses.groupBy("model_id").agg(F.count("*").alias("n_edges"), F.count(F.when(F.col("uses") == 1, 1)).alias("n_boundary"), F.bool_and(F.col("uses") == 2).alias("watertight"))
    f = faces.groupBy("model_id").agg(F.count("*").alias("n_faces"))
    out = v.join(f, "model_id", "left").join(e, "model_id", "left")
    zero = F.lit(0).cast("bigint")
    if labels is not None:
        out = out.join(labels.groupBy("model_id").agg((F.max("component") + 1).alias("n_components")), "model_id", "left")
    return out.select(
        "model_id", "n_vertices", F.coalesce("n_faces", zero).alias("n_faces"), F.coalesce("n_edges", zero).alias("n_edges"), F.coalesce("n_boundary", zero).alias("n_boundary"),
        F.coalesce("watertight", F.lit(False)).alias("watertight"),
        (F.col("n_vertices") - F.coalesce("n_edges", zero) + F.coalesce("n_faces", zero)).alias("euler"), *[f"{n}_{c}" for c in "xyz" for n in ("min", "max")],
        *([F.coalesce("n_components", zero).alias("n_components")] if labels is not None else []),
    )


def component_roots(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """model_id, vid, root (the component's smallest vid). Minimum labels with pointer jumping; every round is
    stored, so lineage stays short and lost executors cost one round. Labels take a hundredth of their room in files, so joins are kept from broadcasting them."""
    spark = vertices.sparkSession
    near = kept(neighbours(edges), scratch(spark))
    label = kept(vertices.select("model_id", "vid", F.col("vid").alias("root")), scratch(spark))
    mark = None
    while True:
        seen = near.join(label.withColumnRenamed("vid", "nb").withColumnRenamed("root", "r"), ["model_id", "nb"]).groupBy("model_id", "vid").agg(F.min("r").alias("r"))
        low = label.join(seen, ["model_id", "vid"], "left").select("model_id", "vid", F.least("root", F.coalesce("r", "root")).alias("root"))
        low = kept(low, scratch(spark))
        jump = low.select("model_id", F.col("vid").alias("root"), F.col("root").alias("r2"))
        label = kept(low.join(jump, ["model_id", "root"]).select("model_id", "vid", F.col("r2").alias("root")), scratch(spark))
        now = label.agg(F.sum("root"), F.bit_xor(F.xxhash64("model_id", "vid", "root"))).first()
        if now == mark:
            return label
        mark = now


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """model_id, vid, component: dense labels in the order of the smallest member."""
    roots = component_roots(vertices, edges)
    return roots.select("model_id", "vid", (F.dense_rank().over(Window.partitionBy("model_id").orderBy("root")) - 1).cast("bigint").alias("component"))


def component_faces(faces: DataFrame, labels: DataFrame) -> DataFrame:
    """Faces, vertices and the running vertex offset of each component."""
    v = labels.groupBy("model_id", "component").agg(F.count("*").alias("n_vertices"))
    f = faces.join(labels.withColumnRenamed("vid", "i0"), ["model_id", "i0"]).groupBy("model_id", "component").agg(F.count("*").alias("n_faces"))
    before = Window.partitionBy("model_id").orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return v.join(f, ["model_id", "component"], "left").select(
        "model_id", "component", "n_vertices", F.coalesce("n_faces", F.lit(0)).alias("n_faces"), (F.sum("n_vertices").over(before) - F.col("n_vertices")).alias("offset")
    )
