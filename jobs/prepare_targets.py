"""Training targets of a mesh corpus, one row a vertex, by split.

    python -m jobs.prepare_targets --tables DIR --output DIR [--config jobs/prepare_targets.json]

Reads ``orders.parquet`` under ``--tables`` as meshes. Every model is judged first; the manifest (``manifest/config=...``, by
split) holds its counts and the first rule that it breaks. Of the models that break none, every vertex gets its
Laplacian, mean edge length, edge-scale-normalised target, represented area and area percentile (``targets/config=...``, by split). A
model's split hangs on its id and the seed alone, so it stays where it is when the corpus grows.

Edge scales and areas are written first (``work/config=...``), so that no task joins all of it at once; joins stay in their models' parts.
All folders are of one configuration and are replaced whole, so a second run, also one after a failure, leaves the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import common
from meshquilt.operators import geometry as G
from meshquilt.operators import metrics as M
from meshquilt.operators import selection as S
from meshquilt.operators import topology as T
from meshquilt.sources.corpus import orders_mesh


@dataclass(frozen=True)
class Config:
    min_vertices: int = 128
    min_faces: int = 128
    max_faces: int = 200_000
    validation: float = 0.1
    test: float = 0.1
    seed: int = 1949


def run(spark: SparkSession, tables: str, output: str, config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """Writes and returns, read back, the manifest (model_id, n_vertices, n_faces, reason, split) and the targets."""
    name = common.config_name(config)
    mesh = orders_mesh(spark, tables)
    common.log.info("reading meshes from %s/orders.parquet, configuration %s: %s", tables, name, config)
    facts = S.model_facts(mesh.vertices, mesh.faces)
    split = S.hash_split(F.col("model_id").cast("string"), config.seed, config.validation, config.test)
    judged = facts.select("model_id", "n_vertices", "n_faces", S.candidate_reason(config.min_vertices, config.min_faces, config.max_faces).alias("reason"), split.alias("split"))
    place = f"{output}/manifest/config={name}"
    common.write(judged, place, "the manifest", "split")
    manifest = spark.read.schema(judged.schema).parquet(place)
    models, points, left = manifest.agg(F.count("*"), F.coalesce(F.sum("n_vertices"), F.lit(0)), F.count("reason")).first()
    common.log.info("read %s models of %s vertices, %s of them are rejected", models, points, left)
    good = manifest.filter("reason IS NULL").select("model_id", "split")
    vertices, faces = mesh.vertices.join(good, "model_id", "left_semi"), mesh.faces.join(good, "model_id", "left_semi")
    edges = T.unique_edges(faces)
    scale = common.aside(G.edge_scale(vertices, edges), f"{output}/work/config={name}/scale", mesh.rows)
    areas = common.aside(G.represented_area(vertices, G.face_areas(faces, vertices)), f"{output}/work/config={name}/area", mesh.rows)
    target = G.normalized_target(G.laplacian(vertices, edges), scale)
    area = M.area_percentile(areas).select("model_id", "vid", "area", "area_percentile")
    rows = target.join(area, ["model_id", "vid"]).join(good, "model_id").select(
        "model_id", "vid", "lx", "ly", "lz", "h", "degree", "valid", "tx", "ty", "tz", "area", "area_percentile", "split"
    )
    place = f"{output}/targets/config={name}"
    common.write(rows, place, "targets", "split")
    return manifest, spark.read.schema(rows.schema).parquet(place)


def main() -> None:
    args = common.command(__doc__, "tables", "output")
    spark = common.session("prepare_targets")
    try:
        run(spark, args.tables, args.output, common.configured(spark, Config, args.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
