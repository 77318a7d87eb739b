"""Tables of the corpus are dealt out by model in parts by their rows, and go through no broadcast."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from meshquilt.operators import geometry as G
from meshquilt.operators import topology as T
from meshquilt.operators import views as VW
from meshquilt.sources.corpus import orders_mesh
from meshquilt.sources.scratch import PART_ROWS, by_model


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_of_the_corpus_broadcast_nothing(spark, sf):
    text = plan(entry.queries()["topology_safe_blend"](spark, sf))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_models_are_shuffled_once_and_not_put_together_again(spark, sf):
    text = plan(entry.queries()["laplacian_matrix"](spark, sf))
    assert text.count("Exchange hashpartitioning") == text.count("REPARTITION_BY_NUM") > 0


def test_parts_grow_with_the_rows(spark):
    df = spark.range(10).select(F.col("id").alias("model_id"))
    assert by_model(df, 9 * PART_ROWS + 1).rdd.getNumPartitions() == 10


def test_rounds_of_components_broadcast_nothing(spark, sf):
    m = orders_mesh(spark, sf)
    labels = T.component_roots(m.vertices, T.unique_edges(m.faces))
    assert "Broadcast" not in plan(labels.join(labels.select("model_id", F.col("vid").alias("root"), F.lit(1).alias("one")), ["model_id", "root"]))


def test_visibility_in_the_task_is_that_of_written_pictures(spark, sf):
    m = orders_mesh(spark, sf)
    few = [df.filter("model_id < 2").localCheckpoint() for df in (m.vertices, m.faces)]
    cams = VW.cube_cameras(spark, 3.0, 32)
    old = VW.renderer_visibility(VW.projected(few[0], cams), few[1], VW.rasters(*few, cams), VW.rasters(*few, cams, cull=True))
    new = VW.rendered_visibility(*few, cams).drop("error")
    rows = lambda df: sorted(map(tuple, df.select("model_id", "view_id", "vid", "frustum", "backface", "occlusion", "combined").collect()))
    assert rows(new) == rows(old) and any(r[-1] for r in rows(new))


def test_no_pixel_is_written(spark, sf):
    """The plan reads the orders only, no stored picture."""
    text = plan(entry.queries()["renderer_visibility"](spark, sf))
    assert "orders.parquet" in text and "meshquilt-" not in text and "face_id" not in text


def test_arms_and_near_duplicates_broadcast_nothing(spark, sf):
    for name in ("combination_arm_issues", "near_duplicate_pairs"):
        assert "Broadcast" not in plan(entry.queries()[name](spark, sf)), name


def test_mean_edge_lengths_do_not_depend_on_the_order_of_rows(spark):
    """A star whose lengths give other sums in other orders."""
    far = [0.1 * 3**k for k in range(12)]
    v = spark.createDataFrame([(0, 0, 0.0, 0.0, 0.0), *((0, k + 1, x, 0.0, 0.0) for k, x in enumerate(far))], "model_id long, vid long, x double, y double, z double").localCheckpoint()
    edges = [(0, 0, k + 1) for k in range(12)]
    h = set()
    for turn in range(12):
        e = spark.createDataFrame(edges[turn:] + edges[:turn], "model_id long, u long, w long").coalesce(1)
        h.add(G.edge_scale(v, e).filter("vid = 0").first()["h"])
    assert len(h) == 1 and abs(h.pop() - sum(far) / 12) < 1e-9
