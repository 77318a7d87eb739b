"""Meshes of a corpus of small models are worked in their models' parts: what is dealt out is the corpus, not pairs, edges or corners."""

import re
import time

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from meshquilt.kernels import simplify
from meshquilt.operators import correspond as C
from meshquilt.operators import geometry as G
from meshquilt.operators import nearest as N
from meshquilt.operators import subdivide as D
from meshquilt.operators import topology as T
from meshquilt.sources.corpus import orders_mesh
from meshquilt.sources.scratch import joined_in_parts


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def only_the_corpus_is_dealt(df) -> bool:
    text = plan(df)
    return text.count("Exchange hashpartitioning") == text.count("REPARTITION_BY_NUM") > 0


def test_small_models_meet_their_surface_without_a_grid(spark, sf, monkeypatch):
    m = orders_mesh(spark, sf)
    q = m.vertices.filter("vid % 7 = 0").withColumn("z", F.col("z") + 0.01 * (F.col("vid") % 5))
    packed = N.nearest_faces(q, m.vertices, m.faces)
    assert only_the_corpus_is_dealt(packed)
    monkeypatch.setattr(N, "MOST_PAIRS", 0)
    rows = lambda df: {(r["model_id"], r["vid"]): (r["fid"], *(round(r[c], 9) for c in ("d2", "w0", "w1", "w2", "tx", "ty", "tz"))) for r in df.collect()}
    one = rows(packed)
    assert one == rows(N.nearest_faces(q, m.vertices, m.faces)) and len(one) == q.count()
    monkeypatch.setattr(N, "MOST_PAIRS", 300 * 300 // 7)  # the last, shorter models are packed, the others are not
    assert one == rows(N.nearest_faces(q, m.vertices, m.faces))


def test_faces_and_points_that_cannot_be_used_are_left_out(spark, sf):
    m = orders_mesh(spark, sf)
    q = m.vertices.withColumn("x", F.when(F.col("vid") == 3, float("nan")).when(F.col("vid") == 4, None).otherwise(F.col("x")))
    f = m.faces.withColumn("i2", F.when(F.col("fid") == 0, 999999).when(F.col("fid") == 1, None).otherwise(F.col("i2")))
    v = m.vertices.withColumn("y", F.when(F.col("vid") == 40, float("inf")).otherwise(F.col("y")))
    got = N.nearest_faces(q, v, f)
    assert got.filter("vid IN (3, 4) OR fid IN (0, 1)").count() == 0 and got.filter("isnan(d2) OR d2 = double('inf')").count() == 0
    assert got.count() == q.filter("vid NOT IN (3, 4)").count()


def height_field(n=300, width=16):
    at = np.arange(n)
    v = np.stack((at % width / 16, at // width / 16, np.random.default_rng(5).uniform(0, 1, n)), axis=1)
    lower = [(k, k + 1, k + width) for k in range(n - width) if k % width < width - 1]
    upper = [(k + 1, k + width + 1, k + width) for k in range(n - width - 1) if k % width < width - 1]
    return v, np.array(lower + upper)


def test_a_collapse_of_a_small_model_takes_hundredths_of_a_second():
    v, f = height_field()
    took = []
    for _ in range(5):
        began = time.process_time()
        nv, nf, to, history = simplify.collapse(v, f, 100)
        took.append(time.process_time() - began)
    assert len(nv) == 100 and len(history) == 200 and set(to) == set(range(100)) and nf.min() >= 0 and nf.max() < 100
    assert min(took) < 0.2  # 0.46 s with arrays of three and four numbers, 0.04 s now


def dealt_again(df) -> int:
    """Exchanges that are not of the corpus or of a table read back, and not by model alone."""
    return len([line for line in plan(df).split("\n") if "Exchange hashpartitioning(" in line and "REPARTITION_BY_NUM" not in line and not re.search(r"hashpartitioning\(model_id#\d+L?, \d+\)", line)])


def test_joins_in_parts_deal_nothing_again_and_restore_the_settings(spark, sf):
    m = orders_mesh(spark, sf)
    names = ("spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.unionOutputPartitioning")
    before = [spark.conf.get(n, None) for n in names]
    assert dealt_again(G.face_areas(m.faces, m.vertices)) > 0
    with joined_in_parts(spark):
        assert dealt_again(G.face_areas(m.faces, m.vertices)) == 0
    try:
        with joined_in_parts(spark):
            raise KeyError
    except KeyError:
        pass
    assert [spark.conf.get(n, None) for n in names] == before


def test_steps_of_cleanup_and_subdivision_come_dealt_by_model(spark, sf):
    m = orders_mesh(spark, sf)
    for df in (*G.clean(m.vertices, m.faces)[:2], *D.midpoint(m.vertices, m.faces)[:1], *D.adaptive(m.vertices, m.faces, 1.0)[:2]):
        assert only_the_corpus_is_dealt(df)


def test_results_of_long_plans_are_read_back(spark, sf):
    """So their joins were planned in parts; what is left is a scan and at most an exchange by model."""
    for name in ("area_conserved", "spearman_area_scale", "adaptive_subdivision", "midpoint_validation", "refinement_validation", "surface_targets", "surface_distance_stats"):
        assert dealt_again(entry.queries()[name](spark, sf)) == 0, name


def test_added_faces_and_views_stay_in_their_parts(spark, sf):
    for name in ("winding_conflicts", "duplicate_faces_ordered", "duplicate_faces_any_order"):
        assert only_the_corpus_is_dealt(entry.queries()[name](spark, sf)), name
    lines = plan(entry.queries()["nested_manifest_issues"](spark, sf)).split("\n")
    assert not [line for line in lines if "Exchange hashpartitioning" in line and "view_id" in line]


def test_validation_keeps_rows_of_all_grains_in_their_parts(spark, sf):
    assert dealt_again(entry.queries()["dataset_validation"](spark, sf)) == 0
    m = orders_mesh(spark, sf)
    coo = G.laplacian_matrix(m.vertices, m.faces.selectExpr("model_id", "i0 AS u", "i1 AS w").distinct())
    assert "Union" not in plan(coo) and coo.filter("row = col AND value <> 1").count() == 0


def test_rounds_of_perturbation_are_worked_in_one_task(spark, sf):
    """Nothing but the corpus is dealt and no round is written; what comes out neither flips nor collapses, however strong the noise."""
    m = orders_mesh(spark, sf)
    f = m.faces.withColumn("i2", F.when((F.col("model_id") == 1) & (F.col("fid") == 0), 999999).otherwise(F.col("i2")))  # a corner that names no vertex
    out = G.perturb(m.vertices, f, 7, std_h=2.0)
    assert only_the_corpus_is_dealt(out) and "meshquilt-" not in plan(out)
    got = out.localCheckpoint()
    assert got.count() == m.vertices.count() and got.filter("abs(offset) > 0.001").count() > 100
    assert G.topology_change(m.vertices, got, f).filter("flipped OR collapsed").count() == 0
    assert dealt_again(entry.queries()["synthetic_samples"](spark, sf)) == 0


def test_packed_targets_are_those_of_the_joins(spark, sf):
    """Clusters' and edges' faces first, then components: the same rows as by joins, and nothing but the corpus is dealt."""
    m = orders_mesh(spark, sf)
    v, f = (df.filter("model_id < 2").localCheckpoint() for df in (m.vertices, m.faces))
    f = f.filter("fid % 32 NOT IN (10, 11)").localCheckpoint()  # two components
    res = C.simplified(v, f, 20).localCheckpoint()
    cv, cf, mapping = C.unpacked(res)
    ev, _, parents = D.uniform(cv, cf)
    want = C.provenance_targets(ev, parents, v, f, mapping, T.components(v, T.unique_edges(f)))
    names = ("model_id", "vid", "kind", "fid", "distance", "w0", "w1", "w2")
    rows = lambda df: sorted((*r[:4], *(round(x, 12) for x in r[4:])) for r in df.select(*names).collect())
    got = C.packed_targets(v, f, 20)
    assert rows(got) == rows(want) and {r[2] for r in rows(got)} == {0, 1, 2, 3} and got.filter("error IS NOT NULL").count() == 0
    assert only_the_corpus_is_dealt(entry.queries()["provenance_targets"](spark, sf))
