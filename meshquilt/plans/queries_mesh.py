"""Registered queries: cleanup, fragments, hashes, adaptive subdivision, per-vertex frame, reports, camera and path records."""

from __future__ import annotations

from pyspark.sql import functions as F

from meshquilt.functions import vec as V
from meshquilt.operators import digests as DG
from meshquilt.operators import geometry as G
from meshquilt.operators import metrics as M
from meshquilt.operators import samples as SA
from meshquilt.operators import selection as S
from meshquilt.operators import subdivide as D
from meshquilt.operators import topology as T
from meshquilt.operators import validate as VA
from meshquilt.operators import views as VW
from meshquilt.plans.queries import _again, _and, query, rounded, table
from meshquilt.sources import files as FS
from meshquilt.sources.corpus import orders_mesh
from meshquilt.sources.scratch import kept, kept_in_parts, scratch

_DIRTY = """, d AS (SELECT model_id, fid, i0, i1, i2 FROM face UNION ALL SELECT model_id, fid + 1000000, i0, i1, i2 FROM face WHERE fid % 5 = 0
      UNION ALL SELECT model_id, fid + 2000000, i1, i2, i0 FROM face WHERE fid % 7 = 0 UNION ALL SELECT model_id, fid + 3000000, i0, i0, i1 FROM face WHERE fid % 9 = 0)"""


def _dirty(spark, sf):
    m = orders_mesh(spark, sf)
    return m.vertices, _and(m.faces, *_again(), ("fid % 9 = 0", F.col("fid") + 3000000, "i0", "i0", "i1"))


@query(_DIRTY + """, u AS (SELECT DISTINCT model_id, least(i0, i1, i2) AS a, i0 + i1 + i2 - least(i0, i1, i2) - greatest(i0, i1, i2) AS b, greatest(i0, i1, i2) AS c FROM d WHERE i0 <> i1 AND i1 <> i2 AND i0 <> i2),
    v2 AS (SELECT model_id, count(DISTINCT x) AS n FROM (SELECT model_id, a AS x FROM u UNION ALL SELECT model_id, b FROM u UNION ALL SELECT model_id, c FROM u) GROUP BY model_id)
    SELECT u.model_id, count(*) AS n_faces, any_value(n) AS n_vertices FROM u JOIN v2 USING (model_id) GROUP BY u.model_id""")
def mesh_cleanup(spark, sf):
    v, f, _ = G.clean(*_dirty(spark, sf))
    n = v.groupBy("model_id").agg(F.count("*").alias("n_vertices"))
    return f.groupBy("model_id").agg(F.count("*").alias("n_faces")).join(n, "model_id")


@query(_DIRTY + """, r AS (SELECT model_id, count(*) AS n FROM d WHERE i0 = i1 OR i1 = i2 OR i0 = i2 GROUP BY 1), k AS (SELECT model_id, count(*) AS n, count(DISTINCT (i0, i1, i2)) AS u FROM d WHERE NOT (i0 = i1 OR i1 = i2 OR i0 = i2) GROUP BY 1)
    SELECT model_id, 'repeated_index' AS step, n AS removed FROM r UNION ALL SELECT model_id, 'duplicate', n - u FROM k""")
def mesh_cleanup_log(spark, sf):
    return G.clean(*_dirty(spark, sf), version=1)[2].filter("step IN ('repeated_index', 'duplicate') AND removed > 0")


#: Grid rows 4, 9, 14... are cut out, so that each band of four rows is a component; one model of five has its faces twice and a triangle far away.
_BANDS = """, far(vid, x, y, z) AS (VALUES (9001, 50.0::double, 50.0::double, 50.0::double), (9002, 51.0::double, 50.0::double, 50.0::double), (9003, 50.0::double, 51.0::double, 50.0::double)), odd AS (SELECT DISTINCT model_id FROM vert WHERE model_id % 5 = 1),
    band AS (SELECT model_id, fid, i0, i1, i2 FROM face WHERE i0 // 16 % 5 < 4 AND i1 // 16 % 5 < 4 AND i2 // 16 % 5 < 4), kept AS (SELECT * FROM band UNION ALL SELECT model_id, fid + 10000000, i0, i1, i2 FROM band WHERE model_id % 5 = 1 UNION ALL SELECT model_id, 9000000, 9001, 9002, 9003 FROM odd),
    v2 AS (SELECT model_id, vid, x, y, z FROM vert UNION ALL SELECT model_id, vid, x, y, z FROM odd, far), lo AS (SELECT model_id, i0 // 80 AS g, min(least(i0, i1, i2)) AS root FROM band GROUP BY 1, 2), us AS (SELECT DISTINCT model_id, unnest([i0, i1, i2]) AS vid FROM band),
    label AS (SELECT v.model_id, v.vid, CASE WHEN v.vid >= 9001 THEN 9001 WHEN us.vid IS NOT NULL THEN root ELSE v.vid END AS root FROM v2 v LEFT JOIN us ON us.model_id = v.model_id AND us.vid = v.vid LEFT JOIN lo ON lo.model_id = v.model_id AND lo.g = v.vid // 80),
    cl AS (SELECT model_id, vid, dense_rank() OVER (PARTITION BY model_id ORDER BY root) - 1 AS component FROM label)"""


def _banded(spark, sf):
    m = orders_mesh(spark, sf)
    odd = m.vertices.select("model_id").distinct().filter("model_id % 5 = 1")
    band = m.faces.filter(" AND ".join(f"floor({c} / 16) % 5 < 4" for c in ("i0", "i1", "i2")))
    again = band.filter("model_id % 5 = 1").withColumn("fid", F.col("fid") + 10000000)
    faces = band.unionByName(again).unionByName(odd.selectExpr("model_id", "9000000L AS fid", "9001L AS i0", "9002L AS i1", "9003L AS i2"))
    corner = lambda vid, *p: F.struct(F.lit(vid).cast("bigint").alias("vid"), *(F.lit(c).alias(k) for k, c in zip("xyz", p, strict=True)))
    far = odd.select("model_id", F.inline(F.array(corner(9001, 50.0, 50.0, 50.0), corner(9002, 51.0, 50.0, 50.0), corner(9003, 50.0, 51.0, 50.0))))
    vertices = m.vertices.unionByName(far)
    return vertices, faces, kept(T.components(vertices, T.unique_edges(faces)), scratch(spark))


@query(_BANDS + """, fc AS (SELECT k.model_id, component, count(*) AS n_faces FROM kept k JOIN cl ON cl.model_id = k.model_id AND cl.vid = k.i0 GROUP BY 1, 2),
    bx AS (SELECT model_id, component, avg(x) AS ax, avg(y) AS ay, avg(z) AS az, min(x) AS lx, min(y) AS ly, min(z) AS lz, max(x) AS hx, max(y) AS hy, max(z) AS hz FROM v2 JOIN cl USING (model_id, vid) GROUP BY 1, 2),
    tt AS (SELECT model_id, CAST(sum(n_faces) AS bigint) AS all_faces, arg_max(component, n_faces * 1000000 - component) AS main FROM fc GROUP BY 1),
    d AS (SELECT b.model_id, b.component, n_faces, all_faces, main, greatest(m.lx - b.ax, b.ax - m.hx, 0) AS dx, greatest(m.ly - b.ay, b.ay - m.hy, 0) AS dy, greatest(m.lz - b.az, b.az - m.hz, 0) AS dz, sqrt((m.hx - m.lx) * (m.hx - m.lx) + (m.hy - m.ly) * (m.hy - m.ly) + (m.hz - m.lz) * (m.hz - m.lz)) AS diag
      FROM bx b JOIN fc USING (model_id, component) JOIN tt USING (model_id) JOIN bx m ON m.model_id = b.model_id AND m.component = main)
    SELECT model_id, component, n_faces, round(sqrt(dx * dx + dy * dy + dz * dz), 6) AS distance, sqrt(dx * dx + dy * dy + dz * dz) > 0.35 * diag AND n_faces < 0.002 * all_faces AND n_faces < 128 AND component <> main AS remote FROM d""")
def remote_fragments(spark, sf):
    return rounded(G.remote_fragments(*_banded(spark, sf)).filter("n_faces > 0"))


@query(_BANDS + " SELECT model_id, count(*) AS n_vertices, count(DISTINCT component) AS n_components FROM cl GROUP BY model_id")
def mesh_components(spark, sf):
    """The number of components among a mesh's metrics; a vertex of no face is one of its own."""
    return T.mesh_metrics(*_banded(spark, sf)).select("model_id", "n_vertices", "n_components")


@query("""WITH c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 8 THEN 'validation' WHEN c_custkey % 10 = 9 THEN 'test' ELSE 'train' END AS split FROM customer)
    SELECT id, split, row_number() OVER (PARTITION BY split ORDER BY md5('5:' || split || ':' || id), id) AS position FROM c""", mesh=False)
def shuffled_splits(spark, sf):
    s = F.when(F.col("c_custkey") % 10 == 8, "validation").when(F.col("c_custkey") % 10 == 9, "test").otherwise("train")
    return S.shuffled(table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), s.alias("split")), 5).select("id", "split", "position")


@query()
def geometry_hashes(spark, sf):
    m = orders_mesh(spark, sf)
    return DG.geometry_hash(m.vertices, m.faces).join(DG.mesh_checksum(m.vertices, m.faces), "model_id")


@query()
def adaptive_subdivision(spark, sf):
    m = orders_mesh(spark, sf)
    limit = G.represented_area(m.vertices, G.face_areas(m.faces, m.vertices)).groupBy("model_id").agg((F.max("area") * 0.6).alias("max_area"))
    v, f, _ = D.adaptive(m.vertices, m.faces, kept_in_parts(limit, m.rows))
    return kept_in_parts(rounded(G.face_areas(f, v).groupBy("model_id").agg(F.count("*").alias("n_faces"), F.sum("area").alias("area"))))


@query(""", m AS (SELECT model_id, avg(area) AS m, quantile_cont(area, 0.5) AS md FROM rep GROUP BY 1)
    SELECT r.model_id, r.vid AS vertex_index, round(r.area, 6) AS represented_area, round(r.area / m, 6) AS area_over_mean, round(r.area / md, 6) AS area_over_median, round(CASE WHEN r.area > 0 THEN m / r.area END, 4) AS sampling_density_relative,
      round(coalesce(h, 0), 6) AS mean_edge_length_h, coalesce(degree, 0) AS degree, n_faces AS incident_face_count FROM rep r JOIN m USING (model_id) LEFT JOIN hh USING (model_id, vid)""")
def vertex_metrics(spark, sf):
    m = orders_mesh(spark, sf)
    e = T.unique_edges(m.faces)
    rep = G.represented_area(m.vertices, G.face_areas(m.faces, m.vertices))
    out = M.vertex_metrics(rep, G.edge_scale(m.vertices, e), G.normal_variation(G.vertex_normals(m.vertices, m.faces), e))
    out = out.drop("area_percentile", "h_squared", "normal_variation")
    return out.select(*(F.round(c, 4 if c == "sampling_density_relative" else 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes))


@query("""WITH s AS (SELECT c_custkey AS model_id, c_mktsegment AS role, c_acctbal / sqrt(CAST(7 AS double)) AS v FROM customer) SELECT role, round(quantile_cont(v, 0.5), 6) AS median, count(*) AS n FROM s GROUP BY role""", mesh=False)
def role_medians(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("model_id"), F.col("c_mktsegment").alias("role"), (F.col("c_acctbal") / F.sqrt(F.lit(7.0))).alias("v"))
    return rounded(M.role_report(c, "v")[0])


@query("""WITH q AS (SELECT s_suppkey AS id, 100.0 + s_suppkey AS a, 50.0 AS b, -25.0 AS c FROM supplier) SELECT id, round(CAST(0.299 * a + 0.587 * b + 0.114 * c AS double), 6) AS luma, round(CAST(greatest(0, least(1, (a - 101) / 5)) AS double), 6) AS unit FROM q""", mesh=False)
def colour_scalars(spark, sf):
    a = F.col("s_suppkey") + F.lit(100.0)
    s = table(spark, sf, "supplier")
    return rounded(s.select(F.col("s_suppkey").alias("id"), V.luma(a, F.lit(50.0), F.lit(-25.0)).alias("luma"), V.unit_interval(a, F.lit(101.0), F.lit(106.0)).alias("unit")))


@query("""SELECT model_id, kind, "at", value FROM (SELECT model_id, 1 AS kind, fid AS "at", 'f ' || CAST(i0 + 1 AS varchar) || ' ' || CAST(i1 + 1 AS varchar) || ' ' || CAST(i2 + 1 AS varchar) AS value FROM face)""")
def obj_face_lines(spark, sf):
    m = orders_mesh(spark, sf)
    return FS.obj_lines(m.vertices, m.faces).filter("kind = 1")


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN '/root/data/' || p_name ELSE '/abs/' || p_name END AS path FROM part""", mesh=False)
def absolute_paths(spark, sf):
    p = F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.concat(F.lit("/abs/"), F.col("p_name")))
    out = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), SA.absolute_paths(F.array(p), "/root/data/")[0].alias("path"))
    return out


@query("""WITH a AS (SELECT o_orderkey AS model_id, md5(CAST(o_custkey AS varchar)) AS checksum FROM orders WHERE o_orderkey % 3 <> 0), b AS (SELECT o_orderkey AS model_id, CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE md5(CAST(o_custkey AS varchar)) END AS checksum FROM orders WHERE o_orderkey % 3 <> 1)
    SELECT coalesce(a.model_id, b.model_id) AS model_id, 'geometry_changed' AS rule FROM a FULL JOIN b ON a.model_id = b.model_id WHERE a.checksum IS DISTINCT FROM b.checksum""", mesh=False)
def geometry_changed(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("model_id"), F.md5(F.col("o_custkey").cast("string")).alias("checksum"))
    b = o.filter("model_id % 3 <> 1").withColumn("checksum", F.when(F.col("model_id") % 7 == 0, "x").otherwise(F.col("checksum")))
    return VA.unchanged_geometry(o.filter("model_id % 3 <> 0"), b)


@query("""WITH q(split, quota) AS (VALUES ('BUILDING', 1000000), ('MACHINERY', 1), ('NONE', 5)) SELECT split AS category, CAST(quota AS bigint) AS quota, count(c_custkey) AS available FROM q LEFT JOIN customer ON c_mktsegment = split GROUP BY 1, 2 HAVING count(c_custkey) < quota""", mesh=False)
def group_shortages(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("category"))
    return S.shortages(c, spark.createDataFrame([("BUILDING", 1000000), ("MACHINERY", 1), ("NONE", 5)], "category string, quota long"), "category")


@query("""WITH a AS (SELECT model_id, x AS px, y AS py FROM vert), t AS (SELECT model_id, 0.5 * min(CASE WHEN 3 - x > 1e-8 THEN 3 - x END) AS near, 2 * max(3 - x) AS far FROM vert GROUP BY 1) SELECT model_id, 0 AS view_id, round(near, 6) AS near, round(far, 6) AS far FROM t""".replace("WITH a AS (SELECT model_id, x AS px, y AS py FROM vert), t", ", t"))
def clip_ranges(spark, sf):
    return rounded(VW.clip_range(VW.projected(orders_mesh(spark, sf).vertices, VW.cube_cameras(spark, 3.0).filter("view_id = 0"))))
