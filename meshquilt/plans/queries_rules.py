"""The rule catalogue over a dataset made from the corpus, in which each of fifty kinds of models is damaged in its own way.

The damage is SQL text that both engines apply to their own tables; the tables, the grains and the facts are computed twice: by the library's
operators here, by the common table expressions below there. Models of kind 0 are sound.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from meshquilt.operators import families as FA
from meshquilt.operators import geometry as G
from meshquilt.operators import refinement as RF
from meshquilt.operators import rules as R
from meshquilt.operators import samples as SA
from meshquilt.operators import subdivide as D
from meshquilt.operators import topology as T
from meshquilt.operators.views import CUBE_VIEWS
from meshquilt.plans.queries import query, table
from meshquilt.sources.corpus import orders_mesh
from meshquilt.sources.scratch import kept_in_parts, parts_of

ROLES = (("gt", 1.0), ("coarse", 0.5), ("expanded", 0.8))
FILES = ("gt_mesh.obj", "coarse_mesh.obj", "expanded_mesh.obj", "views/dataset.json", "views/cameras.json", "views/mesh.obj")
NAN, K = "CAST('NaN' AS double)", "model_id % 50"


def _case(column: str, *cases: tuple[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {when} THEN {then}" for when, then in cases) + f" ELSE {column} END"


#: table -> (columns as they are, damaged columns, rows that stay).
DAMAGE = {
    "mesh_v": (
        "model_id, role, vid",
        {
            "x": _case("x", (f"{K} = 1 AND role = 'gt' AND vid = 3", NAN), (f"{K} = 48 AND role = 'coarse' AND vid = 3", "NULL"), (f"{K} = 2 AND role = 'gt'", "x * 1.02"), (f"{K} = 3 AND role = 'gt'", "x * 0.9")),
            "y": _case("y", (f"{K} = 2 AND role = 'gt'", "y * 1.02"), (f"{K} = 3 AND role = 'gt'", "y * 0.9")),
            "z": _case("z", (f"{K} = 2 AND role = 'gt'", "z * 1.02"), (f"{K} = 3 AND role = 'gt'", "z * 0.9")),
        },
        f"NOT ({K} = 6 AND role = 'expanded' AND vid = 7)",
    ),
    "mesh_f": (
        "model_id, role, fid",
        {
            "i0": _case("i0", (f"{K} = 49 AND role = 'coarse' AND fid = 2", "NULL")),
            "i1": _case("i1", (f"{K} = 5 AND role = 'coarse' AND fid % 90 = 0", "i0")),
            "i2": _case("i2", (f"{K} = 4 AND role = 'coarse' AND fid % 100 = 0", "999999")),
        },
        f"NOT ({K} = 47 AND role = 'gt')",
    ),
    "targets": (
        "model_id, vid, ty, tz, w2",
        {
            "tx": _case("tx", (f"{K} = 11 AND vid = 2", NAN)),
            "surface_distance": _case("surface_distance", (f"{K} = 10 AND vid = 2", R.INF)),
            "closest_face": _case("closest_face", (f"{K} = 12 AND vid = 4", "-1"), (f"{K} = 13 AND vid = 4", "1000000000")),
            "w0": _case("w0", (f"{K} = 14 AND vid = 4", "w0 + 0.001")),
            "w1": _case("w1", (f"{K} = 15 AND vid = 4", NAN)),
            "valid_mask": _case("valid_mask", (f"{K} = 16 AND vid = 4", "NULL"), (f"{K} = 17 AND vid = 4", "2"), (f"{K} = 18 AND vid = 4", "0")),
        },
        f"NOT ({K} = 8 AND vid = 5)",
    ),
    "delta": ("model_id, vid, dx, dy", {"dz": _case("dz", (f"{K} = 19 AND vid = 9", "dz + 0.001"))}, f"NOT ({K} = 9 AND vid = 5)"),
    "prepared": ("model_id, vid, px, py", {"pz": _case("pz", (f"{K} = 20 AND vid = 9", "pz + 0.001"))}, "true"),
    "coo": ("model_id", {"row": _case("row", (f"{K} = 21 AND row = 3 AND col = 3", "100000")), "col": "col", "value": _case("value", (f"{K} = 22 AND row = 3", NAN), (f"{K} = 23 AND row = 3", "value + 0.000001"))}, f"NOT ({K} = 24 AND row = 3)"),
    "views": (
        "model_id, view_id, cy, cz, fy, fz",
        {
            "name": _case("name", (f"{K} = 28 AND view_id = 0", "'neg_x'")),
            "cx": _case("cx", (f"{K} = 27 AND view_id = 1", "cx + 0.001")),
            "fx": _case("fx", (f"{K} = 29 AND view_id = 5", "fx + 0.001")),
            "n_mask": _case("n_mask", (f"{K} = 30 AND view_id % 5 = 3", "0")),
            "n_border": _case("n_border", (f"{K} = 31 AND view_id = 4", "5")),
            "n_lit": _case("n_lit", (f"{K} = 32 AND view_id = 6", "0")),
            "n_bad_depth": _case("n_bad_depth", (f"{K} = 33 AND view_id = 7", "2")),
            "has_depth": _case("has_depth", (f"{K} = 26 AND view_id = 2", "false")),
        },
        f"NOT ({K} = 25 AND view_id = 13) AND {K} <> 45",
    ),
    "files": (
        "model_id, file",
        {"error": _case("error", (f"{K} = 37 AND file = 'coarse_mesh.obj'", "'empty'"))},
        f"NOT ({K} = 34 AND file = 'views/dataset.json') AND NOT ({K} = 35 AND file = 'views/cameras.json') AND NOT ({K} = 36 AND file = 'views/mesh.obj') AND {K} <> 46",
    ),
    "samples": (
        "model_id, n_images",
        {
            "embeds_images": f"{K} = 38",
            "storage_format": _case("storage_format", (f"{K} = 39", "'tensor_v0'")),
            "n_paths": _case("n_paths", (f"{K} = 40", "13")),
            "n_channels": _case("n_channels", (f"{K} = 41", "4")),
            "fields": _case("fields", (f"{K} = 42", "array_remove(fields, 'gt_faces')")),
            "sample_id": _case("sample_id", (f"{K} = 43", "'other'")),
        },
        f"{K} <> 44",
    ),
}


def _damaged(df, name: str):
    plain, changed, stays = DAMAGE[name]
    return df.filter(stays).selectExpr(*plain.split(", "), *(f"{e} AS {c}" for c, e in changed.items()))


def _damaged_sql(name: str, source: str) -> str:
    plain, changed, stays = DAMAGE[name]
    text = ", ".join(f"{e} AS {c}" for c, e in changed.items()).replace("array_remove(fields, 'gt_faces')", "list_filter(fields, lambda f: f <> 'gt_faces')")
    return f"{name} AS (SELECT {plain}, {text} FROM {source} WHERE {stays})"


_LAYOUT = "lay(view_id, e_name, u, v, w) AS (VALUES " + ", ".join(f"({i}, '{n}', {float(a)}::double, {float(b)}::double, {float(c)}::double)" for i, (n, a, b, c) in enumerate(CUBE_VIEWS)) + ")"
_FIELDS = "[" + ", ".join(f"'{f}'" for f in R.FIELDS) + "]"
_MESH = f""", ce AS (SELECT model_id, (min(x) + max(x)) / 2 AS cx, (min(y) + max(y)) / 2 AS cy, (min(z) + max(z)) / 2 AS cz FROM vert GROUP BY 1),
sc AS (SELECT v.model_id, greatest(max(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy) + (z - cz) * (z - cz))), 1e-12) AS s FROM vert v JOIN ce ON ce.model_id = v.model_id GROUP BY 1),
gt AS (SELECT v.model_id, vid, CAST(CAST((x - cx) / s AS float) AS double) AS x, CAST(CAST((y - cy) / s AS float) AS double) AS y, CAST(CAST((z - cz) / s AS float) AS double) AS z FROM vert v JOIN ce ON ce.model_id = v.model_id JOIN sc ON sc.model_id = v.model_id),
md AS (SELECT DISTINCT model_id FROM vert), {_LAYOUT},
v0 AS ({" UNION ALL ".join(f"SELECT model_id, '{r}' AS role, vid, {f}::double * x AS x, {f}::double * y AS y, {f}::double * z AS z FROM gt" for r, f in ROLES)} UNION ALL SELECT model_id, 'coarse', 9999, 0.1, 0.1, 0.1 FROM md WHERE {K} = 7),
f0 AS ({" UNION ALL ".join(f"SELECT model_id, '{r}' AS role, fid, i0, i1, i2 FROM face" for r, _ in ROLES)}),
nf AS (SELECT model_id, count(*) AS n FROM face GROUP BY 1),
t0 AS (SELECT model_id, vid, x AS tx, y AS ty, z AS tz, 0.2::double * sqrt(x * x + y * y + z * z) AS surface_distance, vid % n AS closest_face, 1.0::double AS w0, 0.0::double AS w1, 0.0::double AS w2, 1 AS valid_mask FROM gt JOIN nf USING (model_id)),
d0 AS (SELECT g.model_id, g.vid, coalesce(g.x - m.x, 0) AS dx, coalesce(g.y - m.y, 0) AS dy, coalesce(g.z - m.z, 0) AS dz FROM gt g LEFT JOIN (SELECT n.model_id, n.s, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM nb n JOIN gt ON gt.model_id = n.model_id AND gt.vid = n.t GROUP BY 1, 2) m ON m.model_id = g.model_id AND m.s = g.vid),
p0 AS (SELECT model_id, vid, dx AS px, dy AS py, dz AS pz FROM d0),
dg AS (SELECT model_id, s, count(*) AS n FROM nb GROUP BY 1, 2),
l0 AS (SELECT n.model_id, n.s AS row, n.t AS col, -1.0::double / dg.n AS value FROM nb n JOIN dg ON dg.model_id = n.model_id AND dg.s = n.s UNION ALL SELECT model_id, s, s, 1.0::double FROM dg),
w0 AS (SELECT model_id, view_id, e_name AS name, 1.5::double * u AS cx, 1.5::double * v AS cy, 1.5::double * w AS cz, -u / sqrt(u * u + v * v + w * w) AS fx, -v / sqrt(u * u + v * v + w * w) AS fy, -w / sqrt(u * u + v * v + w * w) AS fz,
  count(*) FILTER (WHERE u * x + v * y + w * z > 0) AS n_mask, 0 AS n_border, count(*) FILTER (WHERE u * x + v * y + w * z > 0) AS n_lit, 0 AS n_bad_depth, true AS has_depth FROM gt, lay GROUP BY model_id, view_id, e_name, u, v, w),
i0 AS (SELECT model_id, unnest([{", ".join(f"'{f}'" for f in FILES)}]) AS file, CAST(NULL AS varchar) AS error FROM md),
s0 AS (SELECT model_id, '{R.PREFIX}' || model_id AS sample_id, 'lazy_image_paths_v1' AS storage_format, 14 AS n_paths, 14 AS n_images, 3 AS n_channels, {_FIELDS} AS fields FROM md),
{", ".join(_damaged_sql(n, s) for n, s in (("mesh_v", "v0"), ("mesh_f", "f0"), ("targets", "t0"), ("delta", "d0"), ("prepared", "p0"), ("coo", "l0"), ("views", "w0"), ("files", "i0"), ("samples", "s0")))},
nv AS (SELECT model_id, role, count(*) AS n_vertices FROM mesh_v GROUP BY 1, 2),
fp AS (SELECT f.*, coalesce(n_vertices, 0) AS n_vertices, (b.y - a.y) * (c.z - a.z) - (b.z - a.z) * (c.y - a.y) AS nx, (b.z - a.z) * (c.x - a.x) - (b.x - a.x) * (c.z - a.z) AS ny, (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) AS nz
  FROM mesh_f f LEFT JOIN nv ON nv.model_id = f.model_id AND nv.role = f.role LEFT JOIN mesh_v a ON a.model_id = f.model_id AND a.role = f.role AND a.vid = f.i0 LEFT JOIN mesh_v b ON b.model_id = f.model_id AND b.role = f.role AND b.vid = f.i1
  LEFT JOIN mesh_v c ON c.model_id = f.model_id AND c.role = f.role AND c.vid = f.i2),
uu AS (SELECT v.model_id, v.role, count(*) AS n_used FROM mesh_v v WHERE EXISTS (SELECT 1 FROM (SELECT model_id, role, unnest([i0, i1, i2]) AS k FROM mesh_f) f WHERE f.model_id = v.model_id AND f.role = v.role AND f.k = v.vid) GROUP BY 1, 2),
ff AS (SELECT model_id, role, count(*) AS n_faces FROM mesh_f GROUP BY 1, 2),
xe AS (SELECT DISTINCT model_id, least(a, b) AS u, greatest(a, b) AS w FROM (SELECT model_id, i0 AS a, i1 AS b FROM mesh_f WHERE role = 'expanded' UNION ALL SELECT model_id, i1, i2 FROM mesh_f WHERE role = 'expanded' UNION ALL SELECT model_id, i2, i0 FROM mesh_f WHERE role = 'expanded')),
xn AS (SELECT model_id, u AS s, w AS t FROM xe UNION ALL SELECT model_id, w, u FROM xe),
te AS (SELECT q.model_id, q.vid, coalesce(q.tx - m.x, 0) AS ex, coalesce(q.ty - m.y, 0) AS ey, coalesce(q.tz - m.z, 0) AS ez FROM targets q LEFT JOIN (SELECT n.model_id, n.s, avg(tx) AS x, avg(ty) AS y, avg(tz) AS z FROM xn n JOIN targets r ON r.model_id = n.model_id AND r.vid = n.t GROUP BY 1, 2) m ON m.model_id = q.model_id AND m.s = q.vid),
vertex_grain AS (SELECT * FROM mesh_v), face_grain AS (SELECT *, 0.5 * sqrt(nx * nx + ny * ny + nz * nz) AS area FROM fp),
mesh_grain AS (SELECT model_id, role, coalesce(n_vertices, 0) AS n_vertices, coalesce(n_faces, 0) AS n_faces, coalesce(n_used, 0) AS n_used FROM nv FULL JOIN ff USING (model_id, role) LEFT JOIN uu USING (model_id, role)),
target_grain AS (SELECT model_id, vid, v.vid IS NOT NULL AS has_vertex, t.vid IS NOT NULL AS has_target, d.vid IS NOT NULL AS has_delta, t.* EXCLUDE (model_id, vid), d.* EXCLUDE (model_id, vid), p.* EXCLUDE (model_id, vid), e.* EXCLUDE (model_id, vid), coalesce(n_faces, 0) AS n_gt_faces
  FROM (SELECT model_id, vid FROM mesh_v WHERE role = 'expanded') v FULL JOIN targets t USING (model_id, vid) FULL JOIN delta d USING (model_id, vid) LEFT JOIN prepared p USING (model_id, vid) LEFT JOIN te e USING (model_id, vid) LEFT JOIN (SELECT model_id, n_faces FROM ff WHERE role = 'gt') USING (model_id)),
xd AS (SELECT model_id, s, count(*) AS n FROM xn GROUP BY 1, 2),
xl AS (SELECT n.model_id, n.s AS row, n.t AS col, -1.0::double / xd.n AS expected FROM xn n JOIN xd ON xd.model_id = n.model_id AND xd.s = n.s UNION ALL SELECT model_id, s, s, 1.0::double FROM xd),
laplacian_grain AS (SELECT model_id, row AS l_row, col AS l_col, value, expected, n_vertices AS n_expanded FROM coo FULL JOIN xl USING (model_id, row, col) LEFT JOIN (SELECT model_id, n_vertices FROM nv WHERE role = 'expanded') USING (model_id)),
view_grain AS (SELECT views.*, 14 AS expected_views, e_name, 1.5::double * u AS ex, 1.5::double * v AS ey, 1.5::double * w AS ez, -u / sqrt(u * u + v * v + w * w) AS gx, -v / sqrt(u * u + v * v + w * w) AS gy, -w / sqrt(u * u + v * v + w * w) AS gz FROM views LEFT JOIN lay USING (view_id)),
file_grain AS (SELECT * FROM files), sample_grain AS (SELECT * FROM samples)"""


def _facts(rules=R.RULES) -> str:
    """Facts by grain and the list of broken rules: the conditions of the catalogue, in the other engine."""
    grains = list(dict.fromkeys(r.grain for r in rules))
    parts, names = [], []
    for g in grains:
        own = [(i, r) for i, r in enumerate(rules) if r.grain == g]
        parts.append(f"{g}_facts AS (SELECT model_id, {', '.join(f'{r.aggregate()} AS r{i}' for i, r in own)} FROM {g}_grain GROUP BY model_id)")
        names += [f"coalesce(list_filter(r{i}, lambda x: x IS NOT NULL), [])" if r.tag else f"CASE WHEN CASE WHEN {g}_facts.model_id IS NULL THEN {r.absent} ELSE coalesce(r{i}, false) END THEN ['{r.name}'] ELSE [] END" for i, r in own]
    joins = " ".join(f"LEFT JOIN {g}_facts ON {g}_facts.model_id = md.model_id" for g in grains)
    return ",\n" + ",\n".join(parts) + f",\nis_ AS (SELECT md.model_id, array_to_string(list_sort(list_distinct(flatten([{', '.join(names)}]))), '|') AS issues FROM md {joins})"


@query(_MESH + _facts() + " SELECT model_id, CASE WHEN issues = '' THEN 'valid' ELSE 'invalid' END AS status, issues FROM is_")
def dataset_validation(spark, sf):
    """The whole catalogue: geometry of three meshes a model, targets, Laplacian, cameras, rasters, files, samples."""
    m = orders_mesh(spark, sf)
    gt = G.normalize(m.vertices)[0]
    models = gt.select("model_id").distinct().withColumns({"expected_views": F.lit(14), "half_extent": F.lit(1.5)})
    roles = [F.struct(F.lit(r).alias("role"), "vid", *((s * F.col(k)).alias(k) for k in "xyz")) for r, s in ROLES]
    extra = F.when(F.expr(f"{K} = 7 AND vid = 0"), F.struct(F.lit("coarse").alias("role"), F.lit(9999).cast("bigint").alias("vid"), *(F.lit(0.1).alias(k) for k in "xyz")))
    vertices = _damaged(gt.select("model_id", F.explode(F.array_compact(F.array(*roles, extra))).alias("r")).select("model_id", "r.*"), "mesh_v")  # no union: rows stay in their models' parts
    faces = _damaged(m.faces.select("*", F.explode(F.array(*(F.lit(r) for r, _ in ROLES))).alias("role")), "mesh_f")
    edges = T.unique_edges(m.faces)
    n = m.faces.groupBy("model_id").agg(F.count("*").alias("n"))
    length = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    targets = gt.join(n, "model_id").select("model_id", "vid", *(F.col(k).alias(f"t{k}") for k in "xyz"), (0.2 * length).alias("surface_distance"), (F.col("vid") % F.col("n")).alias("closest_face"), F.lit(1.0).alias("w0"), F.lit(0.0).alias("w1"), F.lit(0.0).alias("w2"), F.lit(1).alias("valid_mask"))
    targets = _damaged(targets, "targets")
    lap = kept_in_parts(G.laplacian(gt, edges), m.rows)
    delta = _damaged(lap.select("model_id", "vid", *(F.col(f"l{k}").alias(f"d{k}") for k in "xyz")), "delta")
    prepared = _damaged(lap.select("model_id", "vid", *(F.col(f"l{k}").alias(f"p{k}") for k in "xyz")), "prepared")
    coo = _damaged(G.laplacian_matrix(gt, edges), "coo")
    layout = spark.createDataFrame([(i, name, *map(float, d)) for i, (name, *d) in enumerate(CUBE_VIEWS)], "view_id int, e_name string, u double, v double, w double")
    long = F.sqrt(F.col("u") * F.col("u") + F.col("v") * F.col("v") + F.col("w") * F.col("w"))
    sees = F.count_if(F.col("u") * F.col("x") + F.col("v") * F.col("y") + F.col("w") * F.col("z") > 0)
    views = gt.join(F.broadcast(layout), F.lit(True)).groupBy("model_id", "view_id", F.col("e_name").alias("name"), "u", "v", "w").agg(sees.alias("n_mask"), sees.alias("n_lit"))  # 14 rows
    views = views.select("model_id", "view_id", "name", "n_mask", "n_lit", *((1.5 * F.col(s)).alias(f"c{k}") for k, s in zip("xyz", "uvw", strict=True)), *((-F.col(s) / long).alias(f"f{k}") for k, s in zip("xyz", "uvw", strict=True)), F.lit(0).alias("n_border"), F.lit(0).alias("n_bad_depth"), F.lit(True).alias("has_depth"))
    files = models.select("model_id", F.explode(F.array(*map(F.lit, FILES))).alias("file"), F.lit(None).cast("string").alias("error"))
    samples = models.select("model_id", F.concat(F.lit(R.PREFIX), F.col("model_id").cast("string")).alias("sample_id"), F.lit("lazy_image_paths_v1").alias("storage_format"), F.lit(14).alias("n_paths"), F.lit(14).alias("n_images"), F.lit(3).alias("n_channels"), F.array(*map(F.lit, R.FIELDS)).alias("fields"))
    grains = R.mesh_grains(vertices, faces)
    of = lambda df, role: df.filter(F.col("role") == role).drop("role")
    n_gt = of(faces, "gt").groupBy("model_id").agg(F.count("*").alias("n_gt_faces"))
    grains["target"] = R.target_grain(of(vertices, "expanded"), of(faces, "expanded"), targets, delta, prepared, n_gt)
    grains["laplacian"] = R.laplacian_grain(of(vertices, "expanded"), of(faces, "expanded"), coo)
    grains["view"] = R.view_grain(_damaged(views, "views"), layout, models)
    grains["file"], grains["sample"] = _damaged(files, "files"), _damaged(samples, "samples")
    return R.summary(R.broken(grains, models, keep=kept_in_parts))


# ---- refinement data ------------------------------------------------------------------------------------------

K2 = "model_id % 32"
_METADATA = (
    '{"status": "valid", "parameters": {"global_nearest_surface_used_for_correspondence": false}, "file_roles": {"expanded_initial_raw": "model_query", "coarse_registered_oracle": "oracle only", '
    '"P_target_oracle": "never training supervision"}, "connectivity": {"registered_coarse_used_for_query": false}, "usage_contract": {"may_connect_to_training_loader": false, '
    '"training_target": "delta_gt = L(gt_faces) @ gt_vertices", "expanded_graph_oracle_laplacian_is_training_supervision": false}}'
)
_SWAPS = (
    ('"valid"', '"failed"'), ('correspondence": false', 'correspondence": true'), ("model_query", "query"), ("oracle only", "registered"), ("never training supervision", "supervision"), ('used_for_query": false', 'used_for_query": true'),
    ('training_loader": false', 'training_loader": null'), ("L(gt_faces)", "L(expanded)"), ('is_training_supervision": false', 'is_training_supervision": true'),
)
DAMAGE |= {
    "registered": ("model_id, vid, x, y", {"z": "z"}, f"NOT ({K2} = 1 AND vid = 3)"),
    "saved": (
        "model_id, vid, kx, ky, lx, ly, w2",
        {
            "kz": _case("kz", (f"{K2} = 2 AND vid = 4", "kz + 0.001")),
            "lz": _case("lz", (f"{K2} = 3 AND vid = 4", "lz + 0.001")),
            "fid": _case("fid", (f"{K2} = 4 AND vid = 4", "-5")),
            "w0": _case("w0", (f"{K2} = 5 AND vid = 4", "w0 + 0.01"), (f"{K2} = 6 AND vid = 4", "-0.1")),
            "w1": _case("w1", (f"{K2} = 6 AND vid = 4", "0.6")),
        },
        "true",
    ),
    "stored_faces": ("model_id, fid, i1, i2", {"i0": _case("i0", (f"{K2} = 7 AND fid = 8", "i0 + 1"))}, "true"),
    "stored_query": ("model_id, vid, y", {"x": _case("x", (f"{K2} = 8 AND vid = 5", "x + 0.000000001")), "z": _case("z", (f"{K2} = 9", "cz"))}, "true"),
    "mapping": (
        "model_id, vid, g0, g2, sx, sy, ox, oy",
        {
            "kind": _case("kind", (f"{K2} = 11 AND vid = 6", "7")),
            "fid": _case("fid", (f"{K2} = 13 AND vid = 6", "-1")),
            "g1": _case("g1", (f"{K2} = 14 AND vid = 6", "g1 + 1")),
            "w0": _case("w0", (f"{K2} = 12 AND vid = 6", "w0 + 0.01"), (f"{K2} = 16 AND vid = 6", "-0.5")),
            "w1": _case("w1", (f"{K2} = 16 AND vid = 6", "1.0")),
            "w2": _case("w2", (f"{K2} = 15 AND vid = 6", NAN)),
            "sz": _case("sz", (f"{K2} = 17 AND vid = 6", "sz + 0.0001")),
            "oz": _case("oz", (f"{K2} = 18 AND vid = 6", "oz + 0.0001")),
        },
        f"NOT ({K2} = 10 AND vid = 5)",
    ),
    "origin": ("model_id, vid", {"coarse_vid": _case("coarse_vid", (f"{K2} = 20 AND vid = 2", "1000000"))}, f"NOT ({K2} = 19 AND vid = 2)"),
    "history": ("model_id, kept", {"gone": _case("gone", (f"{K2} = 21 AND kept = 20", "1000000"))}, "true"),
    "metadata_rows": ("model_id", {"metadata": _case("metadata", *((f"{K2} = {22 + i}", f"replace(metadata, '{a}', '{b}')") for i, (a, b) in enumerate(_SWAPS)))}, f"{K2} <> 31"),
}
_ALPHA = "0.95"
_STAGES = f""", md AS (SELECT DISTINCT model_id FROM vert), rg0 AS (SELECT model_id, vid, x, y, z + 0.01::double * (vid % 3) AS z FROM vert),
md_ AS (SELECT e.model_id, u, w, n + row_number() OVER (PARTITION BY e.model_id ORDER BY u, w) - 1 AS mid FROM edge e JOIN (SELECT model_id, max(vid) + 1 AS n FROM vert GROUP BY 1) USING (model_id)),
parents AS (SELECT model_id, vid, vid AS p0, vid AS p1 FROM vert UNION ALL SELECT model_id, mid, u, w FROM md_),
e3 AS (SELECT f.model_id, f.fid, f.i0, f.i1, f.i2, a.mid AS e0, b.mid AS e1, c.mid AS e2 FROM face f JOIN md_ a ON a.model_id = f.model_id AND a.u = least(i0, i1) AND a.w = greatest(i0, i1) JOIN md_ b ON b.model_id = f.model_id AND b.u = least(i1, i2) AND b.w = greatest(i1, i2)
  JOIN md_ c ON c.model_id = f.model_id AND c.u = least(i2, i0) AND c.w = greatest(i2, i0)),
made AS (SELECT model_id, 4 * fid AS fid, i0, e0 AS i1, e2 AS i2 FROM e3 UNION ALL SELECT model_id, 4 * fid + 1, i1, e1, e0 FROM e3 UNION ALL SELECT model_id, 4 * fid + 2, i2, e2, e1 FROM e3 UNION ALL SELECT model_id, 4 * fid + 3, e0, e1, e2 FROM e3),
q0 AS (SELECT p.model_id, p.vid, (a.x + b.x) / 2 AS x, (a.y + b.y) / 2 AS y, (a.z + b.z) / 2 AS z, (c.z + d.z) / 2 AS cz FROM parents p JOIN vert a ON a.model_id = p.model_id AND a.vid = p0 JOIN vert b ON b.model_id = p.model_id AND b.vid = p1
  JOIN rg0 c ON c.model_id = p.model_id AND c.vid = p0 JOIN rg0 d ON d.model_id = p.model_id AND d.vid = p1),
h0 AS (SELECT * FROM tri WHERE fid = 0),
sv0 AS (SELECT v.model_id, v.vid, v.x AS kx, v.y AS ky, v.z AS kz, r.x AS lx, r.y AS ly, r.z AS lz, 0 AS fid, 0.25::double AS w0, 0.25::double AS w1, 0.5::double AS w2 FROM vert v JOIN rg0 r USING (model_id, vid)),
mp0 AS (SELECT model_id, vid, vid % 4 AS kind, 0 AS fid, g0, g1, g2, 0.2::double AS w0, 0.3::double AS w1, 0.5::double AS w2, sx, sy, sz, x + {_ALPHA}::double * (sx - x) AS ox, y + {_ALPHA}::double * (sy - y) AS oy, z + {_ALPHA}::double * (sz - z) AS oz FROM q0
  JOIN (SELECT model_id, i0 AS g0, i1 AS g1, i2 AS g2, 0.2::double * ax + 0.3::double * bx + 0.5::double * cx AS sx, 0.2::double * ay + 0.3::double * by_ + 0.5::double * cy AS sy, 0.2::double * az + 0.3::double * bz + 0.5::double * cz AS sz FROM h0) USING (model_id)),
og0 AS (SELECT model_id, vid, vid AS coarse_vid FROM vert), hi0 AS (SELECT model_id, vid AS kept, vid + 1 AS gone FROM vert WHERE vid % 10 = 0 AND vid < 100), mt0 AS (SELECT model_id, '{_METADATA}' AS metadata FROM md),
{", ".join(_damaged_sql(n, s) for n, s in (("registered", "rg0"), ("saved", "sv0"), ("stored_faces", "made"), ("stored_query", "q0"), ("mapping", "mp0"), ("origin", "og0"), ("history", "hi0"), ("metadata_rows", "mt0")))},
coarse_grain AS (SELECT model_id, vid, a.vid IS NOT NULL AS has_raw, c.vid IS NOT NULL AS has_registered, a.x AS ax, a.y AS ay, a.z AS az, c.x AS cx, c.y AS cy, c.z AS cz, kx, ky, kz, lx, ly, lz, w0, w1, w2, f.fid IS NOT NULL AS has_face
  FROM vert a FULL JOIN registered c USING (model_id, vid) LEFT JOIN saved s USING (model_id, vid) LEFT JOIN face f ON f.model_id = s.model_id AND f.fid = s.fid),
query_grain AS (SELECT model_id, vid, q.x AS qx, q.y AS qy, q.z AS qz, (a.x + b.x) / 2 AS ax, (a.y + b.y) / 2 AS ay, (a.z + b.z) / 2 AS az, (c.x + d.x) / 2 AS cx, (c.y + d.y) / 2 AS cy, (c.z + d.z) / 2 AS cz, sqrt((a.x - c.x) * (a.x - c.x) + (a.y - c.y) * (a.y - c.y) + (a.z - c.z) * (a.z - c.z)) AS moved
  FROM stored_query q FULL JOIN parents p USING (model_id, vid) LEFT JOIN vert a ON a.model_id = p.model_id AND a.vid = p0 LEFT JOIN vert b ON b.model_id = p.model_id AND b.vid = p1 LEFT JOIN registered c ON c.model_id = p.model_id AND c.vid = p0 LEFT JOIN registered d ON d.model_id = p.model_id AND d.vid = p1),
queryface_grain AS (SELECT model_id, fid, s.i0 AS e0, s.i1 AS e1, s.i2 AS e2, m.i0 AS r0, m.i1 AS r1, m.i2 AS r2 FROM stored_faces s FULL JOIN made m USING (model_id, fid)),
mapping_grain AS (SELECT *, w0 * ax + w1 * bx_ + w2 * cx AS rx, w0 * ay + w1 * by_ + w2 * cy AS ry, w0 * az + w1 * bz + w2 * cz AS rz, qx + {_ALPHA}::double * (sx - qx) AS mx, qy + {_ALPHA}::double * (sy - qy) AS my, qz + {_ALPHA}::double * (sz - qz) AS mz FROM (
  SELECT model_id, vid, q.vid IS NOT NULL AS has_vertex, m.vid IS NOT NULL AS has_mapping, q.x AS qx, q.y AS qy, q.z AS qz, m.* EXCLUDE (model_id, vid, fid), f.fid IS NOT NULL AS has_face, f.i0 AS f0, f.i1 AS f1, f.i2 AS f2, f.ax, f.ay, f.az, f.bx AS bx_, f.by_, f.bz, f.cx, f.cy, f.cz
  FROM stored_query q FULL JOIN mapping m USING (model_id, vid) LEFT JOIN tri f ON f.model_id = m.model_id AND f.fid = m.fid)),
origin_grain AS (SELECT model_id, vid, v.vid IS NOT NULL AS has_vertex, o.vid IS NOT NULL AS has_origin, coarse_vid, n AS n_coarse FROM vert v FULL JOIN origin o USING (model_id, vid) LEFT JOIN (SELECT model_id, count(*) AS n FROM vert GROUP BY 1) USING (model_id)),
collapse_grain AS (SELECT h.*, n AS n_gt FROM history h JOIN (SELECT model_id, count(*) AS n FROM vert GROUP BY 1) USING (model_id)),
metadata_grain AS (SELECT model_id, {", ".join(f"json_extract_string(metadata, '{p}') AS {c}" for c, p in RF.METADATA.items())} FROM metadata_rows)"""


@query(_STAGES + _facts(RF.REFINEMENT_RULES) + " SELECT model_id, CASE WHEN issues = '' THEN 'valid' ELSE 'invalid' END AS status, issues FROM is_")
def refinement_validation(spark, sf):
    """The stages of refinement data: coarse and registered meshes, the query mesh, mappings, registries, metadata."""
    m = orders_mesh(spark, sf)
    lift = lambda df: df.withColumn("z", F.col("z") + 0.01 * (F.col("vid") % 3))
    before = lift(m.vertices)
    keep = lambda df: kept_in_parts(df, m.rows)
    made_v, made, kids = map(keep, D.uniform(m.vertices, m.faces))
    parents = m.vertices.select("model_id", "vid", F.col("vid").alias("p0"), F.col("vid").alias("p1")).unionByName(kids.withColumnRenamed("child_vid", "vid"))
    lifted = D.uniform(before, m.faces)[0].select("model_id", "vid", F.col("z").alias("cz"))
    query_v = keep(_damaged(made_v.join(keep(lifted), ["model_id", "vid"]), "stored_query"))
    registered = _damaged(before, "registered")
    points = before.select("model_id", "vid", *(F.col(k).alias(f"l{k}") for k in "xyz"))
    saved = m.vertices.select("model_id", "vid", *(F.col(k).alias(f"k{k}") for k in "xyz")).join(points, ["model_id", "vid"]).withColumns({"fid": F.lit(0).cast("bigint"), "w0": F.lit(0.25), "w1": F.lit(0.25), "w2": F.lit(0.5)})
    first = G.face_points(m.faces.filter("fid = 0"), m.vertices)
    aim = first.select("model_id", *(F.col(f"i{i}").alias(f"g{i}") for i in range(3)), *((0.2 * F.col(f"a{k}") + 0.3 * F.col(f"b{k}") + 0.5 * F.col(f"c{k}")).alias(f"s{k}") for k in "xyz"))
    weights = {"kind": F.col("vid") % 4, "fid": F.lit(0).cast("bigint"), "w0": F.lit(0.2), "w1": F.lit(0.3), "w2": F.lit(0.5)}
    mapping = made_v.join(aim, "model_id").withColumns({**weights, **{f"o{k}": F.col(k) + float(_ALPHA) * (F.col(f"s{k}") - F.col(k)) for k in "xyz"}})
    models = m.vertices.select("model_id").distinct()
    origin = m.vertices.select("model_id", "vid", F.col("vid").alias("coarse_vid"))
    history = m.vertices.filter("vid % 10 = 0 AND vid < 100").select("model_id", F.col("vid").alias("kept"), (F.col("vid") + 1).alias("gone"))
    grains = {
        "coarse": RF.coarse_grain(m.vertices, registered, _damaged(saved, "saved"), m.faces),
        "query": RF.query_grain(query_v, parents, m.vertices, registered),
        "queryface": RF.face_grain(_damaged(made, "stored_faces"), made),
        "mapping": RF.mapping_grain(query_v, _damaged(mapping, "mapping"), m.vertices, m.faces, models.withColumn("alpha", F.lit(float(_ALPHA)))),
        "origin": RF.origin_grain(m.vertices, _damaged(origin, "origin"), m.vertices),
        "collapse": RF.collapse_grain(_damaged(history, "history"), m.vertices),
        "metadata": RF.metadata_grain(_damaged(models.withColumn("metadata", F.lit(_METADATA)), "metadata_rows")),
    }
    return R.summary(R.broken(grains, models, RF.REFINEMENT_RULES, kept_in_parts))


@query(
    " SELECT model_id, vid, 'height' AS leaked FROM vert WHERE vid % 7 = 3"
)
def differential_leaks(spark, sf):
    """An operator that must not look at the heights of a held-back table, and does at every seventh vertex: those rows are found, no others."""
    m = orders_mesh(spark, sf)

    def features(tables):
        edges = T.unique_edges(m.faces)
        scale = G.edge_scale(tables["query"], edges).select("model_id", "vid", "h", "degree")
        known = tables["oracle"].select("model_id", "vid", F.col("z").alias("oracle_z"))
        return scale.join(known, ["model_id", "vid"]).select("model_id", "vid", "h", "degree", F.when(F.col("vid") % 7 == 3, F.col("oracle_z")).otherwise(0.0).alias("height"))

    found = RF.leaks(features, {"query": m.vertices, "oracle": m.vertices}, {"oracle": ["z"]}, "model_id", "vid")
    return found.select("model_id", "vid", F.array_join("leaked", ",").alias("leaked"))


# ---- families of manifests ------------------------------------------------------------------------------------

_SIZES = {"views_14": 14, "views_28": 28, "views_56": 56}


@query(
    f"""WITH a(arm, n) AS (VALUES {", ".join(f"('{a}', {n})" for a, n in _SIZES.items())}), s AS (SELECT CAST(c_custkey AS bigint) AS sample_id FROM customer),
    vw AS (SELECT arm, sample_id, CASE WHEN sample_id % 13 = 1 AND arm = 'views_56' THEN 'test' ELSE 'train' END AS split, v AS view_id, 'images/' || CASE WHEN sample_id % 13 = 2 AND arm = 'views_28' AND v = 9 THEN 'other' ELSE CAST(v AS varchar) END || '.png' AS image
      FROM s, a, range(56) t(v) WHERE v < n AND NOT (sample_id % 13 = 3 AND arm = 'views_14' AND v = 5) AND NOT (sample_id % 13 = 4 AND arm = 'views_28' AND v = 20) AND NOT (sample_id % 13 = 5 AND arm = 'views_56') AND NOT (sample_id % 13 = 6 AND arm = 'views_14')),
    f AS (SELECT arm, sample_id, count(*) AS c, min(view_id) AS low, max(view_id) AS high FROM vw GROUP BY 1, 2),
    p(small, large, k) AS (VALUES ('views_14', 'views_28', 14), ('views_28', 'views_56', 28)),
    l AS (SELECT small, k, vw.* FROM p JOIN vw ON arm = small WHERE view_id < k), r AS (SELECT small, k, vw.* FROM p JOIN vw ON arm = large WHERE view_id < k),
    lm AS (SELECT DISTINCT small, sample_id, split FROM p JOIN vw ON arm = small), rm AS (SELECT DISTINCT small, sample_id, split FROM p JOIN vw ON arm = large)
    SELECT arm, sample_id, 'unexpected_view_count' AS issue FROM f JOIN a USING (arm) WHERE c <> n UNION ALL SELECT arm, sample_id, 'views_not_numbered' FROM f WHERE low <> 0 OR high <> c - 1
    UNION ALL SELECT DISTINCT small, sample_id, 'not_a_prefix' FROM l FULL JOIN r USING (small, sample_id, view_id) WHERE l.image IS DISTINCT FROM r.image
    UNION ALL SELECT small, sample_id, CASE WHEN rm.split IS NULL THEN 'only_in_smaller' WHEN lm.split IS NULL THEN 'only_in_larger' ELSE 'split_differs' END FROM lm FULL JOIN rm USING (small, sample_id) WHERE lm.split IS DISTINCT FROM rm.split""",
    mesh=False,
)
def nested_manifest_issues(spark, sf):
    """Three nested view sets of every customer, damaged in six ways."""
    s = table(spark, sf, "customer").select(F.col("c_custkey").cast("bigint").alias("sample_id"))
    # samples are dealt out before their views are made: some 100 of each, eight parts' worth of rows a part
    s = s.repartition(parts_of(spark, s.count() * sum(_SIZES.values()) // 8), "sample_id")
    arms = F.explode(F.array(*(F.struct(F.lit(a).alias("arm"), F.sequence(F.lit(0), F.lit(n - 1)).alias("v")) for a, n in _SIZES.items()))).alias("a")
    v = s.select("sample_id", arms).select("sample_id", "a.arm", F.explode("a.v").alias("view_id"))
    k = F.col("sample_id") % 13
    hit = lambda i, arm: (k == i) & (F.col("arm") == arm)
    v = v.filter(~(hit(3, "views_14") & (F.col("view_id") == 5)) & ~(hit(4, "views_28") & (F.col("view_id") == 20)) & ~hit(5, "views_56") & ~hit(6, "views_14"))
    image = F.concat(F.lit("images/"), F.when(hit(2, "views_28") & (F.col("view_id") == 9), "other").otherwise(F.col("view_id").cast("string")), F.lit(".png"))
    return FA.nested(v.select("arm", "sample_id", F.when(hit(1, "views_56"), "test").otherwise("train").alias("split"), "view_id", image.alias("image")), _SIZES)


@query(
    """WITH s AS (SELECT CAST(p_partkey AS bigint) AS sample_id, p_retailprice AS vertices, p_size AS laplacian_target, p_partkey % 12 AS k FROM part),
    g AS (SELECT sample_id, vertices, laplacian_target, ['query_graph_variant=gt_adaptive', 'adaptive_reference=sub2', 'nested_view_count=14'] AS md FROM s),
    o AS (SELECT sample_id, sample_id * 1.5::double AS intrinsics, list_transform(range(28), lambda i: 'nested/' || i || '.png') AS image_paths, ['nested_view_count=28', 'camera_layout_version=nested-v1'] AS md FROM s),
    r AS (SELECT sample_id, CASE WHEN k = 1 THEN vertices + 1 ELSE vertices END AS vertices, laplacian_target, CASE WHEN k = 2 THEN 14.0::double ELSE sample_id * 1.5::double END AS intrinsics, list_transform(range(CASE WHEN k = 7 THEN 14 ELSE 28 END), lambda i: 'nested/' || i || '.png') AS image_paths,
      CASE WHEN k = 3 THEN true END AS frustum, ['query_graph_variant=' || CASE WHEN k = 4 THEN 'gt' ELSE 'gt_adaptive' END, 'adaptive_reference=sub2', 'nested_view_count=' || CASE WHEN k = 8 THEN '14' ELSE '28' END, 'camera_layout_version=nested-v1',
      'combination_arm=' || CASE WHEN k = 5 THEN 'views_28' ELSE 'views_28_gt_adaptive' END] AS md FROM s WHERE k <> 6),
    j AS (SELECT sample_id, r.sample_id IS NOT NULL AS there, r.vertices AS rv, g.vertices AS gv, r.laplacian_target AS rl, g.laplacian_target AS gl, r.intrinsics AS ri, o.intrinsics AS oi, r.image_paths AS rp, o.image_paths AS op, frustum, r.md AS rm,
      list_concat(list_filter(g.md, lambda x: NOT list_contains(list_transform(o.md, lambda y: split_part(y, '=', 1)), split_part(x, '=', 1))), o.md) AS want FROM g JOIN o USING (sample_id) LEFT JOIN r USING (sample_id)),
    i AS (SELECT sample_id, unnest(list_filter([CASE WHEN NOT there THEN 'missing_in_arm' END, CASE WHEN there AND rv IS DISTINCT FROM gv THEN 'graph_field_changed:vertices' END, CASE WHEN there AND rl IS DISTINCT FROM gl THEN 'graph_field_changed:laplacian_target' END,
      CASE WHEN there AND ri IS DISTINCT FROM oi THEN 'observation_field_differs:intrinsics' END, CASE WHEN there AND rp IS DISTINCT FROM op THEN 'observation_field_differs:image_paths' END, CASE WHEN frustum IS NOT NULL THEN 'stale_visibility:frustum' END,
      CASE WHEN there AND list_sort(list_filter(rm, lambda x: NOT starts_with(x, 'combination_arm='))) <> list_sort(want) THEN 'metadata_not_merged' END, CASE WHEN there AND NOT list_contains(rm, 'combination_arm=views_28_gt_adaptive') THEN 'combination_arm_missing' END], lambda x: x IS NOT NULL)) AS issue FROM j)
    SELECT 'views_28_gt_adaptive' AS arm, sample_id, issue FROM i""",
    mesh=False,
)
def combination_arm_issues(spark, sf):
    """A graph of one kind merged with the observations of another; arms that changed more, or less, than the observations are found."""
    s = table(spark, sf, "part").select(F.col("p_partkey").cast("bigint").alias("sample_id"), F.col("p_retailprice").alias("vertices"), F.col("p_size").alias("laplacian_target"))
    k = F.col("sample_id") % 12
    pair = lambda **kv: F.create_map(*(F.lit(x) if isinstance(x, str) else x for item in kv.items() for x in item))
    paths = lambda folder, n: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.concat(F.lit(folder + "/"), i.cast("string"), F.lit(".png")))
    graph = s.withColumns({"intrinsics": F.lit(14.0), "image_paths": paths("old", 14), "frustum": F.lit(True), "metadata": pair(query_graph_variant="gt_adaptive", adaptive_reference="sub2", nested_view_count="14")})
    observed = s.select("sample_id", (F.col("sample_id") * 1.5).alias("intrinsics"), paths("nested", 28).alias("image_paths"), pair(nested_view_count="28", camera_layout_version="nested-v1").alias("metadata"))
    arm = SA.merge_observations(graph.drop("metadata"), observed, ["intrinsics", "image_paths"]).filter(k != 6)
    entries = {"query_graph_variant": F.when(k == 4, "gt").otherwise("gt_adaptive"), "adaptive_reference": "sub2", "nested_view_count": F.when(k == 8, "14").otherwise("28"), "camera_layout_version": "nested-v1", "combination_arm": F.when(k == 5, "views_28").otherwise("views_28_gt_adaptive")}
    arm = arm.withColumns({
        "vertices": F.when(k == 1, F.col("vertices") + 1).otherwise(F.col("vertices")), "intrinsics": F.when(k == 2, 14.0).otherwise(F.col("intrinsics")),
        "image_paths": F.when(k == 7, F.slice("image_paths", 1, 14)).otherwise(F.col("image_paths")), "frustum": F.when(k == 3, True), "metadata": pair(**entries),
    })
    return FA.combined(graph, observed, arm, ["intrinsics", "image_paths"], "views_28_gt_adaptive")
