"""The mesh corpus derived from the ``orders`` table, and alias-tolerant record readers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meshquilt.sources.scratch import by_model, shuffled_joins

MODEL_KEYS, WIDTH = 300, 16
XY, Z = 257.0, 160000000003.0


@dataclass(frozen=True)
class Mesh:
    """Vertices and faces in long form; ``rows``: vertices of all models, by which they are dealt out."""

    vertices: DataFrame
    faces: DataFrame
    rows: int = 0


def orders_mesh(spark: SparkSession, sf_dir: str) -> Mesh:
    """Height fields: a model is a block of 300 order keys, so there are as many as the table is long; vertices in key order on
    a grid of width 16, two triangles a cell. Models are dealt out once, in parts by the number of rows; what is grouped by model stays in its part."""
    block = F.expr(f"o_orderkey div {MODEL_KEYS}")
    table = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = table.count()
    orders = by_model(table.select(block.alias("model_id"), "o_orderkey", "o_totalprice"), rows)
    by = Window.partitionBy("model_id")
    vid = (F.row_number().over(by.orderBy("o_orderkey")) - 1).cast("bigint")
    wide = orders.withColumn("vid", vid).withColumn("n", F.count("*").over(by))
    cell = F.col("vid") % WIDTH
    vertices = wide.select(
        "model_id", "vid",
        (cell.cast("double") / F.sqrt(F.lit(XY))).alias("x"),
        (F.floor(F.col("vid").cast("double") / F.lit(float(WIDTH))).cast("double") / F.sqrt(F.lit(XY))).alias("y"),
        (F.col("o_totalprice") / F.sqrt(F.lit(Z))).alias("z"),
    )
    v = F.col("vid")
    lower = F.when(v + WIDTH < F.col("n"), F.struct((2 * v).alias("fid"), v.alias("i0"), (v + 1).alias("i1"), (v + WIDTH).alias("i2")))
    upper = F.when(v + WIDTH + 1 < F.col("n"), F.struct((2 * v + 1).alias("fid"), (v + 1).alias("i0"), (v + WIDTH + 1).alias("i1"), (v + WIDTH).alias("i2")))
    cells = wide.filter((cell < WIDTH - 1) & (v + 1 < F.col("n")))
    faces = cells.select("model_id", F.explode(F.array_compact(F.array(lower, upper))).alias("f")).select("model_id", "f.*")
    return Mesh(shuffled_joins(vertices), shuffled_joins(faces), rows)


#: The same corpus in SQL that DuckDB reads; ``{sql}`` follows the common table expressions.
MESH_SQL = """
WITH v AS (SELECT o_orderkey // 300 AS model_id, o_totalprice AS h,
    CAST(row_number() OVER (PARTITION BY o_orderkey // 300 ORDER BY o_orderkey) - 1 AS bigint) AS vid FROM orders),
vert AS (SELECT model_id, vid, CAST(vid % 16 AS double) / sqrt(CAST(257 AS double)) AS x,
    CAST(floor(CAST(vid AS double) / CAST(16 AS double)) AS double) / sqrt(CAST(257 AS double)) AS y,
    h / sqrt(CAST(160000000003 AS double)) AS z FROM v),
face AS (SELECT a.model_id, 2 * a.vid AS fid, a.vid AS i0, a.vid + 1 AS i1, a.vid + 16 AS i2
    FROM vert a JOIN vert d ON a.model_id = d.model_id AND d.vid = a.vid + 16 WHERE a.vid % 16 < 15
  UNION ALL SELECT a.model_id, 2 * a.vid + 1, a.vid + 1, a.vid + 17, a.vid + 16
    FROM vert a JOIN vert e ON a.model_id = e.model_id AND e.vid = a.vid + 17 WHERE a.vid % 16 < 15),
half AS (SELECT model_id, fid, 0 AS corner, i0 AS a, i1 AS b FROM face UNION ALL SELECT model_id, fid, 1, i1, i2 FROM face
    UNION ALL SELECT model_id, fid, 2, i2, i0 FROM face),
edge AS (SELECT DISTINCT model_id, least(a, b) AS u, greatest(a, b) AS w FROM half),
nb AS (SELECT model_id, u AS s, w AS t FROM edge UNION ALL SELECT model_id, w, u FROM edge),
pt AS (SELECT model_id * 100000000 + vid AS k, x, y, z FROM vert),
fk AS (SELECT *, model_id * 100000000 + i0 AS k0, model_id * 100000000 + i1 AS k1, model_id * 100000000 + i2 AS k2 FROM face),
tri AS (SELECT f.model_id, f.fid, f.i0, f.i1, f.i2, a.x AS ax, a.y AS ay, a.z AS az, b.x AS bx, b.y AS by_, b.z AS bz, c.x AS cx, c.y AS cy, c.z AS cz
    FROM fk f JOIN pt a ON f.k0 = a.k JOIN pt b ON f.k1 = b.k JOIN pt c ON f.k2 = c.k),
nrm AS (SELECT *, (by_ - ay) * (cz - az) - (bz - az) * (cy - ay) AS nx, (bz - az) * (cx - ax) - (bx - ax) * (cz - az) AS ny,
    (bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax) AS nz FROM tri),
area AS (SELECT *, 0.5 * sqrt(nx * nx + ny * ny + nz * nz) AS area FROM nrm),
corner AS (SELECT model_id, fid, i0 AS vid, area FROM area UNION ALL SELECT model_id, fid, i1, area FROM area UNION ALL SELECT model_id, fid, i2, area FROM area),
rep AS (SELECT v.model_id, v.vid, coalesce(sum(c.area) / 3, 0) AS area, count(c.fid) AS n_faces FROM vert v LEFT JOIN corner c
    ON v.model_id = c.model_id AND v.vid = c.vid GROUP BY v.model_id, v.vid),
hh AS (SELECT n.model_id, n.s AS vid, avg(sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) + (p.z - q.z) * (p.z - q.z))) AS h, count(*) AS degree
    FROM nb n JOIN vert p ON p.model_id = n.model_id AND p.vid = n.s JOIN vert q ON q.model_id = n.model_id AND q.vid = n.t GROUP BY n.model_id, n.s),
lap AS (SELECT v.model_id, v.vid, coalesce(v.x - m.x, 0) AS lx, coalesce(v.y - m.y, 0) AS ly, coalesce(v.z - m.z, 0) AS lz FROM vert v LEFT JOIN
    (SELECT n.model_id, n.s, avg(q.x) AS x, avg(q.y) AS y, avg(q.z) AS z FROM nb n JOIN vert q ON q.model_id = n.model_id AND q.vid = n.t GROUP BY n.model_id, n.s) m
    ON v.model_id = m.model_id AND v.vid = m.s)
"""


def first_of(*columns: str, kind: str | None = None):
    """The first alias that has a value; with ``kind`` the first that can be read as it."""
    if kind:
        return F.coalesce(*(F.col(c).try_cast(kind) for c in columns))
    return F.coalesce(*(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in columns))


def entry_int(columns: list[str], default: int = -1):
    """An integer from aliased fields; values that cannot be read pass on to the next alias."""
    return F.coalesce(first_of(*columns, kind="bigint"), F.lit(default).cast("bigint"))


def mesh_arrays(entries: DataFrame, keys=(("vertices", "verts", "v"), ("faces", "facets", "triangles", "f"))) -> DataFrame:
    """Vertices and faces under any of their aliases; an entry without them is an error row."""
    have = [[c for c in names if c in entries.columns] for names in keys]
    missing = [names[0] for names, found in zip(keys, have, strict=True) if not found]
    if missing:
        raise ValueError(f"no column holds {', '.join(missing)}")
    out = entries.withColumn("vertices", F.coalesce(*have[0])).withColumn("faces", F.coalesce(*have[1]))
    return out.withColumn("reason", F.when(F.col("vertices").isNull() | F.col("faces").isNull(), "missing_mesh"))
