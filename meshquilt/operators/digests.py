"""Byte-exact digests of meshes: rows are fed to SHA-256 in order, so no model is ever held whole.

The rows of a model go to one task, sorted there by Spark (which spills), and pass through in batches; what stays in memory is a batch and the state
of one digest. A digest depends on order, so a model is one task's; models are spread.
"""

from __future__ import annotations

import hashlib
import inspect
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AXES, CORNERS = ("x", "y", "z"), ("i0", "i1", "i2")


def _fed(rows: DataFrame, name: str, single: bool) -> DataFrame:
    """``rows``: model_id, kind (0: x, y, z; 1: i0, i1, i2), and the columns that order them. Vertices are fed as float64 (``single``: float32), faces as int64."""
    import pyarrow as pa

    model = rows.schema["model_id"].dataType
    order = [c for c in rows.columns if c not in ("model_id", "kind", *AXES, *CORNERS)]

    def digest(batches):
        now, state = None, None
        for b in batches:
            ids, kind = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False)
            points = np.stack([b.column(2 + k).fill_null(0).to_numpy(zero_copy_only=False) for k in range(3)], axis=1).astype(np.float32 if single else np.float64)
            corners = np.stack([b.column(5 + k).fill_null(0).to_numpy(zero_copy_only=False) for k in range(3)], axis=1).astype(np.int64)
            start = 0
            for i in range(1, len(ids) + 1):  # runs of one model and kind
                if i < len(ids) and ids[i] == ids[start] and kind[i] == kind[start]:
                    continue
                if state is None or ids[start] != now:
                    if state is not None:
                        yield pa.RecordBatch.from_pydict({"model_id": pa.array([now]), name: [state.hexdigest()]})
                    now, state = ids[start], hashlib.sha256()
                if kind[start] < 2:
                    state.update((points, corners)[kind[start]][start:i].tobytes())
                else:
                    state.update(corners[start:i, :1].tobytes())
                start = i
        if state is not None:
            yield pa.RecordBatch.from_pydict({"model_id": pa.array([now]), name: [state.hexdigest()]})

    dealt = rows.repartition("model_id").sortWithinPartitions("model_id", "kind", *order)
    return dealt.select("model_id", "kind", *AXES, *CORNERS).mapInArrow(digest, f"model_id {model.simpleString()}, {name} string")


def _vertex_rows(points: DataFrame, *order) -> DataFrame:
    return points.select("model_id", F.lit(0).alias("kind"), *order, *AXES, *(F.lit(None).cast("bigint").alias(c) for c in CORNERS))


def mesh_checksum(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """model_id, checksum: SHA-256 over the vertices' coordinates (float64) in the order of their ids, then the faces' corners (int64) in that of theirs."""
    f = faces.select("model_id", F.lit(1).alias("kind"), F.col("fid").alias("at"), *(F.lit(None).cast("double").alias(k) for k in AXES), *CORNERS)
    return _fed(_vertex_rows(vertices, F.col("vid").alias("at")).unionByName(f), "checksum", False)


def geometry_hash(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """model_id, geometry_hash: SHA-256 over the box-centred vertices divided by the longest side, rounded to five decimals (half to even), sorted, as
    float32, and then the number of faces: equal for equal geometry whatever the order, place and size."""
    box = vertices.groupBy("model_id").agg(*(((F.min(k) + F.max(k)) * 0.5).alias(f"c{k}") for k in AXES))
    moved = vertices.join(box, "model_id").select("model_id", "vid", *((F.col(k) - F.col(f"c{k}")).alias(k) for k in AXES))
    side = moved.groupBy("model_id").agg(F.greatest(*(F.max(k) - F.min(k) for k in AXES), F.lit(1e-12)).alias("s"))
    cells = moved.join(side, "model_id").select("model_id", "vid", *((F.rint(F.col(k) / F.col("s") * 1e5) / 1e5).alias(k) for k in AXES))
    v = _vertex_rows(cells, *((F.col(k) + 0.0).alias(f"at_{k}") for k in AXES), F.col("vid").alias("at"))
    n = vertices.select("model_id").distinct().join(faces.groupBy("model_id").agg(F.count("*").alias("n")), "model_id", "left")
    empty = [F.lit(None).cast("double").alias(c) for c in ("at_x", "at_y", "at_z")]
    count = n.select("model_id", F.lit(2).alias("kind"), *empty, F.lit(0).cast("bigint").alias("at"), *(F.lit(None).cast("double").alias(k) for k in AXES), F.coalesce("n", F.lit(0)).alias("i0"), *(F.lit(None).cast("bigint").alias(c) for c in CORNERS[1:]))
    return _fed(v.unionByName(count), "geometry_hash", True)


def source_checksum(*parts) -> str:
    """SHA-256 of the source text of functions, classes or modules, in their order."""
    return hashlib.sha256("".join(inspect.getsource(p) for p in parts).encode()).hexdigest()


cloudpickle.register_pickle_by_value(sys.modules[__name__])
