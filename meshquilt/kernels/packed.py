"""Whole meshes as rows: pack to arrays, run a NumPy kernel per model in an Arrow group, unpack."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import closest, noise, raster, simplify

for _module in (closest, noise, raster, simplify):
    cloudpickle.register_pickle_by_value(sys.modules[_module.__name__])


def pack(vertices: DataFrame, faces: DataFrame, *more: str) -> DataFrame:
    """model_id, vids, v (flat x, y, z and ``more`` columns of vertices), fids, f (flat places in vids order). One mesh is one row: the unit of these kernels
    is a model, whose size is bounded by the corpus rules (at most 20 million faces), not by the corpus."""
    v = vertices.groupBy("model_id").agg(F.sort_array(F.collect_list(F.struct("vid", "x", "y", "z", *more))).alias("p"))
    f = faces.groupBy("model_id").agg(F.sort_array(F.collect_list(F.struct("fid", "i0", "i1", "i2"))).alias("t"))
    flat = v.join(f, "model_id", "left").select("model_id", F.col("p.vid").alias("vids"), *(F.col(f"p.{k}").alias(k) for k in (*"xyz", *more)), F.col("t.fid").alias("fids"), *(F.col(f"t.{k}").alias(k) for k in ("i0", "i1", "i2")))
    return flat


def arrays(batch: pa.RecordBatch, row: int, more: tuple = (), loose: bool = False) -> tuple:
    """(model_id, vids, vertices, fids, faces as places, ``more`` columns of vertices) of one packed row. A face whose corner names no vertex is an error,
    or with ``loose`` has the place -1 there."""
    get = lambda name: np.asarray(batch.column(name)[row].values) if batch.column(name)[row].is_valid else np.empty(0)
    vids = get("vids").astype(np.int64)
    v = np.stack([get(k).astype(float) for k in "xyz"], axis=1) if len(vids) else np.empty((0, 3))
    fids = get("fids").astype(np.int64)
    named = np.stack([get(k).astype(np.int64) for k in ("i0", "i1", "i2")], axis=1) if len(fids) else np.empty((0, 3), np.int64)
    f = np.searchsorted(vids, named)
    gone = vids[np.minimum(f, len(vids) - 1)] != named if len(vids) else np.ones(named.shape, bool)
    if gone.any() and not loose:
        raise IndexError(f"{gone.sum()} face corners name no vertex, as {named[gone][0]}")
    f[gone] = -1
    return batch.column("model_id")[row].as_py(), vids, v, fids, f, *(get(k).astype(float) for k in more)


def each_model(packed: DataFrame, kernel, schema: str, more: tuple = (), loose: bool = False) -> DataFrame:
    """``kernel(model_id, vids, vertices, fids, faces) -> dict of columns`` for every model, with ``more`` columns of vertices after them. What it raises
    becomes one row with the text in ``error``; other models go on. ``loose``: see ``arrays``."""

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    kinds = StructType.fromDDL(schema)
    types = {f.name: to_arrow_type(f.dataType) for f in kinds.fields}
    model_type = to_arrow_type(packed.schema["model_id"].dataType)
    shape = pa.schema([("model_id", model_type), *types.items(), ("error", pa.string())])

    def rows(batches):
        for b in batches:
            for i in range(b.num_rows):
                model = b.column("model_id")[i].as_py()
                try:
                    _, *mesh = arrays(b, i, more, loose)
                    out = {k: np.asarray(c) for k, c in kernel(model, *mesh).items()}
                    n = len(next(iter(out.values())))
                    yield pa.RecordBatch.from_pydict({"model_id": [model] * n, **out, "error": pa.nulls(n, pa.string())}, schema=shape)
                except Exception as e:  # noqa: BLE001  one model's failure is data
                    yield pa.RecordBatch.from_pydict({"model_id": [model], **{k: pa.nulls(1, t) for k, t in types.items()}, "error": [f"{type(e).__name__}: {e}"]}, schema=shape)

    return packed.mapInArrow(rows, f"model_id {packed.schema['model_id'].dataType.simpleString()}, {schema}, error string")
