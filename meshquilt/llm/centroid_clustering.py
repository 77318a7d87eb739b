"""Centroid clustering (12): exact k-means in integers by exponion search.

Every component x becomes the integer floor(64 x). Vectors are packed in blocks, each with its vectors' cluster, an upper
bound of the distance to its centroid and a lower bound of the distance to any other. After centroids have moved,
the bounds move with them; a vector whose upper bound stays below its lower one is not looked at. For the
others the distance to their own centroid is made exact, and where that does not settle it, only the
centroids inside the ball around that centroid of radius 2 u + s are scanned (s: the distance to the centroid next to it),
found in the list of centroids sorted by distance from it. The radius is inclusive and bounds are rounded away from a decision,
so a tie is always scanned, and goes to the smaller number. Distances themselves are integers.

A round is one pass over the blocks, which writes them anew with their bounds into the shared folder and with them each
task's sums by cluster; Spark adds these up, and only k sums of as many components as a vector has reach the driver. The centroids
(k vectors) travel with the tasks. ``k`` is bounded by that and by the k x k distances: some thousands.

Vectors with components beyond ``narrow`` (2^27 for 64) are worked in Python integers, all centroids scanned; sums are sent as digits of 30 bits,
so they are exact at any size. A distance or inertia beyond a long is returned as the largest long.

Defined results: a vector that is null, of another length, or with null or non-finite components takes no part; a null id is hashed
as the text ``null``; vectors of one id are vectors each, and where several could start, they start in the order of
their components; fewer vectors than k start as many clusters; an empty cluster keeps its centroid; an empty table gives no rows. Only
vec_id and embedding are read, so other columns can have any names.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, topk_search

DIMS, K, ROUNDS, SEED, BLOCK, SCALE = 64, 16, 3, 1, 1 << 13, 64
DIGIT = 30
#: Far above the rounding of a float's square root and sums, far below any difference that matters.
SLACK = 2.0**-40
SUMS = "cluster int, digit int, sums array<long>"


def up(x):
    return x * (1 + SLACK) + SLACK


def down(x):
    return np.maximum(x * (1 - SLACK) - SLACK, 0.0)


def narrow(dims: int) -> int:
    """Components up to this keep every squared distance under 2**62."""
    return math.isqrt((1 << 60) // dims)


def is_narrow(values: np.ndarray) -> bool:
    return values.dtype != object or not values.size or max(abs(values.min()), abs(values.max())) <= narrow(values.shape[1])


def integers(x: np.ndarray) -> np.ndarray:
    """floor(64 x), int64 where all fit ``narrow``, else Python integers."""
    if not x.size or np.abs(x).max() * SCALE < narrow(x.shape[1]):
        return np.floor(x * SCALE).astype(np.int64)
    return topk_search.whole(x)


def distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of every row of v to every row of c, exact."""
    if v.dtype == object or c.dtype == object:
        v, c = v.astype(object), c.astype(object)
        out = np.empty((len(v), len(c)), object)
        for j in range(len(c)):
            out[:, j] = ((v - c[j]) ** 2).sum(axis=1)
        return out
    most = max(np.abs(v).max(initial=0), np.abs(c).max(initial=0))
    if int(most) ** 2 * v.shape[1] < 1 << 50:  # every sum is an integer that a double holds
        fv, fc = v.astype(float), c.astype(float)
        return ((fv**2).sum(axis=1)[:, None] + (fc**2).sum(axis=1)[None] - 2 * (fv @ fc.T)).astype(np.int64)
    return np.stack([((v - row) ** 2).sum(axis=1) for row in c], axis=1) if len(c) else np.empty((len(v), 0), np.int64)


@dataclass
class Centroids:
    """k centroids: for each the others in the order of distance, and how far each has moved."""

    at: np.ndarray
    order: np.ndarray
    gaps: np.ndarray  # sorted distances, rounded down, the centroid itself first
    moved: np.ndarray  # rounded up
    others: np.ndarray  # the largest move of another one

    @classmethod
    def of(cls, rows: list[list[int]], before: Centroids | None = None) -> Centroids:
        at = np.array(rows, object)
        if is_narrow(at):
            at = at.astype(np.int64)
        k = len(at)
        if at.dtype == object:  # bounds are not used
            return cls(at, np.empty((k, 0), np.int64), np.empty((k, 0)), np.full(k, np.inf), np.full(k, np.inf))
        gap = np.sqrt(distances(at, at).astype(float))
        np.fill_diagonal(gap, -1.0)
        order = np.argsort(gap, axis=1, kind="stable")
        np.fill_diagonal(gap, 0.0)
        if before is None or before.at.dtype == object:
            moved = np.full(k, np.inf)
        else:
            moved = up(np.sqrt(((at - before.at) ** 2).sum(axis=1).astype(float)))
        top = np.sort(moved)
        others = np.where(moved == top[-1], top[-2] if k > 1 else 0.0, top[-1]) if k > 1 and (moved == top[-1]).sum() == 1 else np.full(k, top[-1])
        return cls(at, order, down(np.take_along_axis(gap, order, axis=1)), moved, others)


def two_best(d: np.ndarray, names: np.ndarray):
    """The nearest (first on a tie, ``names`` ascend), its squared distance, and bounds from it and the second one."""
    one = d.argmin(axis=1)
    first = np.take_along_axis(d, one[:, None], axis=1)[:, 0]
    second = np.partition(d, 1, axis=1)[:, 1].astype(float) if d.shape[1] > 1 else np.full(len(d), np.inf)
    return names[one], up(np.sqrt(first.astype(float))), down(np.sqrt(second))


def assign(v: np.ndarray, c: Centroids, state: tuple | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(cluster, upper, lower) of every vector, and how many distances were computed. ``state``: those before the centroids moved."""
    n, k = len(v), len(c.at)
    every = np.arange(k, dtype=np.int32)
    if v.dtype == object or c.at.dtype == object:
        a = np.array([min(range(k), key=lambda j: (row[j], j)) for row in distances(v, c.at)], np.int32)
        return a, np.full(n, np.inf), np.zeros(n), n * k
    if state is None:
        return *two_best(distances(v, c.at), every), n * k
    a, u, low = state[0].copy(), up(state[1] + c.moved[state[0]]), down(state[2] - c.others[state[0]])
    todo = np.flatnonzero(~(u < low))
    made = len(todo)
    u[todo] = up(np.sqrt(((v[todo] - c.at[a[todo]]) ** 2).sum(axis=1).astype(float)))
    todo = todo[~(u[todo] < low[todo])]
    for j in np.unique(a[todo]):
        mine = todo[a[todo] == j]
        radius = up(2 * u[mine] + (up(c.gaps[j, 1]) if k > 1 else 0.0))
        reach = np.searchsorted(c.gaps[j], radius, side="right")  # the centroids inside the ball, its surface included
        tier = np.ceil(np.log2(reach)).astype(int)
        for t in np.unique(tier):
            some = mine[tier == t]
            names = np.sort(c.order[j, : reach[tier == t].max()]).astype(np.int32)
            made += len(some) * len(names)
            a[some], u[some], low[some] = two_best(distances(v[some], c.at[names]), names)
    return a, u, low, made


class Sums:
    """Component sums, counts and inertia by cluster, in integers of any size."""

    def __init__(self, dims: int):
        self.dims, self.rows = dims, {}

    def add(self, v: np.ndarray, a: np.ndarray, own: np.ndarray | None) -> None:
        for j in np.unique(a):
            mine = a == j
            inertia = 0 if own is None else (sum(own[mine].tolist()) if own.dtype == object else int((own[mine] >> DIGIT).sum()) * (1 << DIGIT) + int((own[mine] & (1 << DIGIT) - 1).sum()))
            new = np.array([*v[mine].sum(axis=0).tolist(), int(mine.sum()), inertia], object)
            self.rows[int(j)] = self.rows[int(j)] + new if int(j) in self.rows else new

    def digits(self):
        """(cluster, digit, values): the value is the sum of values << 30 digit; only the last digit is negative."""
        for j, values in sorted(self.rows.items()):
            count = max(1, -(-max(int(x).bit_length() for x in values) // DIGIT))
            for i in range(count):
                cut = [int(x) >> DIGIT * i for x in values]
                yield j, i, cut if i == count - 1 else [x & (1 << DIGIT) - 1 for x in cut]


def _sums_batch(sums: Sums, schema: pa.Schema):
    rows = list(sums.digits())
    if rows:
        named = dict(zip(("cluster", "digit", "sums"), zip(*rows, strict=True), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(list(named[f.name]), f.type) if f.name in named else pa.nulls(len(rows), f.type) for f in schema], schema=schema)


def kept(table: DataFrame, dims: int = DIMS) -> DataFrame:
    """vec_id and x (array of doubles) of the vectors that take part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return table.filter(F.col("embedding").isNotNull() & (F.size("embedding") == dims)).filter(~bad).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def starting(rows: DataFrame, k: int = K, seed: int = SEED) -> list[list[int]]:
    """The k vectors of the smallest digests of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = rows.select(digest.alias("digest"), "x").orderBy("digest", "x").limit(k).collect()
    return [[int(v) for v in topk_search.whole(np.array([r["x"]]))[0]] for r in first]


def _packed(rows: DataFrame, centroids: Centroids, dims: int) -> DataFrame:
    """Blocks with their first state, and the sums."""
    schema = pa.schema([("data", pa.binary()), ("cluster", pa.int32()), ("digit", pa.int32()), ("sums", pa.list_(pa.int64()))])

    def pack(batches):
        sums, waiting, held = Sums(dims), [], 0

        def settle(ids, known, x):
            large = np.abs(x).max(axis=1) * SCALE >= narrow(dims)
            for part in (~large, large):
                if part.any():
                    v = integers(x[part])
                    state = assign(v, centroids, None)[:3]
                    sums.add(v, state[0], None)
                    small = v if v.dtype == object else v.astype(np.min_scalar_type(-int(np.abs(v).max(initial=1)) - 1))
                    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((ids[part], known[part], small, state), 5)]), *(pa.nulls(1, t) for t in schema.types[1:])], schema=schema)

        def taken():
            return (np.concatenate(c) for c in zip(*waiting, strict=True))

        for b in batches:
            ids, x = b.column(0), b.column(1)
            waiting.append((ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False), x.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)))
            held += b.num_rows
            if held >= BLOCK:
                yield from settle(*taken())
                waiting, held = [], 0
        if held:
            yield from settle(*taken())
        yield from _sums_batch(sums, schema)

    return rows.select("vec_id", "x").mapInArrow(pack, f"data binary, {SUMS}")


def _again(blocks: DataFrame, centroids: Centroids, dims: int, final: bool) -> DataFrame:
    """The blocks with the state after a move, and the sums; for the last time a row for each vector instead."""
    head = [("vec_id", pa.int64()), ("distance", pa.int64())] if final else [("data", pa.binary())]
    schema = pa.schema([*head, ("cluster", pa.int32()), ("digit", pa.int32()), ("sums", pa.list_(pa.int64()))])

    def step(batches):
        sums = Sums(dims)
        for b in batches:
            for value in b.column(0):
                ids, known, small, state = pickle.loads(value.as_py())
                v = small if small.dtype == object else small.astype(np.int64)
                state = assign(v, centroids, state)[:3]
                if not final:
                    sums.add(v, state[0], None)
                    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((ids, known, small, state), 5)]), *(pa.nulls(1, t) for t in schema.types[1:])], schema=schema)
                    continue
                mine = centroids.at[state[0]]
                own = ((v - mine) ** 2).sum(axis=1) if v.dtype == mine.dtype else ((v.astype(object) - mine.astype(object)) ** 2).sum(axis=1)
                sums.add(v, state[0], own)
                distance = pa.array([topk_search.longest(d) for d in own] if own.dtype == object else own, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=~known), distance, pa.array(state[0], pa.int32()), *(pa.nulls(len(ids), t) for t in schema.types[3:])], schema=schema)
        yield from _sums_batch(sums, schema)

    ddl = f"vec_id long, distance long, {SUMS}" if final else f"data binary, {SUMS}"
    return blocks.select("data").mapInArrow(step, ddl)


def _totals(written: DataFrame, k: int, width: int) -> list[list[int]]:
    """Component sums, count and inertia of every cluster: k rows of ``width`` values reach the driver, times the digits of the largest."""
    by = written.filter("digit IS NOT NULL").select("cluster", "digit", F.posexplode("sums").alias("pos", "value")).groupBy("cluster", "digit", "pos").agg(F.sum("value").alias("value"))
    out = [[0] * width for _ in range(k)]
    for r in by.collect():
        out[r["cluster"]][r["pos"]] += r["value"] << DIGIT * r["digit"]
    return out


def clustered(table: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, stored: one row for each vector that takes part."""
    spark = table.sparkSession
    rows = kept(table, dims)
    c = Centroids.of(start) if (start := starting(rows, k, seed)) else None
    shape = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if c is None:
        return spark.createDataFrame([], shape)
    k, width, path = len(c.at), dims + 2, shared.scratch(spark)
    with shared.batches(spark, 4096):
        blocks = shared.stored(_packed(rows, c, dims), path)
    with shared.batches(spark, 1):  # a block is a batch
        for turn in range(1, rounds + 1):
            if turn > 1:
                before, path = path, shared.scratch(spark)
                blocks = shared.stored(_again(blocks.filter("data IS NOT NULL"), c, dims, False), path)
                shared.discard(spark, before)
            sums = _totals(blocks, k, width)
            c = Centroids.of([[x // s[dims] for x in s[:dims]] if s[dims] else c.at[j].tolist() for j, s in enumerate(sums)], c)
        written = shared.stored(_again(blocks.filter("data IS NOT NULL"), c, dims, True), shared.scratch(spark))
    shared.discard(spark, path)
    inertia = [s[dims + 1] for s in _totals(written, k, width)]
    told = [(str(j), str(topk_search.longest(inertia[j])), str(topk_search.longest(sum(inertia))), hashlib.sha256(",".join(str(int(x)) for x in c.at[j]).encode()).hexdigest()) for j in range(k)]
    by = shared.literal_table(spark, told, ("cluster", "cluster_inertia", "inertia", "centroid_sha256"))
    by = by.select(*(F.col(n).cast(t).alias(n) for n, t in (("cluster", "int"), ("cluster_inertia", "long"), ("inertia", "long"))), "centroid_sha256")
    return written.filter("digit IS NULL").select("vec_id", "cluster", "distance").join(F.broadcast(by), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows


def op12_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    return clustered(shared.table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    d2 = "CAST(list_sum(list_transform(range(1, 65), lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i]))) AS BIGINT)"
    near = f"SELECT v.r, arg_min(c.j, {{key}}) AS j FROM v, c{{n}} c GROUP BY v.r".replace("{key}", f"{{{{'d': {d2}, 'j': c.j}}}}").replace("{{", "{").replace("}}", "}")
    parts = [
        "WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS v FROM embeddings "
        "WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "c0 AS (SELECT j, v FROM (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS j FROM v) WHERE j < 16)",
    ]
    for n in range(ROUNDS + 1):
        parts.append(f"a{n} AS MATERIALIZED ({near.replace('{n}', str(n))})")
        if n < ROUNDS:
            parts.append(f"s{n} AS (SELECT j, i, sum(x) AS s, count(*) AS n FROM (SELECT a.j, unnest(range(1, 65)) AS i, unnest(v.v) AS x FROM a{n} a JOIN v USING (r)) GROUP BY j, i)")
            parts.append(f"m{n} AS (SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM s{n} GROUP BY j)")
            parts.append(f"c{n + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m USING (j))")
    parts.append(f"f AS (SELECT v.vec_id, CAST(c.j AS INTEGER) AS cluster, {d2} AS distance, sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{ROUNDS} a JOIN v USING (r) JOIN c{ROUNDS} c ON c.j = a.j)")
    return ",\n".join(parts) + (
        "\nSELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM f"
    )


SQL = _sql()

shared.by_value(__name__)
