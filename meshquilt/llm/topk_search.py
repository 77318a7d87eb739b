"""Exact top-k search (8): a bit-sliced index.

Every component x becomes the integer floor(64 x). Rows are laid out in blocks of ``BLOCK``; for each
attribute a block holds bit slices: bitmaps over the rows, one for each bit of (value - the attribute's
smallest value in the block). A query's inner products with a whole block are formed by bitmap adders:
for each attribute and each bit of the query's factor, the attribute's slices, shifted, are added to the
sum's slices with carries, 64 rows a word. The sum's slices are then read from the most significant one
down: rows with the bit set are above, while they are fewer than k they are in; what is left at the
bottom are the rows that tie at the boundary, of which the smallest ids fill up the k. Everything is
integer, so results are exact.

The index is stored once, a row for each block. Queries are packed into chunks of at most ``QUERIES``; every
block meets every chunk of its vector length in one job, ``TASK_BLOCKS`` blocks a task, which keeps k rows a
query. (A stated set against all rows, in blocks.)

Components of ``plain`` size, for which no inner product can leave 62 bits, are sliced. Vectors with a larger one are
kept whole and multiplied as integers of any length, so order is exact for every finite vector; a score beyond
the range of a long is returned as the nearest long.

Defined results: a vector that is null, empty or holds null, NaN or infinite components takes no part,
as query or row; ties go to the smaller id; a query's own id is no candidate, repeated ids included; fewer
candidates than k give all; vectors of another length than the query's are no candidates; repeated rows
are candidates each; a repeated query id gives results once for each of its rows; very long vectors make
smaller blocks.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared

BLOCK, QUERIES, TOGETHER, TASK_BLOCKS = 1 << 14, 4096, 64, 64
VALUES = 1 << 21  # components of a block or chunk at most (one vector at least)
SCALE = 64
K = 20


def vectors(table: DataFrame) -> DataFrame:
    """vec_id and x (array of doubles) of the rows that take part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    clean = table.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.col("vec_id").isNotNull() & ~bad)
    return clean.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def plain(x: np.ndarray) -> np.ndarray:
    """Which vectors (rows of doubles) have small components only: an inner product of two such stays under 2**62."""
    return (np.abs(x) * SCALE < 2.0 ** ((62 - (x.shape[1] - 1).bit_length()) // 2) - 1).all(axis=1)


def whole(x: np.ndarray) -> np.ndarray:
    """floor(64 x) as Python integers."""
    out = np.empty(x.shape, object)
    for i, v in np.ndenumerate(x):
        out[i] = int(v) * SCALE if abs(v) >= 2.0**53 else math.floor(v * SCALE)
    return out


class Slices:
    """The bit slices of one block: ``rows`` values by attribute."""

    def __init__(self, values: np.ndarray):
        self.n, self.dims = values.shape
        self.low = values.min(axis=0) if self.n else np.zeros(self.dims, np.int64)
        rest = (values - self.low).astype(np.uint64)
        self.words = -(-self.n // 64)
        padded = np.zeros((self.words * 64, self.dims), np.uint64)
        padded[: self.n] = rest
        self.slices = []
        for d in range(self.dims):
            top = int(rest[:, d].max()).bit_length() if self.n else 0
            self.slices.append([np.packbits((padded[:, d] >> np.uint64(b) & np.uint64(1)).astype(np.uint8), bitorder="little").view(np.uint64) for b in range(top)])
        self.real = np.packbits(np.arange(self.words * 64) < self.n, bitorder="little").view(np.uint64)

    def state(self) -> tuple:
        return self.n, self.dims, self.low, self.words, self.slices, self.real

    @classmethod
    def of(cls, state: tuple) -> Slices:
        block = cls.__new__(cls)
        block.n, block.dims, block.low, block.words, block.slices, block.real = state
        return block

    def sums(self, queries: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Slices of (inner product - base), least first, each (queries, words); and base by query. The
        factors are made non-negative: a negative one counts the slices' complement instead."""
        q = len(queries)
        factor = np.abs(queries)
        flip = np.where(queries < 0, ~np.uint64(0), np.uint64(0))
        total: list[np.ndarray] = []
        base = queries @ self.low
        for d in range(self.dims):
            own = self.slices[d]
            if not own:
                continue
            base = base + np.where(queries[:, d] < 0, queries[:, d] * ((1 << len(own)) - 1), 0)
            turned = [s[None, :] ^ flip[:, d, None] for s in own]
            for bit in range(int(factor[:, d].max()).bit_length()):
                take = np.where(factor[:, d] >> bit & 1, ~np.uint64(0), np.uint64(0))[:, None]
                if take.any():
                    self._add(total, [t & take for t in turned], bit, q)
        return total, base

    def _add(self, total: list[np.ndarray], addend: list[np.ndarray], shift: int, q: int) -> None:
        while len(total) < shift:
            total.append(np.zeros((q, self.words), np.uint64))
        carry = None
        for j, x in enumerate(addend):
            at = shift + j
            if at == len(total):
                total.append(x if carry is None else x ^ carry)
                carry = None if carry is None else x & carry
                continue
            s = total[at]
            if carry is None:
                total[at], carry = s ^ x, s & x
            else:
                both = s ^ x
                total[at], carry = both ^ carry, (s & x) | (both & carry)
        at = shift + len(addend)
        while carry is not None and carry.any():
            if at == len(total):
                total.append(carry)
                return
            total[at], carry = total[at] ^ carry, total[at] & carry
            at += 1


def _bits(mask: np.ndarray) -> np.ndarray:
    return np.unpackbits(mask.view(np.uint8), axis=-1, bitorder="little").astype(bool)


def best(block: Slices, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """(query index, row) of each query's k best rows of the block and their scores."""
    total, base = block.sums(queries)
    q = len(queries)
    left = np.tile(block.real, (q, 1))  # rows that may still be in
    order = np.argsort(ids, kind="stable")
    begin, stop = np.searchsorted(ids[order], query_ids), np.searchsorted(ids[order], query_ids, "right")
    for i in np.flatnonzero(stop > begin):  # not the query itself
        for r in order[begin[i] : stop[i]]:
            left[i, r >> 6] &= ~np.uint64(1 << (int(r) & 63))
    inside = np.zeros_like(left)
    need = np.full(q, k)
    for s in reversed(total):
        high = left & s
        n = np.bitwise_count(high).sum(axis=1, dtype=np.int64)
        few = (n <= need)[:, None]
        inside |= np.where(few, high, np.uint64(0))
        left = np.where(few, left & ~s, high)
        need -= np.where(few[:, 0], n, 0)
    query, row = np.nonzero(_bits(inside))
    edge_q, edge_r = np.nonzero(_bits(left))  # all of one score: the boundary
    rank = np.lexsort((ids[edge_r], edge_q))
    edge_q, edge_r = edge_q[rank], edge_r[rank]
    place = np.arange(len(edge_q)) - np.searchsorted(edge_q, edge_q)
    use = place < need[edge_q]
    query, row = np.concatenate((query, edge_q[use])), np.concatenate((row, edge_r[use]))
    score = base[query].copy()
    for b, s in enumerate(total):
        score += ((s[query, row >> 6] >> (row & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << b
    return query, row, score


def longest(score) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, int(score)))


def best_whole(rows: np.ndarray, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """As ``best``, with integers of any length in place of slices; scores are Python integers."""
    query, row, score = [], [], []
    for i, own in enumerate(queries):
        scores = rows @ own
        order = sorted((j for j in range(len(ids)) if ids[j] != query_ids[i]), key=lambda j: (-scores[j], ids[j]))[:k]
        query += [i] * len(order)
        row += order
        score += [scores[j] for j in order]
    return np.array(query, np.int64), np.array(row, np.int64), score


def _values(block: Slices) -> np.ndarray:
    """The integers that the slices stand for."""
    out = np.tile(block.low, (block.n, 1))
    for d, own in enumerate(block.slices):
        for b, s in enumerate(own):
            out[:, d] += _bits(s)[: block.n].astype(np.int64) << b
    return out


def _packed(rows: DataFrame, most: int, sliced: bool) -> DataFrame:
    """at, dims, n, data of blocks of at most ``most`` rows of one vector length. data: the ids, then the bit slices (or,
    unless ``sliced``, the vectors), then the ids and vectors of those that are not plain."""

    def pack(batches):
        waiting: dict[int, list] = {}
        held: dict[int, int] = {}
        at = TaskContext.get().partitionId() << 32

        def settle(n):
            nonlocal at
            ids, x = (np.concatenate(c) for c in zip(*waiting.pop(n), strict=True))
            held.pop(n)
            small = plain(x) if sliced else np.ones(len(x), bool)
            kept = Slices(np.floor(x[small] * SCALE).astype(np.int64)).state() if sliced else x
            data = pickle.dumps((ids[small], kept, ids[~small], x[~small]), 5)
            at += 1
            return pa.RecordBatch.from_arrays([pa.array([at - 1]), pa.array([n]), pa.array([len(ids)]), pa.array([data])], ["at", "dims", "n", "data"])

        for b in batches:
            ids, values = b.column(0).to_numpy(zero_copy_only=False), b.column(1)
            size = values.value_lengths().to_numpy(zero_copy_only=False)
            flat = values.flatten().to_numpy(zero_copy_only=False)
            stop = np.cumsum(size)
            for n in np.unique(size).tolist():
                mine = np.flatnonzero(size == n)
                step = max(1, min(most, VALUES // n))
                while len(mine):
                    some, mine = mine[: step - held.get(n, 0)], mine[step - held.get(n, 0) :]
                    waiting.setdefault(n, []).append((ids[some], flat[(stop[some] - n)[:, None] + np.arange(n)]))
                    held[n] = held.get(n, 0) + len(some)
                    if held[n] >= step:
                        yield settle(n)
        for n in sorted(waiting):
            yield settle(n)

    return rows.select("vec_id", "x").mapInArrow(pack, "at long, dims long, n long, data binary")


def _best_of(data: tuple, asked: tuple, k: int):
    """(query, vec_id, score) of the k best of a block for every query of a chunk."""
    ids, block, wide_ids, wide = data
    query_ids, x = asked
    small = plain(x)
    found = []
    if len(ids):
        block = Slices.of(block)
        at = np.flatnonzero(small)
        own = np.floor(x[at] * SCALE).astype(np.int64)
        for i in range(0, len(at), TOGETHER):
            query, row, score = best(block, ids, query_ids[at[i : i + TOGETHER]], own[i : i + TOGETHER], k)
            found.append((at[query + i], ids[row], score))
        if not small.all():
            at = np.flatnonzero(~small)
            query, row, score = best_whole(_values(block).astype(object), ids, query_ids[at], whole(x[at]), k)
            found.append((at[query], ids[row], score))
    if len(wide_ids):
        query, row, score = best_whole(whole(wide), wide_ids, query_ids, whole(x), k)
        found.append((query, wide_ids[row], score))
    return found


def _kept(found: list, k: int) -> list:
    """``found`` cut to the k best of each query."""
    query, vec = (np.concatenate([f[j] for f in found]) for j in (0, 1))
    if all(isinstance(f[2], np.ndarray) for f in found):
        score = np.concatenate([f[2] for f in found])
        rank = np.lexsort((vec, -score, query))
    else:
        score = np.empty(len(query), object)
        score[:] = [int(s) for f in found for s in f[2]]
        rank = np.array(sorted(range(len(query)), key=lambda i: (query[i], -score[i], vec[i])), np.int64)
    query, vec, score = query[rank], vec[rank], score[rank]
    use = np.arange(len(query)) - np.searchsorted(query, query) < k
    return [(query[use], vec[use], score[use])]


def search(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score, stored. ``rows`` and ``queries``: vec_id and x, as ``vectors`` gives them."""
    spark = rows.sparkSession
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, tables = spark.conf.get(setting), shared.Tables(spark)
    spark.conf.set(setting, "4096")
    index, asked = tables.stored(_packed(rows, BLOCK, True)), tables.stored(_packed(queries, QUERIES, False))
    spark.conf.set(setting, "1")  # a block, or a chunk, is a batch
    groups = max(1, -(-index.count() // TASK_BLOCKS))
    group = F.pmod(F.xxhash64("at"), F.lit(groups)).cast("int")
    met = index.select("dims", group.alias("g"), F.lit(1).alias("kind"), "data").join(asked.select("dims", F.col("at").alias("chunk")), "dims")
    sides = met.select("chunk", "g", "kind", "data").unionByName(asked.select(F.col("at").alias("chunk"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(0).alias("kind"), "data"))

    def scan(batches):
        chunk, ask, found = None, None, []

        def told():
            (query, vec, score) = _kept(found, k)[0]
            high = pa.array([str(int(s)) for s in score], pa.string()) if score.dtype == object else pa.nulls(len(score), pa.string())
            exact = pa.array([longest(s) for s in score], pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(query), chunk)), pa.array(query), pa.array(ask[0][query]), pa.array(vec), exact, high], ["chunk", "q", "query_id", "vec_id", "score", "wide"])

        for b in batches:
            for i in range(b.num_rows):
                key, kind, data = b.column(0)[i].as_py(), b.column(2)[i].as_py(), pickle.loads(b.column(3)[i].as_py())
                if kind == 0:
                    if found:
                        yield told()
                    chunk, ask, found = key, data[:2], []
                else:
                    found += _best_of(data, ask, k)
                    if sum(len(f[0]) for f in found) > 4 * k * len(ask[0]):
                        found = _kept(found, k)
        if found:
            yield told()

    dealt = sides.repartition("chunk", "g").sortWithinPartitions("chunk", "g", "kind")
    near = dealt.mapInArrow(scan, "chunk long, q long, query_id long, vec_id long, score long, wide string")
    # a score that may be beyond a long comes as text too: order by its sign, length and digits
    text = F.coalesce("wide", F.col("score").cast("string"))
    minus = text.startswith("-")
    digits = F.lpad(F.regexp_replace(text, "-", ""), 1300, "0")
    turned = F.when(minus, F.concat(F.lit("0"), F.translate(digits, "0123456789", "9876543210"))).otherwise(F.concat(F.lit("1"), digits))
    exact = F.when((F.col("score") > -(1 << 63)) & (F.col("score") < (1 << 63) - 1), F.lit(None)).otherwise(turned)
    order = Window.partitionBy("chunk", "q").orderBy(F.desc("score"), F.desc("exact"), "vec_id")
    top = near.withColumn("exact", exact).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    done = shared.stored(top.select("query_id", "rank", "vec_id", "score"), shared.scratch(spark))
    spark.conf.set(setting, before)
    tables.drop()
    return done


def op8_topk_search(spark, sf_dir: str) -> DataFrame:
    rows = vectors(shared.table(spark, sf_dir, "embeddings"))
    return search(rows, rows.filter(F.col("vec_id") % 20 == 0))


SQL = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r AS q, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
k AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 20
"""

shared.by_value(__name__)
