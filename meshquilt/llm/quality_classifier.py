"""Quality classifier (6): random-indexing vectors, pooled, under a two-layer network.

Random indexing: a word's context vector is the sum, over the whole corpus, of the sparse ternary index
vectors of its neighbours. Every word that makes up at least one in ``SHARE`` of the corpus's words, and occurs
``MIN_COUNT`` times, has a vector of its own (so there are ``SHARE`` of them at most, whatever the corpus); rarer
words share ``SLOTS`` hashed ones, as a vector from a few contexts says little. The same is done for word shapes (case,
length, symbols, position of marks), which unknown words share. A document is the mean of its words' and shapes'
vectors and of its rates of repeated words and windows. A two-layer NumPy network is trained on at most
``FIT_ROWS`` labelled rows (drawn by a hash of the id); a temperature fitted on rows kept out of the training
calibrates its probabilities. Sums are added up as a tree of ``FAN`` at a time.

Defined results: a null or empty text has the zero vector and gets the network's answer for it; without
both labels every score is the share of ones (0.5 if no label); null labels teach nothing; repeated rows
give repeated rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, textkit

SLOTS, DIMS, NONZERO, REACH = 1 << 13, 32, 2, 2
SHARE, MIN_COUNT, FAN, FLUSH = 1 << 16, 8, 64, 1 << 20
SHAPES = 1 << 9
FIT_ROWS = 20_000
HIDDEN, EPOCHS, STEP, DECAY, SEED = 32, 60, 0.01, 1e-4, 11
EXTRA = 4
WIDTH = 2 * DIMS + EXTRA


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """By byte: bits for a soft mark (1), a lower-case letter (2) and a digit (4); and capitals plus 2^32 marks."""
    c = np.arange(256)
    upper, lower, digit = (c >= 65) & (c <= 90), (c >= 97) & (c <= 122) | (c >= 0x80), (c >= 48) & (c <= 57)
    soft = (c == 46) | (c == 44)
    mark = ~(upper | lower | digit | soft) & (c > 32)
    return (soft + 2 * lower + 4 * digit).astype(np.uint8), upper.astype(np.int64) + (mark.astype(np.int64) << 32)


def tokens(data: np.ndarray, offs: np.ndarray):
    """(row, word hash, shape) of every word."""
    start, end, row = textkit.words(data, offs)
    h = textkit.Spans(data).hash(start, end)
    shape = np.zeros(len(start), np.int64)
    if len(start):
        kinds, counts = _classes()
        # a word's sums run up to the next word: the spaces between them, which start no slice, count as nothing
        has = np.bitwise_or.reduceat(kinds[data], start)
        many = np.add.reduceat(counts[data], start)
        n = end - start
        shape = (
            (np.minimum(n, 24) // 4)  # 0..6
            + 8 * np.minimum(many >> 32, 3)  # marks
            + 32 * (has & 1 > 0)
            + 64 * np.minimum(many & 0xFFFFFFFF, 2)  # capitals: 0, 1, more
            + 192 * (has & 2 > 0)
        )
        shape = np.where(has & 4 > 0, 384 + np.minimum(n, 24) // 4, shape)
    return row, h, shape.astype(np.int64)


def words_of_their_own(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the words that have vectors of their own."""
    tables = shared.Tables(docs.sparkSession)

    def rows(batches):
        held, waiting = [], 0

        def told():
            k, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], ["h", "n"])

        for b in batches:
            for _, data, offs in textkit.slices(b.column(0)):
                start, end, _ = textkit.words(data, offs)
                held.append(textkit.Spans(data).hash(start, end))
                waiting += len(start)
            if waiting > 2 * FLUSH:
                yield told()
                held, waiting = [], 0
        if waiting:
            yield told()

    counts = tables.stored(docs.select(F.col("text").cast("string")).mapInArrow(rows, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") > 1))
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.filter((F.col("n") >= MIN_COUNT) & (F.col("n") * SHARE >= total)).select("h").toPandas()
    tables.drop()
    return np.sort(found["h"].to_numpy(np.int64).view(np.uint64))


def _slots(own: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The row of each word's vector: its own, after SLOTS that the other words share."""
    slot = (h >> np.uint64(50)).astype(np.int64) & (SLOTS - 1)
    if len(own):
        at = np.minimum(np.searchsorted(own, h), len(own) - 1)
        slot = np.where(own[at] == h, SLOTS + at, slot)
    return slot


def _index(h: np.ndarray, table: np.ndarray, slot: np.ndarray) -> None:
    """Add the index vectors of the neighbours' hashes to the slots' rows of ``table`` (flat)."""
    for j in range(NONZERO):
        dim = (h >> np.uint64(7 * j)).astype(np.int64) & (DIMS - 1)
        sign = 1.0 - 2.0 * ((h >> np.uint64(40 + j)).astype(np.int64) & 1)
        table += np.bincount(slot * DIMS + dim, weights=sign, minlength=len(table))


def _index_vectors(h: np.ndarray) -> np.ndarray:
    """The index vectors of the hashes, one a row."""
    out = np.zeros(len(h) * DIMS)
    _index(h, out, np.arange(len(h)))
    return out.reshape(-1, DIMS)


class Vectors:
    """Context vectors: ``own`` (sorted hashes), and rows for SHAPES shapes, SLOTS shared words and each own word."""

    def __init__(self, own: np.ndarray, table: np.ndarray):
        self.own, self.shapes, self.words = own, table[:SHAPES], table[SHAPES:]


def contexts(docs: DataFrame) -> Vectors:
    """The context vectors, summed over all documents."""
    spark = docs.sparkSession
    shared.small_batches(spark)
    own, tables = words_of_their_own(docs), shared.Tables(spark)
    size, step = SHAPES + SLOTS + len(own), 1 << 9

    def rows(batches):
        table, pairs = np.zeros(size * DIMS), np.zeros(SHAPES * SHAPES, np.int64)
        part, of_words = TaskContext.get().partitionId(), table[SHAPES * DIMS :]
        held, waiting = [], 0

        def settle():
            slot, near_word = (np.concatenate(c) for c in zip(*held, strict=True))
            _index(near_word, of_words, slot)

        for b in batches:
            for _, data, offs in textkit.slices(b.column(0)):
                row, h, shape = tokens(data, offs)
                slot = _slots(own, h)
                for reach in range(1, REACH + 1):
                    near = np.flatnonzero(row[reach:] == row[:-reach]) if len(h) > reach else np.empty(0, np.int64)
                    pairs += np.bincount(shape[near] * SHAPES + shape[near + reach], minlength=len(pairs))
                    for mine, other in ((near, near + reach), (near + reach, near)):
                        held.append((slot[mine], h[other]))
                        waiting += len(near)
                if waiting > FLUSH:
                    settle()
                    held, waiting = [], 0
        if held:
            settle()
        both = pairs.reshape(SHAPES, SHAPES)
        table[: SHAPES * DIMS] = ((both + both.T) @ _index_vectors(textkit.mix(np.arange(SHAPES, dtype=np.uint64) + np.uint64(977)))).ravel()
        whole = table.astype(np.int64).reshape(-1, DIMS)
        for i in range(0, size, step):
            some = np.flatnonzero(whole[i : i + step].any(axis=1))
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([part]), pa.array([some.astype(np.int16).tobytes()]), pa.array([whole[i : i + step][some].tobytes()])], ["block", "part", "at", "sums"])

    def add(key, batch):
        out = np.zeros((step, DIMS), np.int64)
        for at, sums in zip(batch.column("at").to_pylist(), batch.column("sums").to_pylist(), strict=True):
            out[np.frombuffer(at, np.int16)] += np.frombuffer(sums, np.int64).reshape(-1, DIMS)
        some = np.flatnonzero(out.any(axis=1))
        return pa.table({"block": [key[0].as_py()], "part": [key[1].as_py()], "at": [some.astype(np.int16).tobytes()], "sums": [out[some].tobytes()]})

    schema = "block long, part long, at binary, sums binary"
    found = tables.stored(docs.select(F.col("text").cast("string")).mapInArrow(rows, schema))
    parts = (found.agg(F.max("part")).first()[0] or 0) + 1
    while True:  # FAN sums of a block at a time
        parts = -(-parts // FAN)
        found = found.withColumn("part", F.pmod("part", F.lit(parts)).cast("long")).groupBy("block", "part").applyInArrow(add, schema)
        if parts == 1:
            break
        found = tables.stored(found)
    out = np.zeros((size, DIMS))
    got = found.toPandas()
    for block, at, sums in zip(got["block"], got["at"], got["sums"], strict=True):
        out[block + np.frombuffer(at, np.int16)] = np.frombuffer(sums, np.int64).reshape(-1, DIMS)
    tables.drop()
    norm = np.sqrt((out**2).sum(axis=1, keepdims=True))
    return Vectors(own, (out / np.maximum(norm, 1e-9)).astype(np.float32))


def pooled(column: pa.Array, vectors: Vectors) -> np.ndarray:
    """One row of WIDTH features for each text."""
    out = np.zeros((len(column), WIDTH))
    for at, data, offs in textkit.slices(column):
        n = len(offs) - 1
        row, h, shape = tokens(data, offs)
        part = out[at : at + n]
        words = np.bincount(row, minlength=n)
        full = words > 0
        first = (np.cumsum(words) - words)[full]
        if len(h):
            part[full, :DIMS] = np.add.reduceat(vectors.words[_slots(vectors.own, h)], first)
            part[full, DIMS : 2 * DIMS] = np.add.reduceat(vectors.shapes[shape], first)
            own = textkit.mix(row.astype(np.uint64) + np.uint64(1))
            _, one = np.unique(textkit.mix(h ^ own), return_index=True)
            part[:, 2 * DIMS] = words - np.bincount(row[one], minlength=n)
            w, begin = textkit.windows(h, row, 3)
            _, one = np.unique(textkit.mix(w ^ own[begin]), return_index=True)
            part[:, 2 * DIMS + 1] = np.bincount(row[begin], minlength=n) - np.bincount(row[begin[one]], minlength=n)
            part[:, 2 * DIMS + 2] = np.bincount(row, weights=(shape // 8) % 4, minlength=n)
        part[full] /= words[full, None]
        part[:, -1] = np.log1p(words)
    return out


class Network:
    """Two layers: tanh, then a logit divided by the temperature."""

    def __init__(self, constant: float = 0.5):
        self.constant, self.layers, self.heat = constant, None, 1.0
        self.mean, self.spread = np.zeros(WIDTH), np.ones(WIDTH)

    def logit(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.tanh(np.clip((x - self.mean) / self.spread, -8, 8) @ a + b) @ c + d

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.heat, -30, 30)))

    def train(self, x: np.ndarray, y: np.ndarray) -> None:
        rng = np.random.Generator(np.random.PCG64(SEED))
        order = rng.permutation(len(x))
        kept_out, use = order[: len(x) // 5], order[len(x) // 5 :]
        if len(set(y[use])) < 2 or not len(kept_out):
            return
        self.mean, self.spread = x[use].mean(axis=0), x[use].std(axis=0) + 1e-6
        self.layers = [rng.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(())]
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        slow, square, t = [0.0] * 4, [0.0] * 4, 0
        for _ in range(EPOCHS):
            mixed = rng.permutation(use)
            for i in range(0, len(mixed), 128):
                part = mixed[i : i + 128]
                a, b, c, d = self.layers
                hidden = np.tanh(z[part] @ a + b)
                error = (1 / (1 + np.exp(-np.clip(hidden @ c + d, -30, 30))) - y[part]) / len(part)
                back = np.outer(error, c) * (1 - hidden**2)
                slopes = [z[part].T @ back + DECAY * a, back.sum(axis=0), hidden.T @ error + DECAY * c, error.sum()]
                t += 1
                for j, g in enumerate(slopes):  # Adam
                    slow[j] = 0.9 * slow[j] + 0.1 * g
                    square[j] = 0.999 * square[j] + 0.001 * g * g
                    self.layers[j] = self.layers[j] - STEP * (slow[j] / (1 - 0.9**t)) / (np.sqrt(square[j] / (1 - 0.999**t)) + 1e-8)
        raw, truth = self.logit(x[kept_out]), y[kept_out]
        heats = np.geomspace(0.25, 8, 61)
        loss = [np.mean(np.logaddexp(0, -np.where(truth > 0, raw, -raw) / h)) for h in heats]
        self.heat = float(heats[int(np.argmin(loss))])


def learn(docs: DataFrame, labels: DataFrame) -> tuple[Vectors, Network]:
    """Vectors from all of ``docs``; the network from at most FIT_ROWS rows of ``labels`` (doc_id, label; one that is given again counts
    once) and of the documents that they mark, however often an id is repeated in either. Labels of no id mark nothing."""
    vectors = contexts(docs)
    marks = labels.filter("label IN (0, 1)").select("doc_id", F.col("label").cast("double").alias("label")).distinct()
    marks = shared.stored(marks, path := shared.scratch(docs.sparkSession))
    some = shared.drawn(marks, marks.count(), FIT_ROWS, "doc_id").toPandas()
    shared.discard(docs.sparkSession, path)
    if some["label"].nunique() < 2:
        return vectors, Network(float(some["label"].mean()) if len(some) else 0.5)
    known = docs.sparkSession.createDataFrame(some, "doc_id long, label double")  # FIT_ROWS rows at most

    def rows(batches):
        for b in batches:
            x = pooled(b.column(2), vectors)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "y", "x"])

    met = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")
    met = shared.drawn(met, met.count(), FIT_ROWS, "doc_id")
    got = met.mapInArrow(rows, "doc_id long, y double, x binary").toPandas().sort_values(["doc_id", "y"])
    network = Network(float(some["label"].mean()))
    if len(got):
        network.train(np.stack([np.frombuffer(r) for r in got["x"]]), got["y"].to_numpy())
    return vectors, network


def score(docs: DataFrame, vectors: Vectors, network: Network, *keep: str) -> DataFrame:
    """``keep`` columns and the probability of label 1 of every row."""
    shared.small_batches(docs.sparkSession)
    source = docs.select(*keep, F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def rows(batches):
        for b in batches:
            out = network.probability(pooled(b.column(b.num_columns - 1), vectors))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out)], [*b.schema.names[:-1], "score"])

    return source.mapInArrow(rows, f"{schema}, score double")


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs, labels = shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels")
    fold = shared.fold("doc_id", 3)
    vectors, network = learn(docs, labels.filter(fold != 1).select("doc_id", F.col("quality").alias("label")))
    scored = score(docs, vectors, network, "doc_id").withColumn("held_out", F.coalesce(fold == 1, F.lit(False)))
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


shared.by_value(__name__)
