"""Toxicity (1): class-conditional Kneser-Ney models.

The unit is the *expression*: a word's longest stem (its first bytes, or the whole word) that one class uses
significantly more often than the other, toxic or (whole words) ordinary; every other word is the one expression "other".
Rare expressions are not units of their own: their counts back off to a shorter stem, and in the end to
"other". Over this alphabet each class has an interpolated Kneser-Ney bigram model, with bigrams after every
unit, "other" and the start of a text included. Its lower order counts the different words that an expression
follows, and is itself smoothed with the contexts counted over both classes, so that what a class has not seen is
scored by what the classes share. A document's score is a logistic function, fitted on labelled rows kept out of
the counts, of the difference of its two log-likelihoods, each divided by its length.

All counts run over all labelled rows. Every expression that passes the tests and every bigram is kept. A toxic
expression (stem or word) needs ``MIN_DOCS`` documents; an ordinary one is a whole word, and needs as many ordinary
documents as pass against no toxic one. The model (8 bytes an expression and 32 more for its two classes, 24 a bigram) is held in memory and shipped with the
tasks.

Defined results: a text without words has the likelihoods of no words (difference of one "other"), so it
is not toxic; with no labels, or one class, every score is the share of toxic labels (0 if none); labels
that are null teach nothing; rows without an id teach nothing, are scored like others, and are in no fold; a
document labelled twice takes part twice; repeated rows give repeated rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, textkit

STEMS = (4, 5, 6, 7, 8, 9, 10, 12)
WANTED_BITS = 1 << 25
MIN_DOCS, MIN_RATIO, MIN_Z = 4, 3.0, 2.5
DISCOUNT = 0.75
FIT_ROWS = 20_000
LOG_BITS = 20
FLUSH = 1 << 20


def expressions(data: np.ndarray, offs: np.ndarray):
    """(row of each word, hashes of its stems from short to long and of the whole word; 0 where too short)."""
    b = textkit.lowered(data)
    letter = ((b >= 97) & (b <= 122)) | (b >= 0x80) | (b == 39)
    start, end, row = textkit.runs(letter, offs)
    spans = textkit.Spans(b)
    out = np.zeros((len(STEMS) + 1, len(start)), np.uint64)
    size = end - start
    for j, k in enumerate(STEMS):
        long = size > k
        out[j, long] = spans.hash(start[long], start[long] + k)
    out[-1] = textkit.mix(spans.hash(start, end) + np.uint64(1))
    return row, out


def _per_doc(row: np.ndarray, hashes: np.ndarray):
    """The different non-zero hashes of each row."""
    flat, at = hashes.ravel(), np.broadcast_to(row, hashes.shape).ravel()
    use = flat != 0
    flat, at = flat[use], at[use]
    _, one = np.unique(textkit.mix(flat ^ textkit.mix(at.astype(np.uint64) + np.uint64(1))), return_index=True)
    return flat[one]


def _doc_counts(docs: DataFrame, wanted: np.ndarray | None) -> DataFrame:
    """hash, n, w: how many of the documents use each expression. With a bitmap ``wanted``: each whole word, and of the stems
    those that it lets pass; w: whether it does."""

    def rows(batches):
        keys, counts, held = [], [], 0

        def settle():
            k, c = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(k, kind="stable")
            k, c = k[order], c[order]
            first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.empty(0, np.int64)
            keys[:], counts[:] = [k[first]], [np.add.reduceat(c, first) if len(first) else c]

        def told():
            settle()
            for i in range(0, len(keys[0]), 1 << 16):
                k = keys[0][i : i + (1 << 16)].view(np.int64)
                w = np.ones(len(k), bool) if wanted is None else shared.passes(wanted, k)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(counts[0][i : i + (1 << 16)]), pa.array(w)], ["hash", "n", "w"])
            keys.clear()
            counts.clear()

        for b in batches:
            for _, data, offs in textkit.slices(b.column(0)):
                row, h = expressions(data, offs)
                if wanted is not None:
                    h[:-1] = np.where(shared.passes(wanted, h[:-1].ravel().view(np.int64)).reshape(h[:-1].shape), h[:-1], 0)
                keys.append(_per_doc(row, h))
                counts.append(np.ones(len(keys[-1]), np.int64))
                held += len(keys[-1])
                if held > 2 * FLUSH:
                    settle()
                    held = 0
                    if len(keys[0]) > 2 * FLUSH:
                        yield from told()
        if keys:
            yield from told()

    counts = docs.select("text").mapInArrow(rows, "hash long, n long, w boolean")
    return counts.groupBy("hash").agg(F.sum("n").alias("n"), F.max("w").alias("w"))


def _find(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Index in the sorted ``table``, -1 for hashes that are not there."""
    out = np.full(h.shape, -1, np.int64)
    if not len(table):
        return out
    near = np.zeros(1 << LOG_BITS, bool)
    near[(table >> np.uint64(64 - LOG_BITS)).astype(np.int64)] = True
    maybe = near[(h >> np.uint64(64 - LOG_BITS)).astype(np.int64)]
    some = h[maybe]
    at = np.minimum(np.searchsorted(table, some), len(table) - 1)
    out[maybe] = np.where(table[at] == some, at, -1)
    return out


class Model:
    """units: sorted expression hashes (unit j is j + 1, "other" 0; as a left context, the start of a text comes after the
    last unit). Log-likelihood differences by look-up."""

    def __init__(self, units=None):
        self.units = np.empty(0, np.uint64) if units is None else units
        size = len(self.units) + 1
        self.lower = np.full((2, size), 1.0 / size)  # P(w) by class
        self.pairs = np.empty(0, np.int64)  # sorted keys left * (V + 1) + right
        self.seen = np.zeros((2, 0))  # max(c - D, 0) / c(left) by class
        self.free = np.ones((2, size + 1))  # mass left to the lower order
        self.slope, self.shift, self.constant = 0.0, 0.0, 0.0

    def sequence(self, data, offs):
        """Row, unit, left unit, and left word's hash (0 at a start) of every word."""
        row, h = expressions(data, offs)
        unit = np.zeros(len(row), np.int64)
        for stem in h:  # the longest listed stem wins
            at = _find(self.units, stem)
            unit = np.where(at >= 0, at + 1, unit)
        left, word = np.full(len(row), len(self.units) + 1), np.zeros(len(row), np.uint64)
        if len(row):
            same = row[1:] == row[:-1]
            left[1:][same], word[1:][same] = unit[:-1][same], h[-1][:-1][same]
        return row, unit, left, word

    def probability(self, c: int, left: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """P(unit | left) in class ``c``."""
        p = self.free[c][left] * self.lower[c][unit]
        if len(self.pairs):
            key = left * (len(self.units) + 1) + unit
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            p = p + np.where(self.pairs[at] == key, self.seen[c][at], 0)
        return p

    def difference(self, data, offs) -> np.ndarray:
        """Per row: (log P(text | toxic) - log P(text | ordinary)) / number of words."""
        n = len(offs) - 1
        row, unit, left, _ = self.sequence(data, offs)
        log = [np.log(np.maximum(self.probability(c, left, unit), 1e-300)) for c in (0, 1)]
        words = np.bincount(row, minlength=n)
        none = math.log(max(self.lower[1][0], 1e-300)) - math.log(max(self.lower[0][0], 1e-300))
        return np.where(words > 0, np.bincount(row, weights=log[1] - log[0], minlength=n) / np.maximum(words, 1), none)

    def score(self, data, offs) -> np.ndarray:
        if not self.slope:
            return np.full(len(offs) - 1, self.constant)
        z = self.slope * (self.difference(data, offs) - self.shift)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _moves(docs: DataFrame, model: Model) -> DataFrame:
    """kind 0: unit r after unit l, n0 and n1 times in the two classes. kind 1: unit r after the word of hash l (0: at a
    start), so often."""
    names = ["kind", "r", "l", "n0", "n1"]

    def rows(batches):
        held: list = []
        waiting = 0

        def counted(keys, cls):  # keys: columns of equal length
            order = np.lexsort(keys)
            keys, cls = [k[order] for k in keys], cls[order]
            new = np.zeros(len(cls), bool)
            new[:1] = True
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            first = np.flatnonzero(new)
            return [k[first] for k in keys], [np.add.reduceat((cls == c).astype(np.int64), first) for c in (0, 1)]

        def settle():
            unit, left, word, cls = (np.concatenate(c) for c in zip(*held, strict=True))
            for kind, other in ((0, left), (1, word.view(np.int64))):
                (r, k), (n0, n1) = counted([unit, other], cls)
                for i in range(0, len(r), 1 << 16):
                    j = slice(i, i + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r[j]), kind, np.int32)), *(pa.array(c[j]) for c in (r, k, n0, n1))], names)

        for b in batches:
            label = b.column(0).to_numpy(zero_copy_only=False)
            for at, data, offs in textkit.slices(b.column(1)):
                row, unit, left, word = model.sequence(data, offs)
                if len(unit):
                    held.append((unit, left, word, label[at + row]))
                    waiting += len(unit)
                if waiting > FLUSH:
                    yield from settle()
                    held, waiting = [], 0
        if held:
            yield from settle()

    counts = docs.select(F.col("label").cast("long"), "text").mapInArrow(rows, "kind int, r long, l long, n0 long, n1 long")
    return counts.groupBy("kind", "r", "l").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _columns(df: DataFrame) -> dict[str, np.ndarray]:
    pdf = df.toPandas()
    return {c: pdf[c].to_numpy(np.int64) for c in pdf.columns}


def learn(labelled: DataFrame) -> Model:
    """Fit on ``labelled`` (doc_id, text, label 0/1, part): part 0 gives the logistic fit, the rest the counts."""
    spark = labelled.sparkSession
    shared.small_batches(spark)
    path = shared.scratch(spark)
    rows = shared.stored(labelled.select("doc_id", F.col("text").cast("string").alias("text"), F.col("label").cast("int").alias("label"), F.col("part").cast("int").alias("part")).filter("label IN (0, 1)"), path)
    sizes = {(r["label"], r["fit"]): r["n"] for r in rows.groupBy("label", (F.col("part") == 0).alias("fit")).agg(F.count("*").alias("n")).collect()}
    toxic, plain = sizes.get((1, False), 0), sizes.get((0, False), 0)
    model = Model()
    if not toxic or not plain:
        every = sum(sizes.values())
        model.constant = (sum(n for (c, _), n in sizes.items() if c) / every) if every else 0.0
        shared.discard(spark, path)
        return model
    counted = rows.filter("part <> 0")
    used = shared.Tables(spark)
    model = Model(units=_alphabet(counted, toxic, plain, used))
    used.drop()
    if len(model.units):
        _kneser_ney(counted, model)
    apart = sizes.get((1, True), 0) and sizes.get((0, True), 0)
    _fit(rows.filter("part = 0") if apart else rows, sum(n for (_, fit), n in sizes.items() if fit or not apart), model)
    shared.discard(spark, path)
    return model


def _z(t, o, toxic: int, plain: int, log, sqrt):
    """How many deviations the logarithm of the ratio of the classes' shares lies from 0."""
    t, o = t + 0.5, o + 0.5
    return (log(t / (toxic + 1)) - log(o / (plain + 1))) / sqrt(1 / t + 1 / o), sqrt(1 / t + 1 / o)


def _alphabet(counted: DataFrame, toxic: int, plain: int, tables: shared.Tables) -> np.ndarray:
    """Sorted hashes of the expressions that either class uses MIN_RATIO times as often, by MIN_Z deviations."""
    passes = lambda t, o: -_z(t, o, toxic, plain, math.log, math.sqrt)[0] - math.log(MIN_RATIO) / _z(t, o, toxic, plain, math.log, math.sqrt)[1] >= MIN_Z
    low, high = MIN_DOCS, plain + 1  # the least ordinary documents with which an expression passes against no toxic one
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if passes(0, middle) else (middle + 1, high)
    own = tables.stored(_doc_counts(counted.filter("label = 1"), None).select("hash", "n"))
    found = own.filter(F.col("n") >= MIN_DOCS)
    wanted = shared.bloom(found, "hash", WANTED_BITS, lambda h: h)
    back = tables.stored(_doc_counts(counted.filter("label = 0"), wanted).withColumnRenamed("n", "m").filter((F.col("m") >= low) | F.col("w")))
    z, spread = _z(F.coalesce("n", F.lit(0)), F.coalesce("m", F.lit(0)), toxic, plain, F.log, F.sqrt)
    margin = F.lit(math.log(MIN_RATIO)) / spread
    more = found.join(back, "hash", "left").filter(z - margin >= MIN_Z).select("hash")
    less = back.filter((F.col("m") >= low) & (F.col("m") >= MIN_DOCS)).join(own, "hash", "left").filter(-z - margin >= MIN_Z).select("hash")
    return np.sort(_columns(more.unionByName(less).distinct())["hash"].view(np.uint64))


def _kneser_ney(counted: DataFrame, model: Model) -> None:
    tables, size = shared.Tables(counted.sparkSession), len(model.units) + 1
    moves = tables.stored(_moves(counted, model))
    ends = _columns(moves.filter("kind = 1").groupBy("r").agg(F.count(F.when(F.col("n0") > 0, 1)).alias("t0"), F.count(F.when(F.col("n1") > 0, 1)).alias("t1"), F.count("*").alias("t")))
    types, both = np.zeros((2, size)), np.zeros(size)  # different contexts, by class and over both
    types[0][ends["r"]], types[1][ends["r"]], both[ends["r"]] = ends["t0"], ends["t1"], ends["t"]
    share = (both + 0.5) / (both + 0.5).sum()
    lower = np.zeros((2, size))
    for c in (0, 1):
        total = max(types[c].sum(), 1)
        lower[c] = np.maximum(types[c] - DISCOUNT, 0) / total + DISCOUNT * np.count_nonzero(types[c]) / total * share
    lower /= lower.sum(axis=1, keepdims=True)
    met = _columns(moves.filter("kind = 0").select((F.col("l") * size + F.col("r")).alias("key"), "n0", "n1"))
    order = np.argsort(met["key"])
    key = met["key"][order]
    left = key // size
    seen, free = np.zeros((2, len(key))), np.ones((2, size + 1))
    for c in (0, 1):
        n = met[f"n{c}"][order].astype(float)
        total = np.bincount(left, weights=n, minlength=size + 1)
        kinds = np.bincount(left[n > 0], minlength=size + 1)
        seen[c] = np.maximum(n - DISCOUNT, 0) / np.maximum(total[left], 1)
        free[c] = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
    model.lower, model.pairs, model.seen, model.free = lower, key, seen, free
    tables.drop()


def _fit(rows: DataFrame, total: int, model: Model) -> None:
    """Slope and shift of the logistic, on at most FIT_ROWS of the ``total`` rows, drawn by a hash of the id and the row's place."""
    some = shared.drawn(rows, total, FIT_ROWS, "doc_id").select(F.col("label").cast("double"), "text")

    def measured(batches):
        for b in batches:
            out = np.zeros(b.num_rows)
            for at, data, offs in textkit.slices(b.column(1)):
                out[at : at + len(offs) - 1] = model.difference(data, offs)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], ["y", "x"])

    pdf = some.mapInArrow(measured, "y double, x double").toPandas().sort_values(["x", "y"])
    x, y = pdf["x"].to_numpy(), pdf["y"].to_numpy()
    # the cut with the fewest errors, midway between two values; ties: the lowest
    cuts = np.unique(x)
    cuts = np.concatenate((cuts[:1] - 1e-3, (cuts[1:] + cuts[:-1]) / 2, cuts[-1:] + 1e-3))
    below = np.searchsorted(x, cuts)
    ones = np.concatenate(([0], np.cumsum(y)))
    errors = ones[below] + (len(y) - below) - (ones[-1] - ones[below])
    model.shift = float(cuts[np.argmin(errors)])
    spread = max(float(np.std(x)), 1e-6)
    loss = []
    grid = np.geomspace(0.5, 50, 24) / spread
    for s in grid:
        z = np.clip(s * (x - model.shift), -30, 30)
        loss.append(np.mean(np.log1p(np.exp(-np.where(y > 0, z, -z)))))
    model.slope = float(grid[int(np.argmin(loss))])


def score(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep`` columns and the score of every row."""
    shared.small_batches(docs.sparkSession)
    source = docs.select(*keep, F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def rows(batches):
        for b in batches:
            out = np.zeros(b.num_rows)
            for at, data, offs in textkit.slices(b.column(b.num_columns - 1)):
                out[at : at + len(offs) - 1] = model.score(data, offs)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out)], [*b.schema.names[:-1], "score"])

    return source.mapInArrow(rows, f"{schema}, score double")


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows scored under ``limit``, all columns as they were."""
    shared.small_batches(docs.sparkSession)
    place = [c.lower() for c in docs.columns].index("text")

    def rows(batches):
        for b in batches:
            out = np.zeros(b.num_rows)
            for at, data, offs in textkit.slices(b.column(place).cast(pa.string())):
                out[at : at + len(offs) - 1] = model.score(data, offs)
            yield b.filter(pa.array(out < limit))
        shared.trim()

    return docs.mapInArrow(rows, docs.schema)


def labelled(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, text, label, part of the labelled rows outside fold 0; part 0 is the last fold. A label that
    is given again counts once. Texts without a
    label are dropped before the join by a bitmap of fixed size over the labelled ids; the join itself is
    always a shuffle, since the labels may be as many as the documents."""
    shared.small_batches(docs.sparkSession)
    fold = shared.fold("doc_id", folds)
    marks = labels.select("doc_id", F.col("toxic").alias("label")).filter("label IS NOT NULL AND doc_id IS NOT NULL").filter(fold != 0).distinct()
    wanted = shared.bloom(marks, "doc_id", 1 << 25)

    def rows(batches):
        for b in batches:
            some = b.filter(pa.array(shared.passes(wanted, b.column(2).to_numpy(zero_copy_only=False))))
            yield pa.RecordBatch.from_arrays(some.columns[:2], ["doc_id", "text"])

    source = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("doc_id"))
    some = source.mapInArrow(rows, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text string")
    return some.join(marks.hint("merge"), "doc_id").withColumn("part", folds - 1 - fold)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels")
    model = learn(labelled(docs, labels))
    scored = score(docs, model, "doc_id").withColumn("held_out", F.coalesce(shared.fold("doc_id", 5) == 0, F.lit(False)))
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


shared.by_value(__name__)
