"""Language ID (2): language-bitmask n-gram filters.

Learning counts the 4-byte grams of blank-padded, lower-cased words for every language. All grams go into one
bit-sliced Bloom filter: a row of the table is a mask with two bits for each language, one for grams that
the language has at all, one for grams that are *its own*: whose share in the language is at least ``MIN_RATIO`` of
their share in the language that uses them most (a passage quoted from another language makes its grams members, but
not the language's own). The AND of a gram's ``HASHES`` rows names, in one look-up, all languages that hold it, and
which of them own it. A text's popcounts, two for each language, are corrected for the false-positive rates of
their bits; the largest share of own grams decides, and the share of members where those are equal.

The table has ``SPREAD`` rows for each gram of the language with the most, up to 2**``MOST_ROWS`` rows (128 MB for up to
32 languages); beyond that its false-positive rates grow, which the correction takes out.

Defined results: a null text, or one without a letter, is ``und`` with score 0; with nothing learned
every text is ``und``; ties go to the language with more learned grams in running text, then by name;
null languages teach nothing; a row without an id is not held out and teaches; repeated rows give repeated rows; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, textkit

UND = "und"
#: A gram is a language's own if its share there is this part of its largest share in any.
MIN_RATIO = 0.25
HASHES, SPREAD, LEAST_ROWS, MOST_ROWS = 3, 8, 16, 24
CHUNK = 1 << 23


def grams(data: np.ndarray, offs: np.ndarray):
    """(gram, row): the 4-byte windows of each word with a blank before and after (3 bytes for one-byte words)."""
    b = textkit.lowered(data)
    if len(b):
        latin = np.zeros(len(b), bool)
        latin[1:] = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97)
        b = b + np.where(latin, 32, 0).astype(np.uint8)
    letter = ((b >= 97) & (b <= 122)) | (b >= 0x80)
    start, end, row = textkit.runs(letter, offs)
    if not len(start):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    size = end - start + 2
    stop = np.cumsum(size)
    text = np.full(int(stop[-1]) + 3, 32, np.uint8)
    inner = np.ones(len(text), bool)
    inner[stop - size] = False
    inner[stop - 1] = False
    inner[-3:] = False
    text[inner] = b[letter]
    wide = text.astype(np.uint32)
    value = wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16
    word = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(word)) - np.repeat(stop - size, size)
    left = size[word] - place
    value = value | np.where(left >= 4, wide[3:] << 24, 0).astype(np.uint32)
    use = (left >= 4) | ((left == 3) & (place == 0))
    return value[use], row[word[use]]


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all learning rows (lang not null); every task sums its own grams first."""
    shared.small_batches(docs.sparkSession)

    def rows(batches):
        waiting: dict[str, list] = {}
        held: dict[str, int] = {}

        def settle(lang):
            parts = waiting[lang]
            keys = np.concatenate([k for k, _ in parts])
            counts = np.concatenate([c if c is not None else np.ones(len(k), np.int64) for k, c in parts])
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            waiting[lang] = [(keys[first], np.add.reduceat(counts, first))]
            held[lang] = 0

        for b in batches:
            names = np.array(b.column(0).to_pylist(), object)
            for at, data, offs in textkit.slices(b.column(1)):
                g, row = grams(data, offs)
                own = names[at : at + len(offs) - 1]
                for lang in set(own):
                    part = g[(own == lang)[row]]
                    if len(part):
                        waiting.setdefault(lang, []).append((part, None))
                        held[lang] = held.get(lang, 0) + len(part)
                        if held[lang] > CHUNK:
                            settle(lang)
        for lang in sorted(waiting):
            settle(lang)
            keys, counts = waiting[lang][0]
            for i in range(0, len(keys), 1 << 16):
                k = keys[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k)), pa.array(k.astype(np.int64)), pa.array(counts[i : i + (1 << 16)])], ["lang", "gram", "n"])

    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string"), F.col("text").cast("string"))
    return known.mapInArrow(rows, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def places(grams_: np.ndarray, log_rows: int):
    """The table's rows of each gram, one array for each hash."""
    h = textkit.mix(grams_.astype(np.uint64) + np.uint64(0x51ED27))
    for j in range(HASHES):
        yield (h >> np.uint64(20 * j)).astype(np.int64) & ((1 << log_rows) - 1)


class Filter:
    """The bit-sliced Bloom filter: ``look`` gives the masks of grams, ``decide`` judges a text's popcounts. Bits 2 j and
    2 j + 1 of a row: language j has, and owns, a gram there. ``table``: (words of 64 bits, rows)."""

    def __init__(self, langs: list[str], table: np.ndarray, prior: np.ndarray):
        self.langs, self.table, self.prior = langs, table, prior
        self.log_rows = max(table.shape[1], 1).bit_length() - 1
        fill = [np.count_nonzero(table[k // 64] >> np.uint64(k % 64) & np.uint64(1)) / table.shape[1] for k in range(2 * len(langs))]
        self.false = (np.array(fill) ** HASHES).reshape(-1, 2)

    @classmethod
    def of(cls, langs: list[str], members: dict[str, np.ndarray], own: dict[str, np.ndarray], prior: np.ndarray) -> Filter:
        """From lists of grams held in memory."""
        log_rows = rows_for(max((len(m) for m in members.values()), default=0))
        table = np.zeros((max(1, -(-2 * len(langs) // 64)), 1 << log_rows), np.uint64)
        for j, lang in enumerate(langs):
            for k, listed in ((2 * j, members[lang]), (2 * j + 1, own[lang])):
                for at in places(np.asarray(listed), log_rows):
                    table[k // 64, at] |= np.uint64(1 << (k % 64))
        return cls(langs, table, prior)

    def look(self, grams_: np.ndarray) -> np.ndarray:
        """(words, grams): the masks of all languages that hold each gram."""
        masks = None
        for at in places(grams_, self.log_rows):
            masks = self.table[:, at] if masks is None else masks & self.table[:, at]
        return masks

    def counts(self, grams_: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(grams of each row, popcounts by row, language, and whether held or owned)."""
        total = np.bincount(row, minlength=n)
        out = np.zeros((n, 2 * len(self.langs)))
        first = np.concatenate(([0], np.cumsum(total)[:-1]))
        full = total > 0
        if len(grams_):
            masks = self.look(grams_)
            for k in range(2 * len(self.langs)):
                out[full, k] = np.add.reduceat((masks[k // 64] >> np.uint64(k % 64) & np.uint64(1)).astype(np.int32), first[full])
        return total, out.reshape(n, -1, 2)

    def decide(self, total: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = np.maximum(total, 1)[:, None, None]
        share = np.clip((hits - n * self.false) / (n * (1 - np.minimum(self.false, 0.999))), 0, 1)
        held, own = share[:, :, 0], share[:, :, 1]
        best = np.argmax(own + 1e-4 * held + 1e-9 * self.prior, axis=1)
        top = own[np.arange(len(own)), best]
        return best, np.clip(top * top / np.maximum(own.sum(axis=1), 1e-9), 0, 1)


def rows_for(n: int) -> int:
    """log2 of the table's rows for n grams in the largest language."""
    return min(MOST_ROWS, max(LEAST_ROWS, (SPREAD * max(n, 1) - 1).bit_length()))


def learn(docs: DataFrame) -> Filter:
    """The filter from the rows of ``docs`` (text, lang). Grams stay in Spark; what reaches the driver is the table, its rows
    ORed together there."""
    spark = docs.sparkSession
    tables = shared.Tables(spark)
    counts = tables.stored(gram_counts(docs))
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).orderBy("lang").collect()
    if not sizes:
        tables.drop()
        return Filter([], np.zeros((1, 1), np.uint64), np.empty(0))
    langs, log_rows = [r["lang"] for r in sizes], rows_for(max(r["kinds"] for r in sizes))
    by = spark.createDataFrame([(r["lang"], r["total"], j) for j, r in enumerate(sizes)], "lang string, total long, j int")
    shares = F.struct((F.col("n") / F.col("total")).alias("share"), "j")
    grams_ = counts.join(by, "lang").groupBy("gram").agg(F.collect_list(shares).alias("s"))  # a language each: as many as languages
    marked = grams_.select("gram", F.array_max(F.transform("s", lambda s: s["share"])).alias("top"), F.explode("s").alias("s"))
    mask = F.expr(f"shiftleft(CASE WHEN s.share >= top * {MIN_RATIO} THEN 3L ELSE 1L END, s.j * 2 % 64)")
    masks = marked.groupBy("gram", F.floor(F.col("s.j") / 32).cast("int").alias("word")).agg(F.bit_or(mask).alias("mask"))

    def rows(batches):
        for b in batches:
            gram, word, own = b.column(0).to_numpy(), b.column(1), b.column(2)
            for at in places(gram, log_rows):
                yield pa.RecordBatch.from_arrays([pa.array(at), word, own], ["at", "word", "mask"])

    placed = masks.mapInArrow(rows, "at long, word int, mask long").groupBy("at", "word").agg(F.bit_or("mask").alias("mask")).toPandas()
    table = np.zeros((-(-2 * len(langs) // 64), 1 << log_rows), np.uint64)
    table[placed["word"].to_numpy(), placed["at"].to_numpy(np.int64)] = placed["mask"].to_numpy(np.int64).view(np.uint64)
    tables.drop()
    total = np.array([r["total"] for r in sizes], float)
    return Filter(langs, table, total / total.sum())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def identify(docs: DataFrame, model: Filter, *keep: str) -> DataFrame:
    """``keep`` columns, lang_pred and score of every row."""
    shared.small_batches(docs.sparkSession)
    source = docs.select(*keep, F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def rows(batches):
        for b in batches:
            texts = b.column(b.num_columns - 1)
            pred, score = np.full(b.num_rows, UND, object), np.zeros(b.num_rows)
            for at, data, offs in textkit.slices(texts):
                n = len(offs) - 1
                g, row = grams(data, offs)
                if not model.langs:
                    continue
                total, hits = model.counts(g, row, n)
                best, sure = model.decide(total, hits)
                plain = np.concatenate(([0], np.cumsum(((data | 32) >= 97) & ((data | 32) <= 122))))
                some = plain[offs[1:]] > plain[offs[:-1]]
                for i in np.flatnonzero(~some & (offs[1:] > offs[:-1])):  # no A-Z or a-z: look at the code points
                    some[i] = has_letter(bytes(data[offs[i] : offs[i + 1]]).decode("utf-8", "replace"))
                pred[at : at + n][some] = np.array(model.langs, object)[best[some]]
                score[at : at + n][some] = sure[some]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(pred, pa.string()), pa.array(score)], [*b.schema.names[:-1], "lang_pred", "score"])

    return source.mapInArrow(rows, f"{schema}, lang_pred string, score double")


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    held = F.coalesce(shared.fold("doc_id", 4) == 2, F.lit(False))
    model = learn(docs.filter(~held).select("text", "lang"))
    return identify(docs.withColumn("held_out", held), model, "doc_id", "held_out")


shared.by_value(__name__)
