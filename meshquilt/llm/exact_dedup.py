"""Exact deduplication (11): Grace hash partitioning into buckets that fit an open-addressing table of whole contents.

Level 0: every task merges the copies that it meets itself in a table of bounded size and writes one row per record;
the text stands only on the first row of each different text (a *head*). So a group of copies is shipped once a task at
most, however large it is. The written heads are the spill files: a hash of the text deals them into as many buckets as
make one about half of ``BYTES``, and a count by bucket (no text is read for it) tells which ones fit. A bucket that fits is
read by one task into an open-addressing table, where equal hashes compare complete contents. One that
does not is partitioned again with another hash, its heads dealt out by text and salt first so that copies from many
tasks merge, up to ``DEPTH`` times; there a bucket is read in the order of hashes and holds the texts of one hash only, so
every input ends. The answers go back down by head, never by text: no join has a key with more rows than one task's table.

Defined results: a null text counts as empty; the row with the largest id stays, null ids are below all others; where
that id is repeated in a group just one of its rows stays; repeated rows are copies of each other; texts are compared byte by byte,
whatever their hashes; an empty table gives no rows; very long texts are held one table at a time (``BYTES``, or one text where
that is longer). Other columns pass through ``deduplicated`` unchanged, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import shared

BYTES, ROWS = 32 << 20, 1 << 16  # of a bucket, and of a task's table
BUCKETS = 4096  # at least, so that tasks get even shares
MERGED = 4096  # heads of an overfull bucket that one task merges
DEPTH = 3


class OpenTable:
    """Different texts in slots found by linear probing, at most half of them full."""

    def __init__(self, slots: int = 1024):
        self.slots, self.hashes, self.texts, self.bytes = [-1] * slots, [], [], 0

    def _free(self, h: int) -> int:
        mask = len(self.slots) - 1
        at = h >> 40 & mask
        while self.slots[at] >= 0:
            at = at + 1 & mask
        return at

    def add(self, h: int, text: bytes) -> int:
        """The number of the text, a new one if no equal text is there."""
        mask = len(self.slots) - 1
        at = h >> 40 & mask
        while (e := self.slots[at]) >= 0:
            if self.hashes[e] == h and self.texts[e] == text:
                return e
            at = at + 1 & mask
        self.slots[at] = e = len(self.texts)
        self.hashes.append(h)
        self.texts.append(text)
        self.bytes += len(text) + 64
        if 2 * len(self.texts) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for i, known in enumerate(self.hashes):
                self.slots[self._free(known)] = i
        return e


def _below(a, b) -> bool:
    """a < b, null first."""
    return b is not None and (a is None or a < b)


def _merged(rows: DataFrame, most_bytes: int, most_rows: int) -> DataFrame:
    """row, rep, best, and on heads h, n, keep, sha, text: the rows (row, h, n, keep, sha, text) with the number of their text
    within the task's present table; ``best`` is the row of the largest ``keep``. A full table is written out and begun anew."""
    kind = pa.schema([("rep", pa.int64()), ("best", pa.bool_()), ("h", pa.int64()), ("n", pa.int64()), ("keep", pa.int64()), ("sha", pa.string()), ("text", pa.binary())])

    def merge(batches):
        base = TaskContext.get().partitionId() << 40

        def fresh():
            return OpenTable(), [], [], [], [], [], []

        table, held, numbers, counts, keeps, bests, shas = fresh()

        def told():
            n, first, seen = len(numbers), [False] * len(numbers), set()
            for i, e in enumerate(numbers):
                if e not in seen:
                    seen.add(e)
                    first[i] = True
            head = lambda values: [values[e] if f else None for e, f in zip(numbers, first, strict=True)]
            columns = [[base + e for e in numbers], [bests[e] == i for i, e in enumerate(numbers)], head(table.hashes), head(counts), head(keeps), head(shas), head(table.texts)]
            row = pa.concat_arrays(held)
            step = max(1, n * (4 << 20) // max(table.bytes, 4 << 20))
            for i in range(0, n, step):
                yield pa.RecordBatch.from_arrays([row[i : i + step], *(pa.array(c[i : i + step], t) for c, t in zip(columns, kind.types, strict=True))], ["row", *kind.names])

        for b in batches:
            start = 0
            h, n, keep, sha = (b.column(i).to_pylist() for i in range(1, 5))
            for i in range(b.num_rows):
                text = b.column(5)[i].as_py()
                e = table.add(h[i], text)
                if e == len(counts):
                    counts.append(0)
                    keeps.append(keep[i])
                    bests.append(len(numbers))
                    shas.append(sha[i] or hashlib.sha256(text).hexdigest())
                elif _below(keeps[e], keep[i]):
                    keeps[e], bests[e] = keep[i], len(numbers)
                counts[e] += n[i]
                numbers.append(e)
                if table.bytes > most_bytes or len(numbers) >= most_rows:
                    held.append(b.column(0).slice(start, i + 1 - start))
                    start = i + 1
                    yield from told()
                    base += len(counts)
                    table, held, numbers, counts, keeps, bests, shas = fresh()
            if start < b.num_rows:
                held.append(b.column(0).slice(start))
        if numbers:
            yield from told()

    out = StructType([rows.schema["row"], *StructType.fromDDL("rep long, best boolean, h long, n long, keep long, sha string, text binary")])
    return rows.select("row", "h", "n", "keep", "sha", "text").mapInArrow(merge, out)


def _settled(heads: DataFrame, sorted_by_hash: bool) -> DataFrame:
    """rep, keep_id, group_size, wins, sha of the heads (bucket, h, rep, n, keep, sha, text), one bucket a table."""
    kind = pa.schema([("rep", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("wins", pa.bool_()), ("sha", pa.string())])

    def settle(batches):
        table, groups, now = OpenTable(16), [], None
        out: list[list] = [[] for _ in kind]

        def close():
            for keep, best, size, sha, reps in groups:
                for values, new in zip(out, (reps, [keep] * len(reps), [size] * len(reps), [r == best for r in reps], [sha] * len(reps)), strict=True):
                    values.extend(new)

        def told():
            done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kind.types, strict=True)], schema=kind)
            for values in out:
                values.clear()
            return done

        for b in batches:
            bucket, h, rep, n, keep, sha = (b.column(i).to_pylist() for i in range(6))
            for i in range(b.num_rows):
                at = (bucket[i], h[i]) if sorted_by_hash else bucket[i]
                if at != now:
                    close()
                    table, groups, now = OpenTable(16), [], at
                    if len(out[0]) >= 4096:
                        yield told()
                e = table.add(h[i], b.column(6)[i].as_py())
                if e == len(groups):
                    groups.append([keep[i], rep[i], 0, sha[i], []])
                g = groups[e]
                if _below(g[0], keep[i]) or g[0] == keep[i] and rep[i] < g[1]:
                    g[:2] = keep[i], rep[i]
                g[2] += n[i]
                g[4].append(rep[i])
        close()
        if out[0]:
            yield told()

    columns = ("bucket", "h", "rep", "n", "keep", "sha", "text")
    dealt = heads.select(*columns).repartition("bucket").sortWithinPartitions("bucket", *(["h"] if sorted_by_hash else []))
    return dealt.mapInArrow(settle, "rep long, keep_id long, group_size long, wins boolean, sha string")


def groups(docs: DataFrame, row=None, bytes_: int = BYTES, rows_: int = ROWS, buckets_: int = BUCKETS, depth: int = DEPTH, hashed=None) -> DataFrame:
    """row (a Column of ``docs``, the id unless given), keep_id, group_size, kept, text_sha256, stored: one row for each row of
    ``docs`` (doc_id, text). ``hashed(text, level)`` makes the hash, a long; any one will do."""
    spark = docs.sparkSession
    hashed = hashed or (lambda text, level: F.xxhash64(text, F.lit(level)))
    tables, levels = shared.Tables(spark), []
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    plain = docs.select((docs["doc_id"] if row is None else row).alias("row"), F.lit(1).cast("long").alias("n"), docs["doc_id"].cast("long").alias("keep"), F.lit(None).cast("string").alias("sha"), text.alias("text"))
    with shared.batches(spark, shared.BATCH_ROWS):
        rows = plain.withColumn("h", hashed(F.col("text"), 0))
        for level in range(depth + 1):
            written = tables.stored(_merged(rows, bytes_, rows_).withColumn("size", F.length("text") + 64))
            total = written.agg(F.sum("size")).first()[0] or 0
            buckets = max(buckets_, -(-2 * total // bytes_))
            heads = written.filter("n IS NOT NULL").withColumn("bucket", F.pmod("h", F.lit(buckets)))
            fits, over = heads, None
            if level < depth:
                filled = heads.groupBy("bucket").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
                over = tables.stored(filled.filter((F.col("rows") > 1) & ((F.col("size") > bytes_) | (F.col("rows") > rows_))).select("bucket", F.ceil(F.col("rows") / MERGED).alias("parts")))
                over = None if over.isEmpty() else over
                fits = heads if over is None else heads.join(over.select("bucket"), "bucket", "left_anti")
            levels.append((written.select("row", "rep", "best"), tables.stored(_settled(fits, level == depth))))
            if over is None:
                break
            again = heads.join(over, "bucket").select(F.col("rep").alias("row"), "n", "keep", "sha", "text", "parts").withColumn("h", hashed(F.col("text"), level + 1))
            rows = again.repartition("h", F.pmod(F.xxhash64("row"), "parts"))
        known = None
        for written, own in reversed(levels):
            own = own if known is None else own.unionByName(known)
            met = written.join(own, "rep")
            known = met.select(F.col("row").alias("rep"), "keep_id", "group_size", (F.col("best") & F.col("wins")).alias("wins"), "sha")
        out = shared.stored(known.select(F.col("rep").alias("row"), "keep_id", "group_size", F.col("wins").alias("kept"), F.col("sha").alias("text_sha256")), shared.scratch(spark))
    tables.drop()
    return out


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each different text, all columns as they were."""
    whole = F.struct(*(docs[c] for c in docs.columns))
    return groups(docs, whole).filter("kept").select("row.*")


def op11_exact_dedup(spark, sf_dir: str) -> DataFrame:
    found = groups(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("row").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256 FROM d
"""

shared.by_value(__name__)
