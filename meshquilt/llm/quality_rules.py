"""Quality rules (3): a rule bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one failure bit for
each rule; ``stored_ledger`` writes it as a table. A policy is a versioned mask over the bits, so verdicts,
counts and ablations are bitwise work on that table and never read the texts again.

Lines and word windows are told apart by 64-bit hashes; those of equal hash are compared byte by byte, and a
text in which two differ is measured word by word, so counts are exact whatever the text.

Defined results: a null or empty text has no words, all its measurements are 0 and it fails
``short`` (so it is rejected); repeated rows give repeated rows; an empty table gives an empty ledger;
other columns of the input are neither read nor returned by ``ledger`` and are kept by ``keep``.
"""

from __future__ import annotations

import functools
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, textkit

SYMBOLS = "#*$%&|<>"
#: Rule names in bit order. A new rule takes the next bit; bits are never reused.
RULES = ("short", "repeats", "symbols", "dup_lines", "long_words", "tiny_words")
#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": ("short", "repeats"),
    "2024-1": ("short", "repeats", "symbols", "long_words"),
    "2024-2": ("short", "repeats", "symbols", "dup_lines", "long_words", "tiny_words"),
}
CURRENT = "2024-2"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: Every rule over the measurements, in SQL that Spark and DuckDB both read.
CONDITIONS = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "n_symbols > n_words",
    "dup_lines": "100 * n_dup_lines > 60 * n_lines",
    "long_words": "word_chars > 15 * n_words",
    "tiny_words": "word_chars < 2 * n_words",
}


def mask(policy: str) -> int:
    return sum(1 << RULES.index(r) for r in POLICIES[policy])


def _exactly(text: bytes) -> tuple[int, int]:
    """n_dup_lines and n_repeat_words of one text, without hashes of our own."""
    words = text.translate(bytes.maketrans(bytes(textkit.SPACES), b" " * len(textkit.SPACES))).split(b" ")
    words = [w for w in words if w]
    lines = [x for x in text.split(b"\n") if x.strip(bytes(textkit.SPACES))]
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    met = Counter(wins)
    return len(lines) - len(set(lines)), len({i + j for i, w in enumerate(wins) if met[w] > 1 for j in range(3)})


def measure(column: pa.Array) -> np.ndarray:
    """One row of MEASURES for each text."""
    out = np.zeros((len(column), len(MEASURES)), np.int64)
    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in SYMBOLS]] = True
    for row, data, offs in textkit.slices(column):
        n = len(offs) - 1
        part = out[row : row + n]
        start, end, at = textkit.words(data, offs)
        spans = textkit.Spans(data)
        part[:, 0] = np.bincount(at, minlength=n)
        point = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        part[:, 1] = np.bincount(at, weights=point[end] - point[start], minlength=n)
        hits = np.concatenate(([0], np.cumsum(symbol[data])))
        part[:, 2] = hits[offs[1:]] - hits[offs[:-1]]
        # lines: runs without \n that hold a word
        lstart, lend, lrow = textkit.runs(data != 10, offs)
        seen = np.concatenate(([0], np.cumsum(~textkit._tables()["space"][data])))
        full = seen[lend] > seen[lstart]
        lstart, lend, lrow = lstart[full], lend[full], lrow[full]
        part[:, 5] = np.bincount(lrow, minlength=n)
        before, again = _again(spans.hash(lstart, lend), lrow)
        part[:, 3] = np.bincount(lrow[again], minlength=n)
        wrong = lrow[again][~textkit.same(data, (lstart[before], lend[before]), (lstart[again], lend[again]))]
        h = spans.hash(start, end)
        w, first = textkit.windows(h, at, 3)
        if len(w):
            before, again = _again(w, at[first])
            before, again = first[before], first[again]
            covered = np.zeros(len(h), bool)
            for j in range(3):
                covered[before + j] = covered[again + j] = True
                wrong = np.concatenate((wrong, at[again][~textkit.same(data, (start[before + j], end[before + j]), (start[again + j], end[again + j]))]))
            part[:, 4] = np.bincount(at[covered], minlength=n)
        for i in np.unique(wrong):  # two of one hash that differ
            part[i, 3:5] = _exactly(data[offs[i] : offs[i + 1]].tobytes())
    return out


def _again(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(earlier, later): for every entry with an earlier equal one in its row, the nearest such and itself."""
    own = textkit.mix(key ^ textkit.mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(own, kind="stable")
    twice = np.flatnonzero(own[order[1:]] == own[order[:-1]])
    return order[twice], order[twice + 1]


def _measured(rows: DataFrame) -> DataFrame:
    """``rows`` (one column, then text) with the measurements and ``fail_bits`` in place of the text."""
    shared.small_batches(rows.sparkSession)
    own = rows.schema.fields[0]
    schema = f"{own.name} {own.dataType.simpleString()}, " + ", ".join(f"{m} long" for m in MEASURES)

    def book(batches):
        for b in batches:
            values = measure(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(values[:, j]) for j in range(len(MEASURES)))], [own.name, *MEASURES])

    bits = " + ".join(f"CASE WHEN {CONDITIONS[r]} THEN {1 << j}L ELSE 0L END" for j, r in enumerate(RULES))
    return rows.mapInArrow(book, schema).withColumn("fail_bits", F.expr(bits))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``fail_bits`` of every document."""
    return _measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))


def stored_ledger(docs: DataFrame) -> DataFrame:
    """The ledger as a table in the shared folder: policies and ablations read that, not the texts."""
    return shared.stored(ledger(docs), shared.scratch(docs.sparkSession))


def verdict(book: DataFrame, policy: str = CURRENT, column: str = "kept") -> DataFrame:
    """The ledger with a boolean: no rule of the policy failed."""
    return book.withColumn(column, F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0)


def ablation(book: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of the policy: documents that fail it, that fail it alone (and come back if it is
    dropped), and that the policy rejects. The ledger shrinks to one row per bit pattern first."""
    held = F.col("fail_bits").bitwiseAND(F.lit(mask(policy)))
    patterns = book.groupBy(held.alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES.index(r)).cast("long").alias("bit")) for r in POLICIES[policy]))
    return (
        patterns.select("bits", "n", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_alone"),
            F.sum(F.when(F.col("bits") != 0, F.col("n")).otherwise(0)).alias("n_rejected"),
        )
    )


def keep(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that the policy keeps, every column as it was: each row travels beside its ledger entry, so
    there is no shuffle and no join, and repeated and null ids are safe."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("d"), F.col("text").cast("string").alias("text"))
    return verdict(_measured(rows), policy).filter("kept").select("d.*")


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    book = verdict(verdict(ledger(shared.table(spark, sf_dir, "documents"))), "base", "base_kept")
    return book.select("doc_id", *MEASURES[:5], (~F.col("base_kept")).alias("base_failed"), "kept", "fail_bits")


def quality_rules_ablation(spark, sf_dir: str) -> DataFrame:
    """The ablation of every policy, from one stored ledger."""
    book = stored_ledger(shared.table(spark, sf_dir, "documents"))
    out = [ablation(book, p).withColumn("policy", F.lit(p)) for p in POLICIES]
    return functools.reduce(DataFrame.unionByName, out)


_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
tri AS (SELECT r, i, {'a': ws[i], 'b': ws[i + 1], 'c': ws[i + 2]} AS g
        FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM tri) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY r),
ln AS (SELECT r, count(*) AS lines, count(DISTINCT l) AS differing
       FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum([length(x) for x in ws]), 0) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(lines - differing, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lines, 0) AS BIGINT) AS n_lines
      FROM w LEFT JOIN cov USING (r) LEFT JOIN ln USING (r)),
f AS (SELECT *, CAST(@BITS@ AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (fail_bits & @BASE@) <> 0 AS base_failed, (fail_bits & @MASK@) = 0 AS kept, fail_bits FROM f
"""
_BITS = " + ".join(f"CASE WHEN {CONDITIONS[r]} THEN {1 << j} ELSE 0 END" for j, r in enumerate(RULES))
SQL = _SQL.replace("@BITS@", _BITS).replace("@BASE@", str(mask("base"))).replace("@MASK@", str(mask(CURRENT)))
_PAIRS = ", ".join(f"('{p}', {mask(p)}, '{r}', {1 << RULES.index(r)})" for p in POLICIES for r in POLICIES[p])
ABLATION_SQL = (
    _SQL[: _SQL.rindex("SELECT doc_id")].replace("@BITS@", _BITS)
    + f""", p(policy, mask, rule, bit) AS (VALUES {_PAIRS})
SELECT policy, rule, CAST(count(*) FILTER (fail_bits & bit <> 0) AS BIGINT) AS n_failed, CAST(count(*) FILTER (fail_bits & mask = bit) AS BIGINT) AS n_alone,
  CAST(count(*) FILTER (fail_bits & mask <> 0) AS BIGINT) AS n_rejected FROM f, p GROUP BY policy, rule"""
)

shared.by_value(__name__)
