"""Exact quantiles of a column of any size by distributed selection.

A histogram between the least and the largest value, by size in one round and by width in the next, tells in which bucket each wanted rank lies, and what each bucket holds (count,
least, largest); the rows of that bucket are looked at again, until a bucket has one value only, or few enough rows to be put in order. So what reaches the driver
is a histogram of ``BUCKETS`` rows a round or at most ``FEW`` rows, and no task orders more than that.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS, FEW = 4096, 20_000


def _spread(c):
    """A key in the order of the values that spaces them by size: zero is 0, the smallest double about 1, every power of e one more."""
    return F.when(c == 0, 0.0).otherwise(F.signum(c) * (F.log(F.abs(c)) + 746))


def _at(df: DataFrame, c, rank: int, low: float, high: float, n: int) -> float:
    """The value of a rank (from 0) among the n values between low and high. Rounds take turns: buckets of even size in powers of e, so that values of any
    spread part at once, then buckets of even width."""
    even = False
    while low < high and n > FEW:
        key, (a, b) = (c, (low, high)) if even else (_spread(c), df.agg(F.min(_spread(c)), F.max(_spread(c))).first())
        even = not even
        step = b / BUCKETS - a / BUCKETS
        if 0 < step < math.inf:
            bucket = F.greatest(F.lit(0), F.least(F.lit(BUCKETS - 1), F.floor((key - a) / step)))
        else:
            bucket = F.when(c > low, 1).otherwise(0)
        rows = df.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"), F.min(c).alias("low"), F.max(c).alias("high")).orderBy("b").collect()
        for r in rows:
            if rank < r["n"]:
                break
            rank -= r["n"]
        low, high, n = r["low"], r["high"], r["n"]
        df = df.filter(c.between(low, high))
    if low == high:
        return low
    return sorted(r[0] for r in df.select(c.alias("v")).collect())[rank]  # FEW rows at most


def quantiles(df: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    """The values at ranks share * (n - 1), between two ranks interpolated; null and NaN values do not count, without values all are None. ``df`` is read
    a few times: give one that is stored."""
    c = F.col(column).cast("double")
    own = df.filter(c.isNotNull() & ~F.isnan(c))
    n, low, high = own.agg(F.count("*"), F.min(c), F.max(c)).first()
    if not n:
        return [None] * len(shares)
    known: dict[int, float] = {0: low, n - 1: high}

    def at(rank):
        if rank not in known:
            known[rank] = _at(own, c, rank, low, high, n)
        return known[rank]

    out = []
    for share in shares:
        place = share * (n - 1)
        one = math.floor(place)
        a, part = at(one), place - one
        out.append(a if part == 0 else a + (at(one + 1) - a) * part)
    return out
