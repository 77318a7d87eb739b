"""Three-vector helpers over Columns (no UDFs). A vector is a tuple of three Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = tuple[Column, Column, Column]


def vec(*names: str) -> Vec:
    return tuple(F.col(n) for n in names)


def sub(a: Vec, b: Vec) -> Vec:
    return tuple(x - y for x, y in zip(a, b, strict=True))


def add(a: Vec, b: Vec) -> Vec:
    return tuple(x + y for x, y in zip(a, b, strict=True))


def scale(a: Vec, s) -> Vec:
    return tuple(x * s for x in a)


def dot(a: Vec, b: Vec) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vec, b: Vec) -> Vec:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def norm(a: Vec) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Vec, eps: float = 0.0) -> Vec:
    n = norm(a)
    return tuple(F.when(n > eps, x / n).otherwise(F.lit(0.0)) for x in a)


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def f32(c: Column) -> Column:
    """The value after storage in single precision."""
    return c.cast("float").cast("double")


def unit_interval(c: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (c - low) / F.greatest(high - low, F.lit(1e-12))))


def luma(r: Column, g: Column, b: Column) -> Column:
    return 0.299 * r + 0.587 * g + 0.114 * b


def signed_area2(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Twice the signed pixel area; with y down a front face is negative."""
    return a[0] * b[1] - a[1] * b[0]
