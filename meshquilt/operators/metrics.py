"""Inequality, ranks, statistics bundles and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def gini(values: DataFrame, column: str, keys=("model_id",), all_zero: float | None = None) -> DataFrame:
    """2 sum(r x) / (n sum x) - (n + 1) / n over non-negative finite values; ``all_zero`` (or NaN) where the sum is 0."""
    ok = values.filter(F.col(column).isNotNull() & (F.col(column) >= 0) & (F.col(column) < float("inf")))
    r = F.row_number().over(Window.partitionBy(*keys).orderBy(column))
    n, s = F.count("*"), F.sum(column)
    out = ok.withColumn("_r", r).groupBy(*keys).agg((F.when(s > 0, 2 * F.sum(F.col("_r") * F.col(column)) / (n * s) - (n + 1) / n).otherwise(F.lit(float("nan") if all_zero is None else all_zero))).alias("gini"))
    return out


def top_share(values: DataFrame, column: str, shares=(0.01, 0.10, 0.20), keys=("model_id",)) -> DataFrame:
    """The part of the sum that the largest ceil(q n) values (at least one) hold, for each q."""
    by = Window.partitionBy(*keys)
    r = values.withColumn("_r", F.row_number().over(by.orderBy(F.desc(column)))).withColumn("_n", F.count("*").over(by))
    name = lambda q: f"top_{round(q * 100):02d}_share"
    return r.groupBy(*keys).agg(*((F.sum(F.when(F.col("_r") <= F.greatest(F.ceil(F.lit(q) * F.col("_n")), F.lit(1)), F.col(column)).otherwise(0)) / F.sum(column)).alias(name(q)) for q in shares))


def effective_count(values: DataFrame, column: str, keys=("model_id",)) -> DataFrame:
    """(sum a)^2 / sum a^2, and that over the number of values."""
    e = F.sum(column) * F.sum(column) / F.sum(F.col(column) * F.col(column))
    return values.groupBy(*keys).agg(e.alias("effective_count"), (e / F.count("*")).alias("effective_fraction"))


def average_ranks(values: DataFrame, column: str, out: str, keys=("model_id",)) -> DataFrame:
    """Ranks from 1; ties share the mean of their ranks."""
    r = F.row_number().over(Window.partitionBy(*keys).orderBy(column))
    return values.withColumn("_r", r).withColumn(out, F.avg("_r").over(Window.partitionBy(*keys, column))).drop("_r")


def spearman(values: DataFrame, a: str, b: str, keys=("model_id",)) -> DataFrame:
    """Correlation of average ranks; NaN under three values or where one side is constant."""
    ranked = average_ranks(average_ranks(values, a, "_a", keys), b, "_b", keys)
    fine = (F.count("*") >= 3) & (F.min("_a") < F.max("_a")) & (F.min("_b") < F.max("_b"))
    return ranked.groupBy(*keys).agg(F.when(fine, F.covar_pop("_a", "_b") / F.nullif(F.stddev_pop("_a") * F.stddev_pop("_b"), F.lit(0.0))).otherwise(F.lit(float("nan"))).alias("spearman"))


def stats(values: DataFrame, column: str, keys=("model_id",)) -> DataFrame:
    """count, mean, median, p95, max, rms; percentiles exact and interpolated."""
    return values.groupBy(*keys).agg(
        F.count(column).alias("n"), F.avg(column).alias("mean"), F.expr(f"percentile({column}, 0.5)").alias("median"),
        F.expr(f"percentile({column}, 0.95)").alias("p95"), F.max(column).alias("max"), F.sqrt(F.avg(F.col(column) * F.col(column))).alias("rms"),
    )


def area_summary(represented: DataFrame, keys=("model_id",)) -> DataFrame:
    """One row per mesh: total, mean, coefficient of variation, percentiles, maximum over median, shares over two and four
    times the mean, zero count."""
    by = Window.partitionBy(*keys)
    v = represented.withColumn("_m", F.avg("area").over(by))
    p = lambda q: F.expr(f"percentile(area, {q})")
    return v.groupBy(*keys).agg(
        F.count("*").alias("n_vertices"), F.sum("area").alias("total_area"), F.avg("area").alias("mean_area"), (F.stddev_pop("area") / F.avg("area")).alias("cv"), p(0.9).alias("p90"), p(0.95).alias("p95"), p(0.99).alias("p99"),
        (F.max("area") / p(0.5)).alias("max_over_median"), F.avg((F.col("area") > 2 * F.col("_m")).cast("double")).alias("over_2_mean"), F.avg((F.col("area") > 4 * F.col("_m")).cast("double")).alias("over_4_mean"),
        F.count(F.when(F.col("area") == 0, 1)).alias("n_zero"),
    )


def area_percentile(represented: DataFrame, keys=("model_id",)) -> DataFrame:
    """100 rank / (n - 1), stable by id; a single vertex has 100."""
    by = Window.partitionBy(*keys)
    r, n = F.row_number().over(by.orderBy("area", "vid")) - 1, F.count("*").over(by)
    return represented.withColumn("area_percentile", F.when(n == 1, F.lit(100.0)).otherwise(100.0 * r / (n - 1)))


def vertex_metrics(represented: DataFrame, scale: DataFrame, variation: DataFrame) -> DataFrame:
    """The per-vertex frame: areas over mean and median, sampling density, percentile, edge scale, normal variation."""
    mid = represented.groupBy("model_id").agg(F.avg("area").alias("mean"), F.expr("percentile(area, 0.5)").alias("median"))
    out = area_percentile(represented).join(mid, "model_id").join(scale, ["model_id", "vid"]).join(variation, ["model_id", "vid"])
    return out.select(
        "model_id", F.col("vid").alias("vertex_index"), F.col("area").alias("represented_area"), (F.col("area") / F.col("mean")).alias("area_over_mean"), (F.col("area") / F.col("median")).alias("area_over_median"),
        F.when(F.col("area") > 0, F.col("mean") / F.col("area")).alias("sampling_density_relative"), "area_percentile", F.col("h").alias("mean_edge_length_h"), F.col("h2").alias("h_squared"), "degree",
        F.col("n_faces").alias("incident_face_count"), "normal_variation",
    )


def flat_and_detailed(frame: DataFrame, keys=("model_id",)) -> DataFrame:
    """Median area of the flattest and of the most detailed fifth (by normal variation), and their ratio."""
    cut = frame.groupBy(*keys).agg(F.expr("percentile(normal_variation, 0.2)").alias("lo"), F.expr("percentile(normal_variation, 0.8)").alias("hi"))
    both = frame.join(cut, list(keys))
    flat = F.expr("percentile(CASE WHEN normal_variation <= lo THEN represented_area END, 0.5)")
    detail = F.expr("percentile(CASE WHEN normal_variation >= hi THEN represented_area END, 0.5)")
    return both.groupBy(*keys).agg(flat.alias("flat20_median"), detail.alias("detailed20_median"), (flat / detail).alias("flat_over_detailed"))


def evenly_spaced(rows: DataFrame, order: str, k: int, keys=("model_id",)) -> DataFrame:
    """The rows at floor(j (n - 1) / (k - 1)) for j < k (all, if there are at most k)."""
    by = Window.partitionBy(*keys)
    placed = rows.withColumn("_p", F.row_number().over(by.orderBy(order)) - 1).withColumn("_n", F.count("*").over(by))
    # position p is drawn if some j has floor(j (n - 1) / (k - 1)) = p: the first j with j (n - 1) >= p (k - 1)
    j = F.ceil(F.col("_p") * (k - 1) / (F.col("_n") - 1))
    hit = F.floor(j * (F.col("_n") - 1) / (k - 1)) == F.col("_p")
    return placed.filter((F.col("_n") <= k) | hit).drop("_p", "_n")


def first_seen(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key, with its rank among the keys in order of first sight."""
    from meshquilt.operators.ranking import ranked

    first = rows.groupBy(key).agg(F.min(order).alias("pos"))
    return ranked(first, "pos").withColumn("rank", F.col("rank").cast("int"))


def area_conserved(areas: DataFrame, reference: str, tolerance: float = 1e-10) -> DataFrame:
    """model_id, variant, total, relative error against the reference variant, ok. ``areas``: model_id, variant, area."""
    total = areas.groupBy("model_id", "variant").agg(F.sum("area").alias("total"))
    base = total.filter(F.col("variant") == reference).select("model_id", F.col("total").alias("base"))
    err = F.abs(F.col("total") - F.col("base")) / F.greatest(F.abs(F.col("base")), F.lit(1e-300))
    return total.join(base, "model_id").select("model_id", "variant", "total", err.alias("relative_error"), (err <= tolerance).alias("ok"))


def role_report(summary: DataFrame, value: str, role: str = "role", k: int = 10) -> tuple[DataFrame, DataFrame]:
    """(median of ``value`` by role, the k worst rows of each role)."""
    medians = summary.groupBy(role).agg(F.expr(f"percentile({value}, 0.5)").alias("median"), F.count("*").alias("n"))
    r = F.row_number().over(Window.partitionBy(role).orderBy(F.desc(value), "model_id"))
    return medians, summary.withColumn("rank", r).filter(F.col("rank") <= k)
