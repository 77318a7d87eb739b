"""Validity reasons, scores, near duplicates, sampling, splits, leakage checks, set comparisons."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshquilt.functions import vec as V
from meshquilt.operators import geometry as G
from meshquilt.operators import topology as T
from meshquilt.sources.scratch import kept, parts_of, scratch, shuffled_joins

#: Keywords of the sofa selection.
SOFA_WORDS = ("sofa", "couch", "settee")
PREFERRED = ("two seat", "two-seat", "2 seat", "2-seat", "three seat", "three-seat", "3 seat", "3-seat", "loveseat", "multi-seat", "multiple seat")
EXCLUDED = (
    "l-shaped", "l shaped", "corner sofa", "sectional", "u-shaped", "u shaped", "chaise", "recliner", "reclining", "lazy sofa", "single seat", "single-seat",
    "one seat", "one-seat", "armchair", "footstool", "sofastool", "bed end stool", "sofa bed", "sofabed", "couch bed",
)
#: Models excluded after a visual review, with the reason.
VISUAL_EXCLUSIONS = (
    ("06cf411f-a021-4bf1-b417-26ca819591f7", "heavy_ornamental_design"),
    ("3db020fe-44a8-427d-840e-8ab9cb1ca01e", "near_duplicate_ornamental_sofa"),
    ("5f41adee-8f09-4431-b246-6cf93d78f4d8", "curved_sofa"),
    ("0893af5b-1c13-4996-b1ad-78329f5c2fd2", "chaise_like_asymmetry"),
    ("6ee12c70-d29e-408b-999e-19c015833ed6", "heavy_ornamental_design"),
    ("07be7bf4-c318-4055-9272-c47e5ab532bf", "near_duplicate_sofa"),
    ("2403c725-cec6-46ba-8d43-b7b87834a71a", "blanket_obscures_seat"),
    ("14132991-8e49-45ed-82d0-f48ba5903b8f", "curved_sofa"),
    ("40d2c9d3-d44e-46c9-bfcc-2a4555acf11d", "near_duplicate_ornamental_sofa"),
    ("431e3530-40b1-404a-bf3b-d6a2fee00a65", "curved_sofa"),
    ("3e6c45ba-9989-4e6f-bc3a-63285ae10d6d", "heavy_ornamental_design"),
    ("4c9ac6a1-2643-4484-952c-395892f5bee8", "heavy_ornamental_design"),
    ("cbfb77b6-92f7-4bb6-9160-eaa820606773", "curved_sofa"),
    ("0dbd0e22-0e25-439a-8472-fa3cd394c9ad", "missing_distinct_armrests"),
    ("251be3a1-e684-4e30-a6fe-2ec57cc75cbc", "corner_like_geometry"),
    ("76ed78f5-36a5-4bfa-b6d9-797182d70be7", "heavy_ornamental_design"),
    ("dd49b740-7632-4928-adf1-3fd853decb30", "daybed_like_wood_frame"),
    ("e53f180e-c706-4fba-a222-b2845c1ee8e5", "daybed_like_wood_frame"),
    ("7df23cf5-1e4d-4c6c-b680-84c80e92830d", "near_duplicate_sofa"),
)


# ---- reasons -------------------------------------------------------------------------------------------------


def model_facts(vertices: DataFrame, faces: DataFrame, models: DataFrame | None = None) -> DataFrame:
    """Aggregates that every validity rule reads, in one row per model."""
    bad = ~(V.finite(F.col("x")) & V.finite(F.col("y")) & V.finite(F.col("z")))
    v = vertices.groupBy("model_id").agg(F.count("*").alias("n_vertices"), F.count(F.when(bad, 1)).alias("n_non_finite"), F.max("vid").alias("max_vid"))
    f = faces.groupBy("model_id").agg(
        F.count("*").alias("n_faces"), F.min(F.least("i0", "i1", "i2")).alias("min_index"), F.max(F.greatest("i0", "i1", "i2")).alias("max_index"), F.count(F.when(T.repeated_index(), 1)).alias("n_repeated")
    )
    a = G.face_areas(faces, vertices).groupBy("model_id").agg(F.count(F.when(F.col("area") <= 0, 1)).alias("n_flat"), F.count(F.when(F.isnan("area"), 1)).alias("n_nan_area"))
    used = faces.select("model_id", F.explode(F.array("i0", "i1", "i2")).alias("vid")).distinct()
    loose = vertices.join(used, ["model_id", "vid"], "left_anti").groupBy("model_id").agg(F.count("*").alias("n_unreferenced"))
    out = v.join(f, "model_id", "full").join(a, "model_id", "left").join(loose, "model_id", "left")
    if models is not None:
        out = models.join(out, "model_id", "left")
    counts = [c for c in out.columns if c.startswith("n_")]
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def candidate_reason(min_vertices: int, min_faces: int, max_faces: int) -> Column:
    """The first rule that a candidate breaks (null: none), over ``model_facts``."""
    rules = [*_shape_rules(), ("below_minimum_complexity", _small(min_vertices, min_faces)), ("too_many_faces", F.col("n_faces") > max_faces)]
    return _chain(rules, "")


def post_cleanup_reason(min_vertices: int, min_faces: int) -> Column:
    """The same after cleanup: no upper limit, but repeated indices and flat faces; names end in _after_cleanup."""
    rules = [*_shape_rules(), ("repeated_indices_in_face", F.col("n_repeated") > 0), ("non_positive_triangle_area", F.col("n_flat") > 0), ("below_minimum_complexity", _small(min_vertices, min_faces))]
    return _chain(rules, "_after_cleanup")


def _shape_rules():
    return [
        ("empty_vertices_or_faces", (F.col("n_vertices") == 0) | (F.col("n_faces") == 0)),
        ("non_finite_vertices", F.col("n_non_finite") > 0),
        ("invalid_face_indices", (F.col("min_index") < 0) | (F.col("max_index") > F.col("max_vid"))),
    ]


def _small(min_vertices, min_faces):
    return (F.col("n_vertices") < min_vertices) | (F.col("n_faces") < min_faces)


def _chain(rules, suffix):
    out = F.lit(None).cast("string")
    for name, rule in reversed(rules):
        out = F.when(rule, F.lit(name + suffix)).otherwise(out)
    return out


def mesh_issues() -> Column:
    """All rules that a mesh breaks, over ``model_facts``. Without vertices or faces there is nothing more to ask."""
    nothing = F.array(F.lit("empty_vertices_or_faces"))
    rules = F.array_compact(
        F.array(
            F.when(F.col("n_non_finite") > 0, "non_finite_vertices"), F.when((F.col("min_index") < 0) | (F.col("max_index") > F.col("max_vid")), "invalid_face_indices"),
            F.when(F.col("n_repeated") > 0, "repeated_indices_in_face"), F.when(F.col("n_flat") > 0, "non_positive_triangle_area"),
            F.when(F.col("n_nan_area") > 0, "non_finite_area"), F.when(F.col("n_unreferenced") > 0, "unreferenced_vertices"),
        )
    )
    return F.when((F.col("n_vertices") == 0) | (F.col("n_faces") == 0), nothing).otherwise(rules)


def issue_text(issues: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(issues)), "|")


def known_corrupt(candidates: DataFrame, corrupt: DataFrame) -> DataFrame:
    """Candidates with reason known_corrupt_id where their id is listed."""
    listed = corrupt.select("file_id").distinct().withColumn("_bad", F.lit("known_corrupt_id"))
    return candidates.join(listed, "file_id", "left").withColumnRenamed("_bad", "reason")


def is_sofa(super_category: Column, text: Column) -> Column:
    """The super category decides where there is one; else a keyword, and not a stool."""
    named = F.nullif(F.trim(F.lower(super_category)), F.lit(""))
    word = F.exists(F.array(*map(F.lit, SOFA_WORDS)), lambda w: F.contains(F.lower(text), w))
    return F.when(named.isNotNull(), named == "sofa").otherwise(word & ~F.contains(F.lower(text), F.lit("sofastool")))


def any_word(text: Column, words) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower(text), w))


def size_gate(min_vertices: int = 128, min_faces: int = 128, max_components: int = 512) -> Column:
    return (F.col("n_vertices") >= min_vertices) & (F.col("n_faces") >= min_faces) & (F.col("n_components") <= max_components)


def candidate_score(text: Column, width_depth: Column, width_height: Column, n_faces: Column, n_components: Column) -> tuple[Column, Column]:
    """(score, issues): keywords, proportions, face count and components each add their points; what loses points is an issue."""
    plain, deep, tall = any_word(text, EXCLUDED), width_depth.between(1.45, 4.5), width_height.between(1.3, 5.5)
    score = (
        F.when(any_word(text, PREFERRED), 30.0).otherwise(0.0)
        + F.when(plain, -100.0).otherwise(0.0)
        + F.when(deep, 24.0 - 3.0 * F.abs(width_depth - 2.4)).otherwise(-35.0)
        + F.when(tall, 14.0).otherwise(-20.0)
        + F.when(n_faces.between(10_000, 50_000), 20.0).when(n_faces.between(2_000, 200_000), 8.0).otherwise(-12.0)
        + F.when(n_components <= 64, 8.0).otherwise(-F.least(F.lit(20.0), 0.1 * (n_components - 64)))
    )
    issues = F.array_compact(
        F.array(
            F.when(plain, "excluded_sofa_subtype_keyword"), F.when(~deep, "unusual_width_depth_ratio"), F.when(~tall, "unusual_width_height_ratio"),
            F.when(~n_faces.between(2_000, 200_000), "source_face_count_outside_preferred_range"), F.when(n_components > 64, "many_connected_components"),
        )
    )
    return score, issues


def not_excluded(candidates: DataFrame, id_column: str = "id") -> DataFrame:
    """Candidates without a visual exclusion and without an excluded keyword among their issues."""
    listed = candidates.sparkSession.createDataFrame([*VISUAL_EXCLUSIONS], f"{id_column} string, reason string").select(id_column)
    return candidates.filter(~F.array_contains("issues", "excluded_sofa_subtype_keyword")).join(listed, id_column, "left_anti")


# ---- keys, strata, seeds -------------------------------------------------------------------------------------


def stratum(n_faces: Column, strata) -> Column:
    """Inclusive ranges (name, low, high), the first that fits; else out_of_range."""
    out = F.lit("out_of_range")
    for name, low, high in reversed(list(strata)):
        out = F.when(n_faces.between(low, high), F.lit(name)).otherwise(out)
    return out


def group_key(thing: Column, file: Column) -> Column:
    """Files of one thing belong together; a thing that is not positive is none."""
    return F.when(thing > 0, F.concat(F.lit("thing:"), thing.cast("string"))).otherwise(F.concat(F.lit("file:"), file.cast("string")))


def seeded_order(seed: int, *ids: str) -> Column:
    """The engine's shuffle: order by md5 of seed and id, the same everywhere."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(i).cast("string") for i in ids)))


def mersenne_order(ids: list, seed: int) -> list:
    """Compatibility: the order that a Mersenne-Twister shuffle gives a short list of ids."""
    out = list(ids)
    random.Random(seed).shuffle(out)
    return out


def variant_seed(object_id: Column, base_seed: int, variant: Column) -> Column:
    """The first 8 bytes (little-endian) of sha256(id:seed:variant), modulo 2^63 - 1."""
    h = F.sha2(F.concat_ws(":", object_id.cast("string"), F.lit(str(base_seed)), variant.cast("string")), 256)
    swapped = F.concat(*(F.substring(h, 15 - 2 * k, 2) for k in range(8)))
    return (F.conv(swapped, 16, 10).cast("decimal(20,0)") % F.lit(2**63 - 1).cast("decimal(20,0)")).cast("bigint")


# ---- near duplicates and ranked selection ---------------------------------------------------------------------


#: Rows of one key at most that one task meets with the other side's; descriptors of so many values at most are compared as columns.
BLOCK_ROWS, MOST_COLUMNS = 1 << 12, 8


def near_duplicates(c: DataFrame, wd: float = 0.06, wh: float = 0.08, far: float = 0.035, faces: float = 1.15) -> DataFrame:
    """All pairs a < b with equal hash, or close proportions, descriptors and face counts. Pairs of the second kind meet on cells of both proportions (own and
    neighbouring), so it stays an equi-join; those of the first kind that are not close meet on their hash. So a pair comes once, and none is shuffled, unless ids
    repeat. Pairs grow with the square of a cell or hash, which are worked in blocks: a task holds a block's rows, not the pairs."""
    key = c.groupBy("id").agg(F.count("*").alias("n"), F.max(F.size("descriptor")).alias("long"))
    rows, most, long = key.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.max("long"), F.lit(0))).first()
    c = shuffled_joins(c)  # nine copies of every row are more than its file says
    parts = parts_of(c.sparkSession, 9 * rows)
    if long <= MOST_COLUMNS:  # plain columns: functions over arrays cost a multiple of all else that is asked of a pair
        d = [F.coalesce(F.get("descriptor", F.lit(i)), F.when(F.size("descriptor") <= i, 0.0)).alias(f"d{i}") for i in range(long)]
        c = c.select("id", "hash", "wd", "wh", "n_faces", F.size("descriptor").alias("size"), *d)
        total = F.lit(0.0)
        for i in range(long):
            total = total + (F.col(f"a_d{i}") - F.col(f"b_d{i}")) * (F.col(f"a_d{i}") - F.col(f"b_d{i}"))
        gap = F.when(F.col("a_size") == F.col("b_size"), F.sqrt(total))
    else:
        c = c.select("id", "hash", "wd", "wh", "n_faces", "descriptor")
        gap = F.sqrt(F.aggregate(F.zip_with("a_descriptor", "b_descriptor", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    # cells are wider than the threshold by more than a division rounds; what lies beyond 2^52 of them meets in the last one
    cell = lambda k, width: F.floor(F.greatest(F.least(F.col(k) / (width * (1 + 1e-9)), F.lit(2.0**52)), F.lit(-(2.0**52))))
    a, b = (c.select(*(F.col(k).alias(f"{side}_{k}") for k in c.columns)) for side in "ab")
    ratio = F.greatest("a_n_faces", "b_n_faces") / F.greatest(F.least("a_n_faces", "b_n_faces"), F.lit(1))
    close = (F.abs(F.col("a_wd") - F.col("b_wd")) <= wd) & (F.abs(F.col("a_wh") - F.col("b_wh")) <= wh) & (ratio < faces) & (gap < far)
    at = {"gx": cell("a_wd", wd), "gy": cell("a_wh", wh)}
    near = F.explode(F.array(*(F.struct((cell("b_wd", wd) + i).alias("gx"), (cell("b_wh", wh) + j).alias("gy")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    one = _met_in_blocks(a.withColumns(at), b.select("*", near.alias("s")).select(*b.columns, "s.*"), ["gx", "gy"], parts).filter((F.col("a_id") < F.col("b_id")) & close)
    two = _met_in_blocks(a.withColumn("hash", F.col("a_hash")), b.withColumn("hash", F.col("b_hash")), ["hash"], parts).filter((F.col("a_id") < F.col("b_id")) & ~F.coalesce(close, F.lit(False)))
    out = one.select("a_id", "b_id").unionByName(two.select("a_id", "b_id"))
    return out if most <= 1 else out.distinct()


def _met_in_blocks(a: DataFrame, b: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """``a`` joined with ``b`` on ``keys``. A key with many rows of ``a`` is dealt out in blocks of about ``BLOCK_ROWS`` of them, each of which meets all its rows of
    ``b``. These keys are written once, so that no later query of the pairs counts rows again; where there is none, it is a plain join."""
    spark = a.sparkSession
    many = kept(a.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks")).filter("blocks > 1"), scratch(spark))
    if many.limit(1).count():
        blocks = F.coalesce("blocks", F.lit(1).cast("bigint"))
        a = a.join(many, keys, "left").withColumn("block", F.pmod(F.xxhash64("a_id"), blocks)).drop("blocks")
        b = b.join(many, keys, "left").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))).drop("blocks")
        keys = [*keys, "block"]
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):  # else adaptive execution deals few rows out to few tasks
        a, b = (side.repartition(parts, *keys) for side in (a, b))
    return shuffled_joins(a).join(shuffled_joins(b), keys)


def ranked_selection(scored: DataFrame, pairs: DataFrame, k: int, exclude: DataFrame | None = None) -> DataFrame:
    """Greedy top k by (-score, id): a candidate is skipped if it is near a selected one; null scores come last. The rank
    order is walked in batches of the best rows left: each row of a batch is selected or near a selected one, so what is
    left for the next are the rows that are neither. Every batch selects its first row, so there are k at most, and only a
    batch and its pairs reach the driver. ``pairs`` is asked for the pairs of a batch, again for each. Rows of one ``hash``, where
    there is such a column, are near each other whatever ``pairs`` holds of them. Ids are unique."""
    mark = F.col("hash") if "hash" in scored.columns else F.lit(None).cast("string")
    base = (scored if exclude is None else scored.join(exclude, "id", "left_anti")).select("id", F.col("score").cast("double").alias("score"), mark.alias("hash"))
    close = pairs.select(F.col("a_id").alias("id"), F.col("b_id").alias("o")).unionByName(pairs.select(F.col("b_id").alias("id"), F.col("a_id").alias("o")))
    chosen: list = []
    hashes: set = set()
    left = base
    while len(chosen) < k:
        batch = left.orderBy(F.desc_nulls_last("score"), "id").limit(4 * k).collect()
        ids = [r["id"] for r in batch]
        near: dict = {}
        for i, o in close.filter(F.col("id").isin(ids) & F.col("o").isin(ids)).collect():
            near.setdefault(i, set()).add(o)
        taken: set = set()
        for i, s, h in batch:
            if len(chosen) < k and h not in hashes and not taken.intersection(near.get(i, ())):
                taken.add(i)
                hashes.update(() if h is None else (h,))
                chosen.append((i, s, len(chosen) + 1))
        if len(batch) < 4 * k:
            break
        done = [i for i, *_ in chosen]
        fresh = ~F.col("id").isin(done) & (F.col("hash").isNull() | ~F.col("hash").isin([*hashes]))
        left = base.filter(fresh).join(close.filter(F.col("id").isin(done)).select(F.col("o").alias("id")), "id", "left_anti")
    kind = base.schema["id"].dataType.simpleString()
    return scored.sparkSession.createDataFrame(chosen, f"id {kind}, score double, rank int")


# ---- sampling and splits --------------------------------------------------------------------------------------


def shortages(rows: DataFrame, quotas: DataFrame, key: str) -> DataFrame:
    """Groups with fewer rows than their quota: key, quota, available."""
    have = rows.groupBy(key).agg(F.count("*").alias("available"))
    return quotas.join(have, key, "left").withColumn("available", F.coalesce("available", F.lit(0))).filter("available < quota")


def stratified_sample(candidates: DataFrame, quotas: dict[str, int], seed: int) -> DataFrame:
    """Exact numbers per stratum in two passes: first files of things not used yet (in any stratum), then any, both in
    seeded order. The used things carry over between strata, so these are taken one after another; each takes its first
    rows of a distributed order, and no more than the quotas' sum reaches the driver. A shortage raises. Ids are unique."""
    rows = candidates.select("file_id", "thing_id", "stratum", seeded_order(seed, "file_id").alias("h"))
    out: list = []
    used: list = []
    for name, quota in quotas.items():
        here = rows.filter(F.col("stratum") == name)
        own = F.coalesce(F.col("thing_id") > 0, F.lit(False))
        new = here.filter(own & ~F.col("thing_id").isin(used)).groupBy("thing_id").agg(F.min(F.struct("h", "file_id")).alias("r"))
        spread = new.select("r.h", "r.file_id", "thing_id").unionByName(here.filter(~own).select("h", "file_id", "thing_id"))
        first = spread.orderBy("h", "file_id").limit(quota).collect()
        chosen = [r["file_id"] for r in first]
        used += [r["thing_id"] for r in first if (r["thing_id"] or 0) > 0]
        if len(chosen) < quota:
            rest = here.filter(~F.col("file_id").isin(chosen)).orderBy("h", "file_id").limit(quota - len(chosen)).collect()
            chosen += [r["file_id"] for r in rest]
        if len(chosen) != quota:
            raise ValueError(f"stratum {name}: {len(chosen)} of {quota}")
        out += [(f, name) for f in chosen]
    return candidates.sparkSession.createDataFrame(out, f"file_id {candidates.schema['file_id'].dataType.simpleString()}, stratum string")


def group_split(rows: DataFrame, sizes: dict[str, int], seed: int) -> DataFrame:
    """Validation and test take one file of each of the smallest groups (order: group size, then hash); training takes the
    rest. A group held out with more than one file leaves training short: ``check_split`` tells."""
    g = rows.withColumn("g", group_key(F.col("thing_id"), F.col("file_id")))
    groups = g.groupBy("g").agg(F.count("*").alias("n"), F.min(F.struct(seeded_order(seed, "file_id").alias("h"), "file_id")).alias("first"))
    few = groups.orderBy("n", "first.h", "first.file_id").limit(sizes["validation"] + sizes["test"])  # as many rows as are asked for
    held = few.withColumn("r", F.row_number().over(Window.orderBy("n", "first.h", "first.file_id")))
    out = held.select(F.col("first.file_id").alias("file_id"), F.when(F.col("r") <= sizes["validation"], "validation").otherwise("test").alias("split"))
    train = g.join(held, "g", "left_anti").select("file_id", F.lit("train").alias("split"))
    return out.unionByName(train)


def simple_split(ids: DataFrame, seed: int, id_column: str = "id", shares=(0.8, 0.1, 0.1), counts: tuple[int, int, int] | None = None) -> DataFrame:
    """Ids in hash order, cut into train, validation and test (half-even sizes, at least one each, or given counts)."""
    return balanced_split(ids.withColumn("_c", F.lit(0)), "_c", seed, id_column, shares, counts).drop("_c")


def balanced_split(rows: DataFrame, category: str, seed: int, id_column: str = "id", shares=(0.8, 0.1, 0.1), counts: tuple[int, int, int] | None = None) -> DataFrame:
    """The same in every category."""
    by = Window.partitionBy(category)
    r = F.row_number().over(by.orderBy(seeded_order(seed, category, id_column), id_column))
    n = F.count("*").over(by)
    val = F.lit(counts[1]) if counts else F.greatest(F.bround(n * shares[1]), F.lit(1))
    test = F.lit(counts[2]) if counts else F.greatest(F.bround(n * shares[2]), F.lit(1))
    placed = rows.withColumn("_r", r).withColumn("_v", val).withColumn("_t", test).withColumn("_n", n)
    split = F.when(F.col("_r") <= F.col("_n") - F.col("_v") - F.col("_t"), "train").when(F.col("_r") <= F.col("_n") - F.col("_t"), "validation").otherwise("test")
    return placed.withColumn("split", split).drop("_r", "_v", "_t", "_n")


def shuffled(rows: DataFrame, seed: int, id_column: str = "id") -> DataFrame:
    """``rows`` (with ``split``) and their ``position`` (from 1) in their split's seeded order. One global order by ranges serves all splits, however few they are."""
    from meshquilt.operators.ranking import ranked

    h = seeded_order(seed, "split", id_column)
    placed = ranked(rows.withColumn("_h", h), "split", "_h", id_column, name="_rank")
    first = placed.groupBy("split").agg(F.min("_rank").alias("_first"))
    return placed.join(first, "split").withColumn("position", F.col("_rank") - F.col("_first") + 1).drop("_h", "_rank", "_first")


def balanced_selection(candidates: DataFrame, per_category: int, seed: int, accepted: str = "reason IS NULL") -> tuple[DataFrame, DataFrame]:
    """Per category the first ``per_category`` accepted candidates in hash order; (selected, failures seen before the last)."""
    order = Window.partitionBy("category").orderBy(seeded_order(seed, "category", "id"), "id")
    placed = candidates.withColumn("pos", F.row_number().over(order)).withColumn("ok", F.expr(accepted))
    placed = placed.withColumn("nth", F.sum(F.col("ok").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    chosen = placed.filter(F.col("ok") & (F.col("nth") <= per_category))
    failed = placed.filter(~F.col("ok") & (F.col("nth") < per_category))
    return chosen, failed


def replacement(failed: DataFrame, candidates: DataFrame, selected: DataFrame) -> DataFrame:
    """For each failed model the first unused candidate of its stratum with a later scan index and a thing nobody uses."""
    free = candidates.join(selected.select("file_id"), "file_id", "left_anti")
    things = selected.filter("thing_id > 0").select("thing_id").distinct()
    free = free.join(things, "thing_id", "left_anti")
    from meshquilt.operators.ranking import next_after

    asked = failed.select("stratum", "scan_index", F.col("file_id").alias("failed_id"))
    met = next_after(asked, free, "stratum", "scan_index", "file_id").filter("next IS NOT NULL")
    return met.select("failed_id", F.col("next.file_id").alias("file_id"), F.col("next.scan_index").alias("scan_index"))


def replace_until_done(selected: DataFrame, candidates: DataFrame, works) -> DataFrame:
    """Replace failed models until all work or no replacement is left; what is returned works. ``works``: DataFrame ->
    file_ids that work. Every round tries candidates that no earlier one tried, so the loop ends."""
    from meshquilt.sources.scratch import scratch, stored

    spark = selected.sparkSession
    tried = selected
    while True:
        good = stored(works(selected).select("file_id").distinct(), scratch(spark))
        failed = selected.join(good, "file_id", "left_anti")
        if not failed.limit(1).count():
            return selected
        new = replacement(failed, candidates, tried)
        # one candidate may be the first choice of several: the first failed one takes it
        new = new.groupBy("file_id").agg(F.min("failed_id").alias("failed_id"))
        rows = stored(candidates.join(new.select("file_id"), "file_id", "left_semi").select(*selected.columns), scratch(spark))
        if not rows.limit(1).count():
            return selected.join(good, "file_id", "left_semi")
        selected = stored(selected.join(good, "file_id", "left_semi").unionByName(rows), scratch(spark))
        tried = tried.unionByName(rows)


def hash_split(key: Column, seed: int, validation: float, test: float) -> Column:
    """train, validation or test by a digest of seed and key: the shares are met about, without counting, and a row's split
    stays the same whatever other rows come. Shares count in ten thousandths."""
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 8), 16, 10).cast("long") % 10_000
    return F.when(place < round(validation * 10_000), "validation").when(place < round((validation + test) * 10_000), "test").otherwise("train")


def in_split_order(rows: DataFrame, order=("train", "validation", "test"), id_column: str = "id") -> DataFrame:
    return rows.orderBy(F.array_position(F.array(*map(F.lit, order)), F.col("split")), id_column)


def top_rows(rows: DataFrame, group: str, by: str, k: int, tie: str) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc(by), tie))).filter(F.col("rank") <= k)


def fibonacci_directions(spark, n: int = 16384) -> DataFrame:
    """i, x, y, z: a spiral of unit vectors on the upper half, canonical up to sign."""
    golden = 3.141592653589793 * (3 - 5**0.5)
    i = F.col("i")
    z = 1 - (i + 0.5) / n
    r = F.sqrt(1 - z * z)
    return spark.range(n).withColumnRenamed("id", "i").select("i", (r * F.cos(i * golden)).alias("x"), (r * F.sin(i * golden)).alias("y"), z.alias("z"))


def farthest_pairs(base: np.ndarray, pool: np.ndarray, pairs: int) -> np.ndarray:
    """Greedy: the direction of the pool with the smallest largest |cosine| to what is chosen; adds it and its antipode."""
    chosen = list(base)
    out = []
    for _ in range(pairs):
        worst = np.max(np.abs(pool @ np.array(chosen).T), axis=1)
        d = pool[int(np.argmin(worst))]
        out += [d, -d]
        chosen += [d, -d]
    return np.array(out)


# ---- leakage, sets --------------------------------------------------------------------------------------------


def leakage(rows: DataFrame) -> DataFrame:
    """Things that stand in more than one split, or more than once in validation or test."""
    t = rows.filter("thing_id > 0").groupBy("thing_id").agg(
        F.count_distinct("split").alias("n_splits"), F.count(F.when(F.col("split") == "validation", 1)).alias("n_val"), F.count(F.when(F.col("split") == "test", 1)).alias("n_test")
    )
    return t.filter("n_splits > 1 OR n_val > 1 OR n_test > 1")


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def overlap(rows: DataFrame, id_column: str = "id") -> DataFrame:
    """Ids in more than one split."""
    return rows.groupBy(id_column).agg(F.count_distinct("split").alias("n_splits")).filter("n_splits > 1")


def set_difference(a: DataFrame, b: DataFrame, id_column: str = "id") -> DataFrame:
    """Ids of one side only, with the side."""
    x, y = a.select(id_column).distinct(), b.select(id_column).distinct()
    return x.exceptAll(y).withColumn("side", F.lit("left")).unionByName(y.exceptAll(x).withColumn("side", F.lit("right")))


def tallies(rows: DataFrame, *keys: str) -> DataFrame:
    """Counts by key, and with several keys their cube."""
    return rows.cube(*keys).agg(F.count("*").alias("n")) if len(keys) > 1 else rows.groupBy(*keys).agg(F.count("*").alias("n"))
