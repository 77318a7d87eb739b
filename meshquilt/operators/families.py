"""Families of manifests: nested view sets, combination arms, roles and the artefacts that a prepared sample needs.

Every check returns rows (arm, sample_id, issue). A family's arms are compared by equi-joins on (sample_id, view_id), so a family of any size
is one full join for each pair of neighbouring arms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshquilt.operators.samples import VISIBILITY
from meshquilt.sources.scratch import shuffled_joins

#: Whether a manifest of ground-truth or of expanded queries may train, and its role.
ROLES = {False: (True, "gt_query_training"), True: (False, "expanded_raw_frozen_model_inference")}
OUT = ("arm", "sample_id", "issue")


def _issue(df: DataFrame, arm, issue) -> DataFrame:
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    return df.select(lit(arm).alias("arm"), "sample_id", lit(issue).alias("issue"))


def nested(views: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """``views``: arm, sample_id, split, view_id, and any columns that describe a view. ``sizes``: the arms, smallest first, and their view counts. Issues:
    ``unexpected_view_count`` and ``views_not_numbered`` of an arm's sample; against the next larger arm ``not_a_prefix`` (a view is not the larger arm's
    view of that number), ``only_in_smaller``, ``only_in_larger`` and ``split_differs``."""
    about = [c for c in views.columns if c not in ("arm", "sample_id", "split", "view_id")]
    want = F.lit(None).cast("int")
    for arm, n in sizes.items():
        want = F.when(F.col("arm") == arm, n).otherwise(want)
    facts = views.groupBy("arm", "sample_id").agg(F.count("*").alias("n"), F.size(F.collect_set("view_id")).alias("d"), F.min("view_id").alias("low"), F.max("view_id").alias("high"), (F.min("split") < F.max("split")).alias("s")).withColumn("want", want).filter("want IS NOT NULL")
    numbered = (F.col("low") == 0) & (F.col("high") == F.col("n") - 1) & (F.col("d") == F.col("n"))
    found = F.array_compact(F.array(F.when(F.col("n") != F.col("want"), "unexpected_view_count"), F.when(~numbered, "views_not_numbered"), F.when(F.col("s"), "several_splits")))
    out = facts.select("arm", "sample_id", F.explode(found).alias("issue"))
    arms = list(sizes)
    for small, large in zip(arms, arms[1:], strict=False):
        # a view's two sides meet in a group, not in a join of two scans: the same for all rows of it, on both sides
        row = F.struct(F.lit(1).alias("there"), *about)
        side = [f(F.when(F.col("arm") == arm, row)).alias(f"{f.__name__}_{arm}") for arm in (small, large) for f in (F.min, F.max)]
        met = views.filter(F.col("arm").isin(small, large) & (F.col("view_id") < sizes[small])).groupBy("sample_id", "view_id").agg(*side)
        low = F.col(f"min_{small}")
        same = low.eqNullSafe(F.col(f"max_{small}")) & low.eqNullSafe(F.col(f"min_{large}")) & low.eqNullSafe(F.col(f"max_{large}"))
        out = out.unionByName(_issue(met.filter(~same).select("sample_id").distinct(), small, "not_a_prefix"))
        one, two = (views.filter(F.col("arm") == arm).groupBy("sample_id").agg(F.min("split").alias(side)).withColumn(f"has_{side}", F.lit(True)) for arm, side in ((small, "p"), (large, "q")))
        sides = one.join(two, "sample_id", "full")
        name = F.when(F.col("has_q").isNull(), "only_in_smaller").when(F.col("has_p").isNull(), "only_in_larger").when(~F.col("p").eqNullSafe(F.col("q")), "split_differs")
        out = out.unionByName(_issue(sides.withColumn("issue", name).filter("issue IS NOT NULL"), small, F.col("issue")))
    return out.select(*OUT)


def combined(graph: DataFrame, observed: DataFrame, arm: DataFrame, fields: list[str], name: str) -> DataFrame:
    """A combination arm against the samples that it merges: the observation ``fields`` must be those of ``observed``, all other columns those of ``graph``, no
    visibility of the old views may be left, and ``metadata`` (a map of texts) must hold the graph's entries, then the views' entries, and name the
    arm. Issues: ``graph_field_changed:<column>``, ``observation_field_differs:<column>``, ``stale_visibility:<column>``, ``metadata_not_merged``,
    ``combination_arm_missing``, ``only_in_arm``, ``missing_in_arm``."""
    frozen = [c for c in graph.columns if c not in (*fields, *VISIBILITY, "sample_id", "metadata", "split")]
    # arrays of paths and maps: a file of ids may be small where these rows are not, so they are never broadcast
    graph, observed, arm = map(shuffled_joins, (graph, observed, arm))
    g = graph.select("sample_id", F.struct(F.lit(1).alias("there"), *frozen, F.col("metadata").alias("m")).alias("g"))
    o = observed.select("sample_id", F.struct(F.lit(1).alias("there"), *fields, F.col("metadata").alias("m")).alias("o"))
    met = arm.withColumn("_arm", F.lit(True)).join(g, "sample_id", "full").join(o, "sample_id", "left")
    both = F.col("_arm").isNotNull() & F.col("g").isNotNull()
    parts = [F.when(F.col("g").isNull(), "only_in_arm"), F.when(F.col("_arm").isNull(), "missing_in_arm")]
    parts += [F.when(both & ~F.col(c).eqNullSafe(F.col(f"g.{c}")), f"graph_field_changed:{c}") for c in frozen if c in arm.columns]
    parts += [F.when(both, f"graph_field_changed:{c}") for c in frozen if c not in arm.columns]
    parts += [F.when(both & ~F.col(c).eqNullSafe(F.col(f"o.{c}")), f"observation_field_differs:{c}") for c in fields]
    parts += [F.when(both & F.col(c).isNotNull(), f"stale_visibility:{c}") for c in arm.columns if c in VISIBILITY]
    plain = F.map_filter("metadata", lambda k, v: k != "combination_arm")
    none = F.create_map().cast("map<string,string>")
    views = F.coalesce("o.m", none)
    kept = F.map_filter(F.coalesce("g.m", none), lambda k, v: ~F.map_contains_key(views, k))
    same = lambda a, b: F.array_sort(F.map_entries(a)) == F.array_sort(F.map_entries(b))
    parts += [F.when(both & ~F.coalesce(same(plain, F.map_concat(kept, views)), F.lit(False)), "metadata_not_merged")]
    parts += [F.when(both & ~F.coalesce(F.element_at("metadata", F.lit("combination_arm")) == name, F.lit(False)), "combination_arm_missing")]
    return _issue(met.select("sample_id", F.explode(F.array_compact(F.array(*parts))).alias("issue")), name, F.col("issue")).select(*OUT)


def roles(manifests: DataFrame) -> DataFrame:
    """``manifests``: arm, expanded, training_eligible, dataset_role, one row each. Issues (sample_id null): ``training_eligibility_wrong``,
    ``dataset_role_wrong``."""
    pick = lambda i: F.when(F.col("expanded"), F.lit(ROLES[True][i])).otherwise(F.lit(ROLES[False][i]))
    found = F.array_compact(F.array(F.when(~F.col("training_eligible").eqNullSafe(pick(0)), "training_eligibility_wrong"), F.when(~F.col("dataset_role").eqNullSafe(pick(1)), "dataset_role_wrong")))
    return manifests.select("arm", F.lit(None).cast("bigint").alias("sample_id"), F.explode(found).alias("issue"))


def artefacts(samples: DataFrame, stored: DataFrame, views: int) -> DataFrame:
    """Prepared samples (arm, sample_id, n_vertices, n_paths, and the rows and columns of its visibility: v_rows, v_columns) with their artefacts (arm,
    sample_id, a_rows, a_columns). Issues: ``visibility_artefact_missing``, ``visibility_artefact_shape``, ``sample_visibility_shape``, ``unexpected_path_count``."""
    met = samples.join(stored.withColumn("_there", F.lit(True)), ["arm", "sample_id"], "left")
    fits = lambda r, c: F.coalesce((F.col(r) == views) & (F.col(c) == F.col("n_vertices")), F.lit(False))
    found = F.array_compact(
        F.array(
            F.when(F.col("_there").isNull(), "visibility_artefact_missing"), F.when(F.col("_there") & ~fits("a_rows", "a_columns"), "visibility_artefact_shape"),
            F.when(~fits("v_rows", "v_columns"), "sample_visibility_shape"), F.when(~F.col("n_paths").eqNullSafe(F.lit(views)), "unexpected_path_count"),
        )
    )
    return met.select("arm", "sample_id", F.explode(found).alias("issue"))
