"""The retired flow: other status rules, display-name groups, tag rollup.

Differences from the live flow: products are grouped by country and display
name instead of engagement; the rules are the older list; the rollup is
keyed by language tag with Completed ranked above Inactive; engagements
without a status read "No Status Listed"; the goal report is built from the
dimension before goals are attached and has no status column; training
events drop one category.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tessera.functions import status as st
from tessera.functions.text import yes_no
from tessera.operators.joins import col, left_join_split, natural_join
from tessera.operators.rollup import best_by_priority
from tessera.operators.rules import first_match, with_group_values
from tessera.plans import live

Tables = Mapping[str, DataFrame]

# The training category the retired flow leaves out.
EXCLUDED_TRAINING_CATEGORY = "Networks PR"
TRAINING_CATEGORY_COL = "Category of Training"


def legacy_project_status(
    tables: Tables,
    dimension: DataFrame | None = None,
    keys: tuple[str, ...] = st.LEGACY_GROUP_KEYS,
    method: str = "aggregate",
) -> DataFrame:
    """Products with group size and the retired project-status rules."""
    if method == "aggregate":
        return live.status_products(
            tables, dimension, keys, st.legacy_group_values(), st.legacy_rules(), keep_flags=True
        )
    prep = live.prepared_products(tables, dimension, keep_flags=True)
    out_cols = [c for c in prep.columns if c not in live.BIBLE_FLAGS.values()]
    x = with_group_values(prep, keys, st.legacy_group_values(), method)
    status = first_match(st.legacy_rules())
    return x.select(*[col(c) for c in out_cols], col(st.COUNT_COL), status.alias(st.STATUS_COL))


def legacy_status_classes(tables: Tables, dimension: DataFrame | None = None) -> DataFrame:
    """Language tag and status of every class of products (see ``live.status_classes``)."""
    return live.status_classes(
        tables,
        dimension,
        st.LEGACY_GROUP_KEYS,
        st.legacy_group_values(),
        st.legacy_rules(),
        keep_flags=True,
        attach="subtag_new",
    )


def legacy_engagement_status(projects: DataFrame) -> DataFrame:
    """One status per language tag, retired priority order."""
    return best_by_priority(projects, "subtag_new", st.STATUS_COL, list(st.LEGACY_PRIORITY))


def legacy_engagement_master(dimension: DataFrame, rollup: DataFrame) -> DataFrame:
    x = natural_join(dimension, rollup, ["subtag_new"], "left")
    return x.withColumn(st.STATUS_COL, st.engagement_default_legacy(col(st.STATUS_COL)))


def legacy_goal_coverage(goals: DataFrame, engagements: DataFrame) -> DataFrame:
    """Every goal language with the engagements (before goal attributes) on it."""
    eng = engagements.select(
        col("iso_639_2").alias("__iso"), col("language_engagement_id").alias("__engagement")
    )
    x = left_join_split(goals, eng, {"languagecode": "__iso"})
    return x.select(
        "languagename",
        col("languagecode").alias("iso_639_2"),
        "country",
        "allaccessstatus",
        "allaccessgoal",
        st.aag_eligibility(col("allaccessstatus")).alias("aag_elligible"),
        yes_no(col("__engagement").isNotNull()).alias("has_uw_engagement"),
    )


def legacy_training_filter(training: DataFrame) -> DataFrame:
    """Drop one training category; rows with no category are dropped too."""
    return training.filter(col(TRAINING_CATEGORY_COL) != EXCLUDED_TRAINING_CATEGORY)


def run_legacy(tables: Tables, method: str = "aggregate") -> dict[str, DataFrame]:
    dim = live.engagement_dimension(tables)
    rollup = legacy_engagement_status(legacy_status_classes(tables, dim))
    return {
        "master_uw_translation_projects": legacy_project_status(tables, dim, method=method),
        "master_uw_language_engagements": legacy_engagement_master(dim, rollup),
        "pb_language_engagements": legacy_goal_coverage(
            tables["pb_language_data"], live.engagement_org_rep(tables)
        ),
    }
