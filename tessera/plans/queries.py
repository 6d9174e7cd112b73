"""Registered queries: one per inventory item group, over the fixture views.

Each builder takes a mapping of table name to DataFrame and returns a lazy
DataFrame. ``build(spark, sf_dir, name)`` wires a builder to the test tables
of one scale factor.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import legacy, live, retired
from tessera.plans.job import Staging
from tessera.session import ensure_checkpoint_dir
from tessera.sources.fixtures import fixture_frames
from tessera.sources.sinks import ParquetSink

Tables = Mapping[str, DataFrame]


def _project_status(t: Tables) -> DataFrame:
    return live.project_status(t)


def _engagement_master(t: Tables) -> DataFrame:
    dim = live.engagement_dimension(t)
    return live.engagement_master(dim, live.engagement_status(live.status_classes(t, dim)))


def _goal_coverage(t: Tables) -> DataFrame:
    return live.goal_coverage(t["pb_language_data"], _engagement_master(t), live.engagement_org_rep(t))


def _legacy_engagement_master(t: Tables) -> DataFrame:
    dim = live.engagement_dimension(t)
    rollup = legacy.legacy_engagement_status(legacy.legacy_status_classes(t, dim))
    return legacy.legacy_engagement_master(dim, rollup)


def _written(name: str, build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """An output as it reads back from the sink it was written to."""

    def query(t: Tables) -> DataFrame:
        df = build(t)
        spark = df.sparkSession
        if not ensure_checkpoint_dir(spark) and re.match(r"local(\[|$)", spark.sparkContext.master):
            # One process and no shared folder named; on a cluster that is an error below.
            ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="tessera-checkpoints-"))
        sink = ParquetSink(Staging(spark, "written").root)
        sink.save(df, name)
        return spark.read.parquet(sink.path(name))

    return query


def _link_table(t: Tables) -> DataFrame:
    """The engagement-to-organization link table, which the reference reads and does not use."""
    return t["language_engagements_organizations"]


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "engagement_organization_links": _link_table,
    "engagement_locale": live.engagement_locale,
    "engagement_org_rep": live.engagement_org_rep,
    "engagement_eligibility": live.engagement_dimension,
    "section_lookup": lambda t: live.section_lookup(t).withColumnsRenamed(
        {"__is_ot": "is_ot", "__is_nt": "is_nt"}
    ),
    "section_membership": live.section_membership,
    "product_prep": live.prepared_products,
    "project_status": _project_status,
    "status_presence": lambda t: live.status_presence(live.status_classes(t)),
    "engagement_status": lambda t: live.engagement_status(live.status_classes(t)),
    "engagement_master": _engagement_master,
    "goal_coverage": _goal_coverage,
    "legacy_project_status": lambda t: legacy.legacy_project_status(t),
    "legacy_engagement_master": _legacy_engagement_master,
    "legacy_goal_coverage": lambda t: legacy.legacy_goal_coverage(
        t["pb_language_data"], live.engagement_org_rep(t)
    ),
    "legacy_training_filter": lambda t: legacy.legacy_training_filter(t["training_events"]),
    "json_list_explode": retired.json_list_explode,
    "sensitivity_rollup": retired.sensitivity_rollup,
    "mixed_dates": retired.mixed_dates,
    "strip_column_prefix": retired.strip_column_prefix,
    "country_xref": retired.country_xref,
    "group_by_display_name": retired.group_by_display_name,
    "json_document": retired.json_document,
    "written_projects": _written("master_uw_translation_projects", _project_status),
    "written_engagements": _written("master_uw_language_engagements", _engagement_master),
    "written_goals": _written("pb_language_engagements", _goal_coverage),
}


def build(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return QUERIES[name](fixture_frames(spark, sf_dir))
