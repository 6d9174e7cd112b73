"""Compositions of the retired (commented-out) operators over the fixture inputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import status as st
from tessera.functions.text import strip_pattern_from_names
from tessera.operators.clean import (
    country_cross_reference,
    explode_json_list,
    parse_json_column,
    parse_mixed_date,
    rollup_list_attributes,
)
from tessera.operators.joins import col, null_safe_join
from tessera.plans import live

Tables = Mapping[str, DataFrame]

# Columns kept from the people-group cross reference.
PEOPLE_COLUMNS = (
    "PeopNameInCountry",
    "english_short_name",
    "ISO2",
    "LeastReached",
    "PrimaryLanguageName",
    "ROL3",
    "Population",
)

# The prefix a flattened API document puts on its columns.
RESOURCE_PREFIX_PATTERN = "resource."

# The declared shape of the API response: an array of records.
DOCUMENT_SCHEMA = (
    "resource array<struct<id: bigint, languageName: string,"
    " geo: struct<country: struct<code: string>, size: bigint>, tags: array<string>, level: int>>"
)


def json_list_explode(tables: Tables) -> DataFrame:
    """One row per (engagement, listed organization) with its attributes."""
    return _exploded_lists(tables).drop("row")


def _exploded_lists(tables: Tables) -> DataFrame:
    lists = tables["engagement_org_lists"]
    x = explode_json_list(
        lists, "translating_organization", T.LongType(), "translating_organization_clean", row_col="row"
    )
    orgs = tables["organizations"].select(
        "org_id", col("name").alias("translating_organization"), "sensitivity"
    )
    return null_safe_join(x, orgs, {"translating_organization_clean": "org_id"}, "left")


def sensitivity_rollup(tables: Tables) -> DataFrame:
    """Per engagement: strictest sensitivity and the organization names in order."""
    return rollup_list_attributes(
        _exploded_lists(tables),
        key="language_engagement_id",
        pos_col="pos",
        name_col="translating_organization",
        level_col="sensitivity",
    )


def mixed_dates(tables: Tables) -> DataFrame:
    """Both date columns cleaned; the originals are dropped."""
    return tables["order_date_text"].select(
        "o_orderkey",
        parse_mixed_date(col("start_date")).alias("new_start"),
        parse_mixed_date(col("published_date")).alias("new_published"),
    )


def strip_column_prefix(tables: Tables) -> DataFrame:
    return strip_pattern_from_names(tables["resource_document"], RESOURCE_PREFIX_PATTERN)


def country_xref(tables: Tables) -> DataFrame:
    return country_cross_reference(
        tables["joshua_project_data"],
        tables["country_cross_reference"],
        tables["countries"],
        PEOPLE_COLUMNS,
    )


def json_document(tables: Tables) -> DataFrame:
    """API responses as a table: one row per record, prefixes stripped, lists joined."""
    records = parse_json_column(tables["event_documents"], "document", DOCUMENT_SCHEMA)
    x = strip_pattern_from_names(records, RESOURCE_PREFIX_PATTERN)
    return x.withColumn("tags", F.array_join("tags", ";"))


def group_by_display_name(tables: Tables, method: str = "aggregate") -> DataFrame:
    """Live status rules with products grouped by country and display name."""
    return live.project_status(tables, keys=st.DISPLAY_GROUP_KEYS, method=method)


__all__ = [
    "json_list_explode",
    "sensitivity_rollup",
    "mixed_dates",
    "strip_column_prefix",
    "country_xref",
    "json_document",
    "group_by_display_name",
]
