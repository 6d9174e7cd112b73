"""Project-status rule sets: group values and ordered rules.

Each rule set is a function from column names to a list of
``(condition, status)`` pairs for :func:`tessera.operators.rules.first_match`.
Group-level inputs (``any``/``all``/``n``) are computed once per group by
:func:`tessera.operators.rules.with_group_values`; row-level tests read the
current row, so rows of one group may get different statuses.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.operators.joins import col, in_values
from tessera.operators.rules import GroupValue, group_all, group_any, group_size

# Product statuses the rules test for.
INACTIVE = "Inactive"
COMPLETED = "Completed"
PLANNED = "Planned"
IN_PROGRESS = "In Progress"
PAUSED = "Paused"
NOT_SCHEDULED = "Not Scheduled"

# Statuses the rules assign besides the ones above.
ACTIVE = "Active"
FUTURE = "Future"
INTENT = "Intent"
PROSPECTIVE = "Prospective"
NO_STATUS_LISTED = "No Status Listed"

# Resource packages and book references.
OBS = "OBS"
EJ = "EJ"
SCRIPTURE_TEXT = "Scripture Text"
BOOK_PACKAGE = "BP"
STORY = "STORY"
SELECT = "SELECT"
OT = "OT"
NT = "NT"
BIBLE = "BIBLE"
BIBLE_ASSOCIATION = "Bible"
WHOLE_TEXT_ASSOCIATIONS = ("Bible", "NT", "OT")

# Books in a complete testament; fewer completed means active.
BOOK_COUNTS = {"NT": 27, "OT": 39}

# Rollup priority per engagement, highest first.
LIVE_PRIORITY = ("Active", "Future", "Paused", "Inactive", "Intent", "Completed")
LEGACY_PRIORITY = ("Active", "Future", "Paused", "Completed", "Inactive")

# Group keys of the two flows.
LIVE_GROUP_KEYS = (
    "language_engagement_id",
    "resource_package",
    "resource_format",
    "bible_book_ref",
    "scripture_text_name",
)
LEGACY_GROUP_KEYS = (
    "english_short_name",
    "combined_anglicized_name",
    "resource_package",
    "resource_format",
    "bible_book_ref",
    "scripture_text_name",
)
DISPLAY_GROUP_KEYS = (
    "english_short_name",
    "combined_anglicized_name",
    "resource_format",
    "scripture_text_name",
)

# Access statuses that make a goal language eligible.
AAG_ELIGIBLE_STATUSES = ("Translation in Progress", "Translation Not Started", "Not Shown")

COUNT_COL = "BP_num"
STATUS_COL = "project_status"


def book_ref(package: Column, is_ot: Column, is_nt: Column, association: Column) -> Column:
    """Which part of scripture a product belongs to (OT beats NT)."""
    text_or_bp = (package == SCRIPTURE_TEXT) | (package == BOOK_PACKAGE)
    return (
        F.when(package == OBS, STORY)
        .when(package == EJ, SELECT)
        .when(text_or_bp & is_ot, OT)
        .when(text_or_bp & is_nt, NT)
        .when(text_or_bp & (association == BIBLE_ASSOCIATION), BIBLE)
    )


def aag_eligibility(access_status: Column) -> Column:
    """"Yes" for the eligible access statuses, "Unknown" when missing, else "No"."""
    return (
        F.when(in_values(access_status, AAG_ELIGIBLE_STATUSES), "Yes")
        .when(access_status.isNull(), "Unknown")
        .otherwise("No")
    )


def engagement_default_live(status: Column) -> Column:
    """No rolled-up status, or only intent, means the engagement is prospective."""
    return F.when(status.isNull(), PROSPECTIVE).when(status == INTENT, PROSPECTIVE).otherwise(status)


def engagement_default_legacy(status: Column) -> Column:
    return F.when(status.isNull(), NO_STATUS_LISTED).otherwise(status)


def live_group_values(status_col: str = "product_status") -> dict[str, GroupValue]:
    s = col(status_col)
    return {
        COUNT_COL: group_size(),
        "__any_inactive": group_any(s == INACTIVE),
        "__all_planned": group_all(s == PLANNED),
        "__any_in_progress": group_any(s == IN_PROGRESS),
        "__all_paused": group_all(s == PAUSED),
        "__any_paused": group_any(s == PAUSED),
        "__any_completed": group_any(s == COMPLETED),
        "__any_planned": group_any(s == PLANNED),
        "__all_completed": group_all(s == COMPLETED),
        "__any_not_scheduled": group_any(s == NOT_SCHEDULED),
    }


def live_rules(
    status_col: str = "product_status",
    package_col: str = "resource_package",
    association_col: str = "scriptural_association",
    ref_col: str = "bible_book_ref",
    count_col: str = COUNT_COL,
    book_counts: Mapping[str, int] = BOOK_COUNTS,
) -> list[tuple[Column, str]]:
    """The live rule list, first match wins.

    The "Paused" rule reads ``all(Paused) | (any(Paused) & any(Completed)) |
    any(Planned)`` because ``&`` binds tighter than ``|``; so any group with
    a Planned row that gets that far is Paused, and the Planned arm of the
    later "Active" rule never fires. Kept as the reference computes it.
    """
    s, pkg, assoc = col(status_col), col(package_col), col(association_col)
    ref, n = col(ref_col), col(count_col)
    g = {name: F.col(name) for name in live_group_values(status_col) if name != COUNT_COL}
    text_or_bp = in_values(pkg, (BOOK_PACKAGE, SCRIPTURE_TEXT))
    return [
        (g["__any_inactive"], INACTIVE),
        (in_values(assoc, WHOLE_TEXT_ASSOCIATIONS) & (s == COMPLETED), COMPLETED),
        (g["__all_planned"], FUTURE),
        (g["__any_in_progress"], ACTIVE),
        ((pkg == OBS) & (s == COMPLETED), COMPLETED),
        (
            g["__all_paused"] | (g["__any_paused"] & g["__any_completed"]) | g["__any_planned"],
            PAUSED,
        ),
        (text_or_bp & g["__all_completed"] & (ref == NT) & (n < book_counts[NT]), ACTIVE),
        (text_or_bp & g["__all_completed"] & (ref == OT) & (n < book_counts[OT]), ACTIVE),
        (g["__any_completed"] & (g["__any_planned"] | g["__any_not_scheduled"]), ACTIVE),
        (g["__all_completed"], COMPLETED),
        (g["__any_not_scheduled"], INTENT),
    ]


def legacy_group_values(status_col: str = "product_status") -> dict[str, GroupValue]:
    s = col(status_col)
    return {
        COUNT_COL: group_size(),
        "__any_in_progress": group_any(s == IN_PROGRESS),
        "__all_completed": group_all(s == COMPLETED),
    }


def legacy_rules(
    status_col: str = "product_status",
    package_col: str = "resource_package",
    association_col: str = "scriptural_association",
    ref_col: str = "bible_book_ref",
    is_ot_col: str = "__is_ot",
    is_nt_col: str = "__is_nt",
    count_col: str = COUNT_COL,
    book_counts: Mapping[str, int] = BOOK_COUNTS,
) -> list[tuple[Column, str]]:
    """The retired rule list, first match wins.

    ``is_ot_col``/``is_nt_col`` are the row's membership in the OT/NT
    association lists (NULL-aware, see ``membership_lookup``).
    """
    s, pkg, assoc = col(status_col), col(package_col), col(association_col)
    ref, n = col(ref_col), col(count_col)
    in_ot, in_nt = col(is_ot_col), col(is_nt_col)
    any_in_progress, all_completed = F.col("__any_in_progress"), F.col("__all_completed")
    bp, text = pkg == BOOK_PACKAGE, pkg == SCRIPTURE_TEXT
    return [
        (bp & ((ref == NT) | (ref == OT)) & any_in_progress, ACTIVE),
        (bp & (ref == NT) & all_completed & (n < book_counts[NT]), ACTIVE),
        (bp & (ref == OT) & all_completed & (n < book_counts[OT]), ACTIVE),
        (text & (ref == NT) & (assoc == NT) & all_completed, COMPLETED),
        (text & (ref == OT) & (assoc == OT) & all_completed, COMPLETED),
        (text & (ref == NT) & in_nt & all_completed & (n < book_counts[NT]), ACTIVE),
        (text & (ref == OT) & in_ot & all_completed & (n < book_counts[OT]), ACTIVE),
        ((s == PLANNED) | (s == NOT_SCHEDULED), FUTURE),
        (any_in_progress, ACTIVE),
        (in_values(s, (PAUSED,)), PAUSED),
        (in_values(s, (INACTIVE,)), INACTIVE),
        (all_completed, COMPLETED),
    ]
