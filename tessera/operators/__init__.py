"""Reusable DataFrame operators: joins, group rules, rollups, cleaning."""

from tessera.operators.joins import (
    add_membership_flags,
    in_values,
    left_join_split,
    membership_lookup,
    natural_join,
    null_safe_join,
)
from tessera.operators.rollup import best_by_priority, pivot_presence, priority_rank
from tessera.operators.rules import (
    first_match,
    group_all,
    group_any,
    group_size,
    with_group_values,
)

__all__ = [
    "add_membership_flags",
    "in_values",
    "left_join_split",
    "membership_lookup",
    "natural_join",
    "null_safe_join",
    "best_by_priority",
    "pivot_presence",
    "priority_rank",
    "first_match",
    "group_all",
    "group_any",
    "group_size",
    "with_group_values",
]
