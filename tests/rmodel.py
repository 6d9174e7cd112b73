"""A plain-Python model of R's three-valued logic and the two status rule lists.

Independent of Spark: used to check the Spark expressions row by row.
None stands for NA.
"""

from __future__ import annotations


def eq(x, v):
    return None if x is None else x == v


def in_(x, values):
    # %in% never yields NA; NA matches a listed NA.
    return x in values


def and_(*xs):
    if any(x is False for x in xs):
        return False
    if any(x is None for x in xs):
        return None
    return True


def or_(*xs):
    if any(x is True for x in xs):
        return True
    if any(x is None for x in xs):
        return None
    return False


def any_(xs):
    return or_(*xs) if xs else False


def all_(xs):
    return and_(*xs) if xs else True


def lt(x, v):
    return None if x is None else x < v


def case_when(*arms):
    for cond, value in arms:
        if cond is True:
            return value
    return None


def live_status(row, group):
    """row: dict with package, assoc, status, ref; group: list of statuses."""
    s = row["status"]
    pkg, assoc, ref = row["package"], row["assoc"], row["ref"]
    n = len(group)
    has = lambda v: any_([eq(x, v) for x in group])
    every = lambda v: all_([eq(x, v) for x in group])
    text_or_bp = in_(pkg, ("BP", "Scripture Text"))
    return case_when(
        (has("Inactive"), "Inactive"),
        (and_(in_(assoc, ("Bible", "NT", "OT")), eq(s, "Completed")), "Completed"),
        (every("Planned"), "Future"),
        (has("In Progress"), "Active"),
        (and_(eq(pkg, "OBS"), eq(s, "Completed")), "Completed"),
        (or_(every("Paused"), or_(and_(has("Paused"), has("Completed")), has("Planned"))), "Paused"),
        (and_(text_or_bp, every("Completed"), eq(ref, "NT"), lt(n, 27)), "Active"),
        (and_(text_or_bp, every("Completed"), eq(ref, "OT"), lt(n, 39)), "Active"),
        (and_(has("Completed"), or_(has("Planned"), has("Not Scheduled"))), "Active"),
        (every("Completed"), "Completed"),
        (has("Not Scheduled"), "Intent"),
    )


def legacy_status(row, group, nt_list, ot_list):
    s = row["status"]
    pkg, assoc, ref = row["package"], row["assoc"], row["ref"]
    n = len(group)
    has = lambda v: any_([eq(x, v) for x in group])
    every = lambda v: all_([eq(x, v) for x in group])
    return case_when(
        (and_(eq(pkg, "BP"), or_(eq(ref, "NT"), eq(ref, "OT")), has("In Progress")), "Active"),
        (and_(eq(pkg, "BP"), eq(ref, "NT"), every("Completed"), lt(n, 27)), "Active"),
        (and_(eq(pkg, "BP"), eq(ref, "OT"), every("Completed"), lt(n, 39)), "Active"),
        (and_(eq(pkg, "Scripture Text"), eq(ref, "NT"), eq(assoc, "NT"), every("Completed")), "Completed"),
        (and_(eq(pkg, "Scripture Text"), eq(ref, "OT"), eq(assoc, "OT"), every("Completed")), "Completed"),
        (
            and_(eq(pkg, "Scripture Text"), eq(ref, "NT"), in_(assoc, nt_list), every("Completed"), lt(n, 27)),
            "Active",
        ),
        (
            and_(eq(pkg, "Scripture Text"), eq(ref, "OT"), in_(assoc, ot_list), every("Completed"), lt(n, 39)),
            "Active",
        ),
        (or_(eq(s, "Planned"), eq(s, "Not Scheduled")), "Future"),
        (has("In Progress"), "Active"),
        (in_(s, ("Paused",)), "Paused"),
        (in_(s, ("Inactive",)), "Inactive"),
        (every("Completed"), "Completed"),
    )


def best_by_priority(values, order):
    for v in order:
        if v in values:
            return v
    return None
