"""Status rules: truth tables against the Python R model, and golden cases."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from tessera.functions import status as st
from tessera.operators.joins import add_membership_flags, membership_lookup
from tessera.operators.rules import first_match, group_all, with_group_values
from tests import rmodel

STATUSES = ["Inactive", "Completed", "Planned", "In Progress", "Paused", "Not Scheduled", None]
PACKAGES = ["OBS", "EJ", "BP", "Scripture Text", None]
REFS = ["NT", "OT", None]
LIVE_ASSOCS = ["Bible", "NT", "MAT", None]
LEGACY_ASSOCS = ["NT", "OT", "MAT", "GEN", None, "Bible"]
NT_LIST = ["MAT", "NT"]
OT_LIST = ["GEN", None]
SCHEMA = (
    "gid long, i int, resource_package string, bible_book_ref string, "
    "scriptural_association string, product_status string"
)


def _groups(assocs):
    """Every non-empty status set x package x ref, plus threshold-sized groups."""
    gid = 0
    subsets = [
        list(c) for r in range(1, len(STATUSES) + 1) for c in itertools.combinations(STATUSES, r)
    ]
    for subset in subsets:
        shapes = [(p, r, len(subset)) for p in PACKAGES for r in REFS]
        if len(subset) <= 2:
            shapes += [
                (p, r, n)
                for p in ("BP", "Scripture Text")
                for r in ("NT", "OT")
                for n in (26, 27, 38, 39)
            ]
        for pkg, ref, n in shapes:
            statuses = subset + [subset[0]] * (n - len(subset))
            rows = [
                (gid, i, pkg, ref, assocs[i % len(assocs)], s) for i, s in enumerate(statuses)
            ]
            yield rows
            gid += 1


def _rows_and_expected(assocs, model):
    rows, expected = [], {}
    for group in _groups(assocs):
        statuses = [r[5] for r in group]
        for gid, i, pkg, ref, assoc, s in group:
            row = {"package": pkg, "ref": ref, "assoc": assoc, "status": s}
            expected[(gid, i)] = model(row, statuses)
        rows += group
    return rows, expected


@pytest.mark.parametrize("method", ["aggregate", "window"])
def test_live_rules_truth_table(spark, method):
    rows, expected = _rows_and_expected(LIVE_ASSOCS, rmodel.live_status)
    df = spark.createDataFrame(rows, SCHEMA)
    keys = ["gid", "resource_package", "bible_book_ref"]
    x = with_group_values(df, keys, st.live_group_values(), method)
    got = x.select("gid", "i", first_match(st.live_rules()).alias("s")).collect()
    assert len(got) == len(rows)
    mismatches = [(r.gid, r.i, r.s, expected[(r.gid, r.i)]) for r in got if r.s != expected[(r.gid, r.i)]]
    assert not mismatches, mismatches[:10]
    # Every rule fires somewhere, and some rows fall through to NULL.
    assert {"Inactive", "Completed", "Future", "Active", "Paused", "Intent", None} <= set(expected.values())


@pytest.mark.parametrize("method", ["aggregate", "window"])
def test_legacy_rules_truth_table(spark, method):
    def model(row, group):
        return rmodel.legacy_status(row, group, NT_LIST, OT_LIST)

    rows, expected = _rows_and_expected(LEGACY_ASSOCS, model)
    df = spark.createDataFrame(rows, SCHEMA)
    bible = spark.createDataFrame(
        [(a, "NT") for a in NT_LIST] + [(a, "OT") for a in OT_LIST],
        "scriptural_association string, bible_section string",
    )
    flags = membership_lookup(bible, "scriptural_association", "bible_section", {"OT": "__is_ot", "NT": "__is_nt"})
    df = add_membership_flags(df, "scriptural_association", flags)
    keys = ["gid", "resource_package", "bible_book_ref"]
    x = with_group_values(df, keys, st.legacy_group_values(), method)
    got = x.select("gid", "i", first_match(st.legacy_rules()).alias("s")).collect()
    assert len(got) == len(rows)
    mismatches = [(r.gid, r.i, r.s, expected[(r.gid, r.i)]) for r in got if r.s != expected[(r.gid, r.i)]]
    assert not mismatches, mismatches[:10]


def test_plain_bool_and_would_be_wrong(spark):
    """The NULL-strict `all` matters: a NULL next to Planned is not 'all Planned'."""
    df = spark.createDataFrame([(1, "Planned"), (1, None)], "g int, s string")
    out = df.groupBy("g").agg(
        F.bool_and(F.col("s") == "Planned").alias("plain"),
        group_all(F.col("s") == "Planned")().alias("strict"),
    ).first()
    assert out.plain is True and out.strict is False


# Golden cases for the live rules: package, ref, association, row status,
# group statuses, group size, expected.
LIVE_GOLDEN = [
    ("OBS", "STORY", None, "Completed", ["Completed", "Inactive"], 2, "Inactive"),
    ("BP", "NT", "NT", "Completed", ["Completed", "In Progress"], 2, "Completed"),
    ("BP", "NT", "MAT", "Completed", ["Completed", "In Progress"], 2, "Active"),
    ("BP", "BIBLE", "Bible", "Completed", ["Completed"], 1, "Completed"),
    ("EJ", "SELECT", None, "Planned", ["Planned"], 1, "Future"),
    ("EJ", "SELECT", None, "Planned", ["Planned", None], 2, "Paused"),
    ("Scripture Text", "NT", "MAT", "Completed", ["Planned", "Completed"], 2, "Paused"),
    ("Scripture Text", "NT", "MAT", "Planned", ["Planned", "Not Scheduled"], 2, "Paused"),
    ("OBS", "STORY", None, "Completed", ["Completed", "Paused"], 2, "Completed"),
    ("OBS", "STORY", None, "Paused", ["Completed", "Paused"], 2, "Paused"),
    ("Scripture Text", "OT", "GEN", "Paused", ["Paused"], 1, "Paused"),
    ("Scripture Text", "OT", "GEN", "Paused", ["Paused", "Not Scheduled"], 2, "Intent"),
    ("Scripture Text", "OT", "GEN", "Paused", ["Paused", None], 2, None),
    ("BP", "NT", "MAT", "Completed", ["Completed"], 26, "Active"),
    ("BP", "NT", "MAT", "Completed", ["Completed"], 27, "Completed"),
    ("Scripture Text", "OT", "GEN", "Completed", ["Completed"], 38, "Active"),
    ("Scripture Text", "OT", "GEN", "Completed", ["Completed"], 39, "Completed"),
    ("Scripture Text", "NT", "MAT", "Not Scheduled", ["Completed", "Not Scheduled"], 2, "Active"),
    ("EJ", "SELECT", None, "Completed", ["Completed"], 1, "Completed"),
    ("EJ", "SELECT", None, "Completed", ["Completed", None], 2, None),
    ("Scripture Text", "NT", "MAT", None, [None], 1, None),
    ("Scripture Text", "NT", "MAT", "Not Scheduled", ["Not Scheduled", None], 2, "Intent"),
    (None, None, "MAT", "Completed", ["Completed"], 1, "Completed"),
]

LEGACY_GOLDEN = [
    ("BP", "NT", "MAT", "Completed", ["In Progress", "Completed"], 2, "Active"),
    ("BP", "NT", "MAT", "Completed", ["Completed"], 26, "Active"),
    ("BP", "NT", "MAT", "Completed", ["Completed"], 27, "Completed"),
    ("BP", "NT", "NT", "Completed", ["Completed"], 1, "Active"),
    ("Scripture Text", "NT", "NT", "Completed", ["Completed"], 1, "Completed"),
    ("Scripture Text", "NT", "MAT", "Completed", ["Completed"], 26, "Active"),
    ("Scripture Text", "NT", "MAT", "Planned", ["Planned", "In Progress"], 2, "Future"),
    ("Scripture Text", "NT", "MAT", "In Progress", ["Planned", "In Progress"], 2, "Active"),
    ("Scripture Text", "NT", "MAT", "Completed", ["Completed", "Planned"], 2, None),
    ("Scripture Text", "NT", "MAT", "Inactive", ["Completed", "Inactive"], 2, "Inactive"),
    ("Scripture Text", "NT", "MAT", "Completed", ["Completed", "Inactive"], 2, None),
]


def _golden_frame(spark, cases):
    rows = []
    for gid, (pkg, ref, assoc, row_status, group, n, _) in enumerate(cases):
        others = list(group)
        others.remove(row_status)
        others += [group[0]] * (n - len(group))
        rows.append((gid, 0, pkg, ref, assoc, row_status))
        rows += [(gid, i + 1, pkg, ref, "MAT", s) for i, s in enumerate(others)]
    return spark.createDataFrame(rows, SCHEMA)


def test_live_golden_cases(spark):
    df = _golden_frame(spark, LIVE_GOLDEN)
    x = with_group_values(df, ["gid", "resource_package", "bible_book_ref"], st.live_group_values())
    got = {r.gid: r.s for r in x.filter("i = 0").select("gid", first_match(st.live_rules()).alias("s")).collect()}
    assert [got[g] for g in range(len(LIVE_GOLDEN))] == [c[-1] for c in LIVE_GOLDEN]


def test_legacy_golden_cases(spark):
    df = _golden_frame(spark, LEGACY_GOLDEN)
    bible = spark.createDataFrame(
        [("MAT", "NT"), ("NT", "NT"), ("GEN", "OT")], "scriptural_association string, bible_section string"
    )
    flags = membership_lookup(bible, "scriptural_association", "bible_section", {"OT": "__is_ot", "NT": "__is_nt"})
    df = add_membership_flags(df, "scriptural_association", flags)
    x = with_group_values(df, ["gid", "resource_package", "bible_book_ref"], st.legacy_group_values())
    got = {r.gid: r.s for r in x.filter("i = 0").select("gid", first_match(st.legacy_rules()).alias("s")).collect()}
    assert [got[g] for g in range(len(LEGACY_GOLDEN))] == [c[-1] for c in LEGACY_GOLDEN]
