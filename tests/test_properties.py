"""Property tests: operators against plain-Python models on random small tables."""

from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators.joins import left_join_split, null_safe_join
from tessera.operators.rollup import best_by_priority

KEYS = st.one_of(st.none(), st.integers(min_value=0, max_value=3))
LEFT = st.lists(st.tuples(KEYS, st.integers(0, 99)), max_size=8)
RIGHT = st.lists(st.tuples(KEYS, st.integers(100, 199)), max_size=8)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def model_join(left, right, how):
    """Nested loops where None equals None (R's join semantics)."""
    out = []
    matched_right = set()
    for lk, lv in left:
        hits = [(j, rv) for j, (rk, rv) in enumerate(right) if rk == lk]
        for j, rv in hits:
            matched_right.add(j)
            out.append((lk, lv, rv))
        if not hits and how in ("left", "full"):
            out.append((lk, lv, None))
    if how in ("right", "full"):
        for j, (rk, rv) in enumerate(right):
            if j not in matched_right:
                out.append((rk, None, rv))
    return Counter(out)


def _frames(spark, left, right):
    lf = spark.createDataFrame(left, "k int, lv int")
    rf = spark.createDataFrame(right, "rk int, rv int")
    return lf, rf


@SETTINGS
@given(left=LEFT, right=RIGHT)
def test_null_safe_join_matches_model(spark, left, right):
    lf, rf = _frames(spark, left, right)
    for how in ("inner", "left", "right", "full"):
        got = Counter(tuple(r) for r in null_safe_join(lf, rf, {"k": "rk"}, how).collect())
        assert got == model_join(left, right, how), how


@SETTINGS
@given(left=LEFT, right=RIGHT)
def test_left_join_split_matches_model(spark, left, right):
    lf, rf = _frames(spark, left, right)
    got = Counter(tuple(r) for r in left_join_split(lf, rf, {"k": "rk"}).collect())
    assert got == model_join(left, right, "left")


ORDER = ["Active", "Future", "Paused", "Inactive", "Intent", "Completed"]
STATUS = st.one_of(st.none(), st.sampled_from(ORDER + ["Other"]))


@SETTINGS
@given(rows=st.lists(st.tuples(KEYS, STATUS), max_size=12))
def test_best_by_priority_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "id int, s string")
    got = {r.id: r.s for r in best_by_priority(df, "id", "s", ORDER).collect()}
    want = {}
    for k in {k for k, _ in rows}:
        present = {s for kk, s in rows if kk == k}
        want[k] = next((o for o in ORDER if o in present), None)
    assert got == want
