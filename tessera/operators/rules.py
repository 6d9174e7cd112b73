"""Ordered rules over rows and groups.

``first_match`` is ``case_when``: the first condition that is TRUE wins, a
NULL condition counts as not matched, and no default gives NULL.

Group conditions follow R's three-valued ``any``/``all``: ``all(x == v)`` is
only TRUE when every row compares TRUE, so a NULL in the group makes it
not-TRUE (Spark's ``bool_and`` would skip the NULL). ``any`` is TRUE when at
least one row is TRUE, which ``bool_or`` already gives. No rule negates a
group condition, so "not TRUE" may be represented as FALSE throughout.

Group values can be attached two ways with identical results:

* ``"aggregate"`` (default): ``groupBy(keys).agg(...)`` then a NULL-safe join
  back onto the rows. The aggregate is partial (map-side), so a group holding
  a third of all rows is reduced before the shuffle, and the join back is a
  plain equi-join whose hot partitions AQE splits across tasks.
* ``"window"``: one ``Window.partitionBy(keys)`` spec for all values; each
  group goes to one task, so this form is a model for tests, not for a job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tessera.operators.joins import col, null_safe_join


def first_match(cases: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """``case_when(cond1 ~ v1, cond2 ~ v2, ...)``; unmatched rows get ``default``."""
    if not cases:
        raise ValueError("first_match needs at least one case")
    (cond, value), *rest = cases
    expr = F.when(cond, value)
    for cond, value in rest:
        expr = expr.when(cond, value)
    if default is not None:
        expr = expr.otherwise(default)
    return expr


@dataclass(frozen=True, eq=False)
class GroupValue:
    """One value of a group: of its rows, over a window, or of parts already aggregated.

    ``weight`` names a column that says how many rows a part stands for.
    """

    kind: str
    cond: Column | None = None

    def __call__(self, window: WindowSpec | None = None, weight: Column | None = None) -> Column:
        if self.kind == "size":
            agg = F.count(F.lit(1)) if weight is None else F.sum(weight)
            return _over(agg, window)
        agg = F.bool_or(self.cond) if self.kind == "any" else F.bool_and(F.coalesce(self.cond, F.lit(False)))
        return F.coalesce(_over(agg, window), F.lit(False))

    def merged(self, part: Column, weight: Column) -> Column:
        """The value of a group from its parts' values; each part counts ``weight`` times."""
        if self.kind == "size":
            return F.sum(part * weight)
        return F.coalesce(F.bool_or(part) if self.kind == "any" else F.bool_and(part), F.lit(False))


def _over(agg: Column, window: WindowSpec | None) -> Column:
    return agg if window is None else agg.over(window)


def group_any(cond: Column) -> GroupValue:
    """R's ``any(cond)`` per group as a definite boolean (NA counts as no)."""
    return GroupValue("any", cond)


def group_all(cond: Column) -> GroupValue:
    """R's ``all(cond)`` per group, NULL-strict: a NA row means "not all"."""
    return GroupValue("all", cond)


def group_size() -> GroupValue:
    """R's ``n()`` per group."""
    return GroupValue("size")


def with_group_values(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, GroupValue],
    method: str = "aggregate",
) -> DataFrame:
    """Attach per-group aggregate ``values`` to every row of ``df``.

    Groups are formed by ``keys`` with NULLs grouping together. Row count and
    row content are unchanged; new columns are appended in ``values`` order.
    """
    if method == "window":
        w = Window.partitionBy(*[col(k) for k in keys])
        return df.select("*", *[value(w).alias(name) for name, value in values.items()])
    if method != "aggregate":
        raise ValueError(f"unknown method {method!r}")
    per_group = df.groupBy(*[col(k).alias(k) for k in keys]).agg(
        *[value(None).alias(name) for name, value in values.items()]
    )
    return null_safe_join(df, per_group, list(keys), "inner")
