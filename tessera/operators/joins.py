"""Joins with R/dplyr key semantics, expressed as Spark equi-joins.

dplyr matches NULL to NULL in join keys. ``eqNullSafe`` gives the same
answer and Spark still plans it as an equi-join (hashing on the coalesced key
plus an is-null flag), so it stays a sort-merge or hash join. All NULL keys
land in one shuffle partition; AQE's skew-join split (enabled in
``tessera.session``) breaks that partition, like any hot key, into several
tasks on the large side.

Physical strategy is left to Catalyst and AQE, which choose from measured
bytes. Nothing here asks for a broadcast, counts rows or caches.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KeySpec = str | Sequence[str] | Sequence[tuple[str, str]] | Mapping[str, str]


def col(name: str) -> Column:
    """A column by exact name (names may hold spaces or dots)."""
    return F.col(f"`{name}`")


def _key_pairs(on: KeySpec) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    pairs = []
    for item in on:
        pairs.append((item, item) if isinstance(item, str) else (item[0], item[1]))
    return pairs


_HOW = {
    "inner": "inner",
    "left": "left",
    "left_outer": "left",
    "right": "right",
    "right_outer": "right",
    "full": "full",
    "full_outer": "full",
    "outer": "full",
    "semi": "left_semi",
    "left_semi": "left_semi",
    "anti": "left_anti",
    "left_anti": "left_anti",
}


def null_safe_join(left: DataFrame, right: DataFrame, on: KeySpec, how: str = "inner") -> DataFrame:
    """Join where NULL keys match NULL keys; each key appears once.

    ``on`` is a column name, a list of names, a list of ``(left, right)``
    pairs or a ``{left: right}`` mapping. Output columns are the left columns
    in order followed by the right non-key columns, as dplyr lays them out.
    The key keeps the left name; in a right join it holds the right side's
    values, in a full join whichever side is present.

    Non-key columns present on both sides are an error: prune each side to
    the columns you need before joining.
    """
    kind = _HOW[how]
    pairs = _key_pairs(on)
    left_keys = [lk for lk, _ in pairs]
    right_keys = [rk for _, rk in pairs]
    missing = [k for k in left_keys if k not in left.columns] + [
        k for k in right_keys if k not in right.columns
    ]
    if missing:
        raise ValueError(f"join keys not found: {missing}")
    right_rest = [c for c in right.columns if c not in right_keys]
    clash = sorted(set(right_rest) & set(left.columns))
    if clash and kind not in ("left_semi", "left_anti"):
        raise ValueError(f"non-key columns on both sides: {clash}; prune before joining")

    tmp = {rk: f"__rk{i}" for i, rk in enumerate(right_keys)}
    taken = set(left.columns) | set(right_rest)
    for rk in list(tmp):
        while tmp[rk] in taken:
            tmp[rk] = "_" + tmp[rk]
    kept_right = right_rest if kind not in ("left_semi", "left_anti") else []
    r = right.select(*[col(rk).alias(tmp[rk]) for rk in right_keys], *[col(c) for c in kept_right])
    cond = reduce(
        lambda a, b: a & b, [col(lk).eqNullSafe(col(tmp[rk])) for lk, rk in pairs]
    )
    joined = left.join(r, cond, kind)
    if kind in ("left_semi", "left_anti"):
        return joined

    key_of = dict(pairs)

    def left_out(c: str) -> Column:
        if c in key_of and kind == "right":
            return col(tmp[key_of[c]]).alias(c)
        if c in key_of and kind == "full":
            return F.coalesce(col(c), col(tmp[key_of[c]])).alias(c)
        return col(c)

    return joined.select(*[left_out(c) for c in left.columns], *[col(c) for c in right_rest])


def left_join_split(
    left: DataFrame, right: DataFrame, on: KeySpec, right_keys_of: DataFrame | None = None
) -> DataFrame:
    """A NULL-safe left join that stays parallel when the right side has hot keys.

    AQE can split a skewed partition on either side of an inner join, but
    never on the non-preserved (right) side of a left join. So the join is
    written as the matched rows (inner join) plus the left rows without a
    match (anti join against the right side's distinct keys, which a partial
    aggregate collapses before the shuffle). Same multiset as a left join.

    ``right_keys_of`` may name a cheaper frame that holds the same set of keys
    (an input of ``right`` from before its costly columns were derived), so
    those columns are computed once.
    """
    pairs = _key_pairs(on)
    right_keys = [rk for _, rk in pairs]
    right_rest = [c for c in right.columns if c not in right_keys]
    matched = null_safe_join(left, right, pairs, "inner")
    source = right if right_keys_of is None else right_keys_of
    keys_only = source.select(*[col(rk) for rk in right_keys]).distinct()
    unmatched = null_safe_join(left, keys_only, pairs, "anti").select(
        "*", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right_rest]
    )
    return matched.unionByName(unmatched)


def natural_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """dplyr's natural join, made explicit.

    A natural join uses every shared column name. Declaring the keys and
    failing when the shared set differs keeps a new upstream column from
    silently changing the join.
    """
    shared = set(left.columns) & set(right.columns)
    if shared != set(keys):
        raise ValueError(
            f"natural join expected shared columns {sorted(keys)}, found {sorted(shared)}"
        )
    return null_safe_join(left, right, list(keys), how)


def in_values(c: Column, values: Iterable[object]) -> Column:
    """R's ``x %in% c(...)``: never NULL, and NULL matches a listed NULL."""
    values = list(values)
    present = [v for v in values if v is not None]
    hit = c.isin(present) if present else F.lit(False)
    if len(present) != len(values):
        hit = hit | c.isNull()
    return F.coalesce(hit, F.lit(False))


def membership_lookup(
    lookup: DataFrame, value_col: str, group_col: str, groups: Mapping[str, str]
) -> DataFrame:
    """Turn a (value, group) list into one row per value with a flag per group.

    This replaces ``values <- lookup[group == g, value]`` followed by
    ``x %in% values``: nothing is collected to the driver, and a NULL value in
    the list keeps matching NULL, which ``isin`` would not.
    """
    grp = col(group_col)
    return lookup.groupBy(col(value_col).alias(value_col)).agg(
        *[F.coalesce(F.bool_or(grp == g), F.lit(False)).alias(flag) for g, flag in groups.items()]
    )


def add_membership_flags(df: DataFrame, value_col: str, flags: DataFrame) -> DataFrame:
    """Attach the flags of :func:`membership_lookup`; values not listed get False."""
    flag_cols = [c for c in flags.columns if c != value_col]
    joined = null_safe_join(df, flags, value_col, "left")
    return joined.withColumns({c: F.coalesce(col(c), F.lit(False)) for c in flag_cols})
