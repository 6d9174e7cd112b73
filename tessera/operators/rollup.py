"""Per-key rollups: best value by priority, and a fixed-column presence pivot.

The reference takes distinct (key, value) pairs, pivots them wide with one
column per value, then walks the columns in priority order. Both steps fold
into a single partial aggregate here: rank each value by its position in
the priority list and keep the minimum rank per key. Only one row per key
per task crosses the shuffle, whatever the skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import col


def priority_rank(value: Column, order: Sequence[str]) -> Column:
    """1-based position of ``value`` in ``order``; NULL when absent or NULL.

    ``array_position`` returns 0 for a value that is not listed, which would
    win a ``min``; it is mapped to NULL.
    """
    listed = F.array(*[F.lit(v) for v in order])
    return F.nullif(F.array_position(listed, value), F.lit(0))


def value_of_rank(rank: Column, order: Sequence[str]) -> Column:
    """Inverse of :func:`priority_rank`; NULL rank gives NULL.

    Written as a CASE chain: on Spark 4.1, ``element_at`` over a literal
    array returned the last element for a NULL index instead of NULL.
    """
    expr = F.when(rank == 1, F.lit(order[0]))
    for i, v in enumerate(order[1:], start=2):
        expr = expr.when(rank == i, F.lit(v))
    return expr


def best_by_priority(
    df: DataFrame,
    keys: str | Sequence[str],
    value_col: str,
    order: Sequence[str],
    out_col: str | None = None,
) -> DataFrame:
    """One row per key with the highest-priority value seen for it.

    Keys whose values are all NULL or unlisted are kept with NULL. NULL keys
    form one group.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranked = df.groupBy(*[col(k).alias(k) for k in keys]).agg(
        F.min(priority_rank(col(value_col), order)).alias("__rank")
    )
    return ranked.select(
        *[col(k) for k in keys], value_of_rank(F.col("__rank"), order).alias(out_col or value_col)
    )


def pivot_presence(
    df: DataFrame, keys: str | Sequence[str], value_col: str, values: Sequence[str]
) -> DataFrame:
    """Long to wide: one column per listed value, holding the value if the key has it.

    The column list is fixed by ``values``, so a value missing from today's
    data still yields its (all-NULL) column, and a key whose only value is
    NULL still gets a row. Values outside the list are ignored.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (
        df.groupBy(*[col(k).alias(k) for k in keys])
        .pivot(value_col, list(values))
        .agg(F.max(col(value_col)))
    )
