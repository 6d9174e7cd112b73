"""Sharding by sampled splitters: shards of near equal bytes from size-weighted key samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, check_columns, col, row_position

# Key samples for each range; the largest range of a round then rarely passes
# twice the mean. The driver holds shards * ranges_per_shard * this many keys.
SAMPLES_PER_RANGE = 8
_U53 = float(1 << 53)


@dataclass(frozen=True)
class Ranges:
    """Sorted lower bounds ``(key, place)`` of ranges 1, 2, ...; range 0 has none."""

    key: np.ndarray
    place: np.ndarray

    def find(self, key: np.ndarray, place: np.ndarray) -> np.ndarray:
        out = np.searchsorted(self.key, key, "left")
        upper = np.searchsorted(self.key, key, "right")
        for at in np.flatnonzero(out < upper):
            out[at] += np.searchsorted(self.place[out[at] : upper[at]], place[at], "right")
        return out

    def with_bounds(self, bounds: set[tuple[int, int]]) -> Ranges:
        both = sorted(bounds | set(zip(self.key.tolist(), self.place.tolist())))
        return Ranges(np.array([k for k, _ in both], np.int64), np.array([p for _, p in both], np.int64))

    def column(self) -> Column:
        @F.pandas_udf("int")
        def range_of(key: pd.Series, place: pd.Series) -> pd.Series:
            return pd.Series(self.find(key.to_numpy(np.int64), place.to_numpy(np.int64)).astype(np.int32))

        return range_of("key", "place")


def _weighted_samples(rows: DataFrame, expected: Column, seed: int) -> DataFrame:
    """Rows drawn with the probability ``expected``, by a hash of the row.

    A drawn row stands for as many samples as were expected of it, and at least one.
    """
    hashed = F.xxhash64(F.lit(seed), "key", "place").bitwiseAND((1 << 53) - 1) / F.lit(_U53)
    return rows.filter(hashed < expected)


def _cuts(keys: np.ndarray, weights: np.ndarray, parts: int) -> set[int]:
    """Keys at the inner quantiles of the sampled weight."""
    if not len(keys):
        return set()
    order = np.argsort(keys, kind="stable")
    reached = np.cumsum(weights[order])
    at = np.searchsorted(reached, reached[-1] * np.arange(1, parts) / parts)
    return set(keys[order][np.minimum(at, len(keys) - 1)].tolist())


def shard_by_bytes(
    docs: DataFrame,
    scratch: Scratch,
    shards: int = 16,
    ranges_per_shard: int = 64,
    seed: int = 11,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for every row, shards of near equal bytes.

    A row's size is its text's UTF-8 bytes plus 1 (null text: 1). Its key is
    the text's hash, then its place in the saved table, so keys are distinct.
    Key samples drawn in proportion to size give quantile bounds on the text
    hash, which never part equal texts. The exact bytes and rows of every range
    are then counted; a range over twice the mean of either is subdivided by
    samples of its own rows, by place where it holds a single text (such as the
    empty one, of many rows and few bytes), until none is left that has two
    rows. Shards are runs of ranges that end closest to equal shares; an
    end inside a group of equal texts is taken only where the closest other
    end is more than a hundredth of a shard worse. ``slot`` counts a shard's
    rows from 0 in key order.

    Only sizes and keys are shuffled. The driver holds the samples and one row
    a range. Null ids stay; repeated rows are rows of their own; an empty
    table gives no rows; no other column is read.
    """
    check_columns(docs, [id_col, text_col])
    text = F.coalesce(col(text_col), F.lit(""))
    rows = scratch.save(
        docs.select(
            col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            row_position().alias("place"),
        ),
        "keys",
    )
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not count:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranges, held = _even_ranges(rows, total, count, shards * ranges_per_shard, seed)
    shard_of, before = _shards_of_ranges(held, ranges, shards, total)
    size = int(held["range"].max()) + 1
    shard_list, before_list = [0] * size, [0] * size
    for r, s, b in zip(held["range"], shard_of, before):
        shard_list[r], before_list[r] = int(s), int(b)
    in_range = F.row_number().over(Window.partitionBy("range").orderBy("key", "place"))
    return (
        rows.withColumn("range", ranges.column())
        .withColumn("__n", in_range)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit(shard_list)[F.col("range")].alias("shard"),
            (F.lit(before_list).cast("array<bigint>")[F.col("range")] + F.col("__n") - 1).alias("slot"),
        )
    )


def _even_ranges(rows: DataFrame, total: int, count: int, n_ranges: int, seed: int) -> tuple[Ranges, pd.DataFrame]:
    """Ranges of at most twice the mean bytes and rows where rows can be parted, and what each holds."""
    unit = total / (n_ranges * SAMPLES_PER_RANGE)

    drawn = _weighted_samples(rows, F.col("size") / F.lit(unit), seed).select("key", "size").toPandas()
    bounds = _cuts(drawn["key"].to_numpy(), np.maximum(drawn["size"].to_numpy(float), unit), n_ranges)
    none = Ranges(np.array([], np.int64), np.array([], np.int64))
    ranges = none.with_bounds({(k, -1) for k in bounds})

    mean_bytes, mean_rows = total / n_ranges, max(1.0, count / n_ranges)
    # What a row takes of a mean range, by bytes or as a row.
    load = F.greatest(F.col("size") / F.lit(mean_bytes), F.lit(1 / mean_rows))
    while True:
        held = (
            rows.withColumn("range", ranges.column())
            .groupBy("range")
            .agg(
                F.sum("size").alias("bytes"),
                F.count(F.lit(1)).alias("rows"),
                F.sum(load).alias("load"),
                F.min("key").alias("low"),
                F.max("key").alias("high"),
            )
            .toPandas()
            .sort_values("range")
        )
        full = (held["bytes"] > 2 * mean_bytes) | (held["rows"] > 2 * mean_rows)
        over = held[full & (held["rows"] > 1)]
        found = _subdivide(rows, ranges, over, load, seed) if len(over) else set()
        grown = ranges.with_bounds(found)
        if len(grown.key) == len(ranges.key):
            break
        ranges = grown
    return ranges, held


def _subdivide(rows: DataFrame, ranges: Ranges, over: pd.DataFrame, load: Column, seed: int) -> set[tuple[int, int]]:
    """Bounds inside the overfull ranges, from samples of their own rows in proportion to ``load``."""
    expected = load * F.lit(SAMPLES_PER_RANGE)
    chosen = rows.withColumn("range", ranges.column()).filter(F.col("range").isin(over["range"].tolist()))
    sampled = (
        _weighted_samples(chosen, expected, seed + 1 + len(ranges.key))
        .select("range", "key", "place", F.greatest(expected, F.lit(1.0)).alias("weight"))
        .toPandas()
    )
    found: set[tuple[int, int]] = set()
    by_range = dict(list(sampled.groupby("range")))
    for r, held, low, high in over[["range", "load", "low", "high"]].itertuples(index=False):
        if r not in by_range:
            continue
        own, parts = by_range[r], max(2, int(np.ceil(held)))
        if low == high:
            places = _cuts(own["place"].to_numpy(), own["weight"].to_numpy(), parts)
            found |= {(int(low), p) for p in places}
        else:
            keys = _cuts(own["key"].to_numpy(), own["weight"].to_numpy(), parts) - {low}
            # The first text outweighs the rest: it gets a range of its own.
            found |= {(int(k), -1) for k in keys} or {(int(low) + 1, -1)}
    return found


def _shards_of_ranges(held: pd.DataFrame, ranges: Ranges, shards: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Each range's shard, and the rows its shard holds before it."""
    ends = np.cumsum(held["bytes"].to_numpy())
    nxt = held["range"].to_numpy()[1:]
    parts_group = np.append(ranges.place[nxt - 1] >= 0, False) if len(ranges.key) else np.array([False] * len(ends))
    share = total / shards
    worse = parts_group * (share / 100)
    last = [int(np.argmin(np.abs(ends - share * k) + worse)) for k in range(1, shards)]
    shard = np.searchsorted(np.maximum.accumulate(np.array(last, np.int64)), np.arange(len(ends)), "left")
    counts = held["rows"].to_numpy()
    before = np.cumsum(counts) - counts
    first = np.array([before[shard == s][0] if (shard == s).any() else 0 for s in range(shards)])
    return shard, before - first[shard]


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """Write whole rows to ``path/shard=N`` in slot order; ids must be unique."""
    placed = assigned.select(col("doc_id").alias("__id"), col("shard").alias("shard"), col("slot").alias("slot"))
    (
        docs.drop("shard", "slot")
        .join(placed, col("doc_id").eqNullSafe(col("__id")))
        .drop("__id")
        .repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
