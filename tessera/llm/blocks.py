"""Pairs inside groups that may be very large, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col


def block_pairs(rows: DataFrame, group: str, row: str, block_rows: int) -> DataFrame:
    """Copy the rows of each group to its block pairs; groups of one row go.

    A group of up to ``block_rows`` rows is one block and its rows come once,
    with ``__left = __right = 0``. A larger one is dealt into blocks by the hash
    of ``row`` and every unordered pair of blocks becomes a unit (``group``,
    ``__left``, ``__right``) that holds both blocks (``__side`` says which one a
    row is of), so no task holds more than two blocks and no pair is lost.
    Within a unit of two blocks only pairs across them are to be taken.
    """
    sizes = rows.groupBy(col(group).alias("__g")).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    blocks = F.ceil(F.col("__n") / F.lit(block_rows)).cast("int")
    own = F.pmod(F.xxhash64(col(row)), F.col("__blocks")).cast("int")
    placed = (
        rows.join(sizes, col(group) == F.col("__g"))
        .drop("__g")
        .withColumn("__blocks", blocks)
        .withColumn("__own", own)
        .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    )
    return placed.withColumns(
        {
            "__left": F.least("__own", "__other"),
            "__right": F.greatest("__own", "__other"),
            "__side": (F.col("__own") > F.col("__other")).cast("int"),
        }
    ).drop("__n", "__blocks", "__own", "__other")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal ``keys``, from batches sorted by them.

    Runs are put out together as far as a batch holds them whole; the last run
    of a batch waits for the next one.
    """
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = batch.num_rows - 1
        cut = last
        final = [batch.column(k)[last] for k in keys]
        columns = [batch.column(k) for k in keys]
        while cut > 0 and all(c[cut - 1].equals(f) for c, f in zip(columns, final)):
            cut -= 1
        if cut == 0 and waiting and all(waiting[-1].column(k)[-1].equals(f) for k, f in zip(keys, final)):
            waiting.append(batch)
            continue
        if cut:
            yield pa.Table.from_batches([*waiting, batch.slice(0, cut)])
            waiting = [batch.slice(cut)]
        else:
            if waiting:
                yield pa.Table.from_batches(waiting)
            waiting = [batch]
    if waiting:
        yield pa.Table.from_batches(waiting)
