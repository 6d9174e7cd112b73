"""Mixing sources to target weights: repetition rates from token totals, then whole copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, check_columns, col

# Fixed value: a word, for sizes.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes (source, size)``.

    Sources by code point, null last, get ``weights`` in turn. They share
    ``share`` of all sizes by weight; a target stops at ``most`` times its
    source's size and the excess goes to the others by weight. In the order
    of bound over weight the stopped sources come first. With the first k
    stopped the rest get ``(budget - their bounds) / (weight left)`` a unit of
    weight; that rises as long as stopping one more is right and falls after
    it, so its maximum is the level and no loop is needed.

    The windows have no key: they see one row a source, after the aggregate.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.lit(list(weights))[F.pmod(place, F.lit(len(weights)))]
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    up_to = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    return (
        per.withColumns({"place": place, "weight": weight.cast("long")})
        .withColumn("bound", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("bound") / F.col("weight"))
        .withColumns(
            {
                "budget": F.sum("source_size").over(everything) * F.lit(float(share)),
                "weight_left": F.sum("weight").over(everything) - up_to("weight"),
                "stopped": up_to("bound"),
            }
        )
        .withColumn("level", (F.col("budget") - F.col("stopped")) / F.col("weight_left"))
        .withColumn("level", F.max("level").over(everything))
        .select(
            "source",
            "source_size",
            F.least(F.col("bound"), F.col("level") * F.col("weight")).alias("target"),
        )
    )


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) with 52 bits from the parts' MD5, the same in every run."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(
    docs: DataFrame,
    scratch: Scratch,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
) -> DataFrame:
    """All rows with ``__size``, ``__source_size``, ``__target`` and ``__copies``.

    A source's rate is its target over its size; each of its documents is
    taken floor(rate) times and once more where its own hash falls below the
    fraction. Needs ``doc_id``, ``text`` and ``source``; other columns pass
    through. A null text has size 0, a null source is a source of its own, a
    source without words has target and rate 0. Rows equal in id and text are
    taken alike. An empty table stays empty. Sources' targets are a saved
    table, one row a source, so Spark chooses the join by its measured bytes
    and the texts are not shuffled while it is small.
    """
    check_columns(docs, ["doc_id", "text", "source"])
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    targets = scratch.save(source_targets(sizes, weights, share, most), "targets").withColumnsRenamed(
        {"source": "__source", "source_size": "__source_size", "target": "__target"}
    )
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(0.0)
    extra = uniform(seed, F.col("doc_id"), F.col("text")) < F.col("__rate") - F.floor("__rate")
    return (
        docs.withColumn("__size", word_count(F.col("text")))
        .join(targets, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("__rate", rate)
        .withColumn("__copies", (F.floor("__rate") + extra.cast("long")).cast("long"))
        .drop("__source", "__rate")
    )


def repeated(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: every row as often as it is taken."""
    return (
        mixed.filter(F.col("__copies") > 0)
        .withColumn("__copy", F.explode(F.expr("sequence(1L, __copies)")))
        .select(*[col(c) for c in columns])
    )


def mix_sql(weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7) -> str:
    """DuckDB SQL for the digest of :func:`mix` over ``documents``."""
    return f"""
WITH sized AS (
  SELECT doc_id, text, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
placed AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS place FROM per),
weighed AS (
  SELECT *, [{", ".join(map(str, weights))}][1 + place % {len(weights)}] AS weight,
         source_size * {float(most)!r}::DOUBLE AS bound
  FROM placed),
levels AS (
  SELECT *,
    (CAST(sum(source_size) OVER () AS DOUBLE) * {float(share)!r}::DOUBLE
     - coalesce(sum(bound) OVER (ORDER BY bound / weight, place
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / CAST(sum(weight) OVER ()
           - coalesce(sum(weight) OVER (ORDER BY bound / weight, place
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
      AS level
  FROM weighed),
targets AS (
  SELECT source, source_size, least(bound, max(level) OVER () * weight) AS target FROM levels),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(s.doc_id AS VARCHAR), '') || ':'
                                 || coalesce(s.text, '')), 1, 13) AS BIGINT)
           / {float(1 << 52)!r}::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(floor(rate) + CAST(u < rate - floor(rate) AS BIGINT) AS BIGINT) * size AS taken
FROM rated"""
