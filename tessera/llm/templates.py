"""Line dedup with a log-template tree: lines of templates that recur across documents go.

A line's path in the tree is its number of tokens and its leading tokens; a
token with a digit is a variable field and stands as ``<*>``. The rest of the
line, masked alike, is its template in that leaf. Templates of one leaf that
agree in a given share of positions are one template: the other positions are
variable fields too. Fields say nothing about a passage, so two of them never
count as agreement, and a line with too few other tokens (a row of a table of
numbers) is taken literally: it recurs only where all of it does. Classes do not depend on the order of lines, so they are
the same however the data are dealt out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.blocks import block_pairs, runs
from tessera.llm.common import Scratch, check_columns, col, components, parts_for
from tessera.llm.simhash import forest

FIELD = "<*>"
_BLOCK_ROWS = 2_048
# Positions of templates that are compared at a time.
_POSITIONS = 1 << 20
# So many classes at most are told to every task; each has more than one of so many shares of all lines.
_HOT_CLASSES = 1_024
# Stands in a template's body for the hash of a field.
_FIELD_HASH = 0


@dataclass(frozen=True)
class Rules:
    """What makes a template and when it goes.

    ``depth`` leading tokens lead to a leaf. ``constant`` is the least share of
    tokens without digits in a line whose digits are variable fields; any other
    line stands for itself alone. ``similarity`` is the share of equal positions
    at which two templates of a leaf are one, among those that are not a field
    in both. Templates found
    in fewer than ``min_docs`` documents are kept, however short or long; lines
    of fewer than ``min_tokens`` tokens, which are the blank ones, have none.
    """

    depth: int = 3
    similarity: float = 0.8
    constant: float = 0.5
    min_tokens: int = 1
    min_docs: int = 2


def document_key() -> Column:
    """Rows equal in id and text are one document."""
    return F.xxhash64("doc_id", "text")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _path(line: Column, rules: Rules, with_body: bool = False) -> Column:
    """``struct<leaf, template>`` of a line, and the body's token hashes if asked for; null if it has none.

    Tokens with digits are fields if enough others are left. A leaf is tokens
    and leading tokens; of a line that merges with no other, all of it. Those
    are literal lines, and lines so short that one other token is too many.
    """
    digit = r"[0-9]"

    def masked(t: Column) -> Column:
        return F.when(line.rlike(digit), F.transform(t, lambda x: F.when(x.rlike(digit), F.lit(FIELD)).otherwise(x))).otherwise(t)

    def placed(t: Column, m: Column) -> Column:
        n = F.size(m)
        literal = F.size(F.filter(m, lambda x: x == FIELD)) > n * F.lit(1 - rules.constant)
        alone = literal | (n - 1 < n * F.lit(rules.similarity))
        depth = F.when(alone, F.greatest(n, F.lit(rules.depth))).otherwise(F.lit(rules.depth))
        return _let(
            F.when(literal, t).otherwise(m),
            lambda k: _let(F.xxhash64(n, F.slice(k, F.lit(1), depth)), lambda leaf: F.struct(*named(k, leaf))),
        )

    def named(k: Column, leaf: Column) -> list[Column]:
        body = F.transform(k, lambda x: F.when(x == FIELD, F.lit(_FIELD_HASH)).otherwise(F.hash(x)))
        return [leaf.alias("leaf"), F.xxhash64(leaf, k).alias("template"), *([body.alias("body")] if with_body else [])]

    tokens = F.filter(F.split(line, r"\s+"), lambda x: x != "")
    enough = line.rlike(rf"\S(?:\S*\s+\S){{{max(rules.min_tokens, 1) - 1}}}")
    return F.when(enough, _let(tokens, lambda t: _let(masked(t), lambda m: placed(t, m))))


def _lines(docs: DataFrame, rules: Rules) -> DataFrame:
    """One row a line: its document, number, leaf and template.

    Paths are made below the explode: a projection above it would be copied
    into each of its uses.
    """
    paths = F.transform(F.split("text", "\n"), lambda line: _path(line, rules))
    return (
        docs.select("doc_id", document_key().alias("doc"), F.posexplode(paths).alias("number", "path"))
        .filter("path is not null")
        .select("doc_id", "doc", "number", "path.leaf", "path.template")
    )


def _merged(docs: DataFrame, lines: DataFrame, rules: Rules, scratch: Scratch) -> DataFrame:
    """``(node, root)`` of the templates that agree with another of their leaf."""
    found = lines.groupBy("leaf", "template").agg(F.min(F.struct("doc", "number")).alias("at"))
    shared = found.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("leaf")
    chosen = scratch.save(found.join(shared, "leaf").select("leaf", "template", "at.*"), "leaves")
    wanted = chosen.groupBy("doc").agg(F.collect_set("number").alias("numbers")).withColumnRenamed("doc", "__doc")
    whole = docs.select("doc_id", "text").withColumn("__key", document_key())
    # Texts are dealt by document at every size: a plan that broadcasts the
    # wanted numbers while they are few would turn into another one later.
    own = (
        whole.join(wanted.hint("merge"), F.col("__key") == F.col("__doc"))
        .withColumn("__lines", F.split("text", "\n"))
        .select(
            "__key",
            F.explode("numbers").alias("number"),
            F.col("__lines"),
        )
        .select("__key", "number", F.col("__lines")[F.col("number")].alias("line"))
    )
    bodies = scratch.save(
        own.select(F.explode(F.array(_path(F.col("line"), rules, with_body=True))).alias("path"))
        .select("path.leaf", "path.template", "path.body")
        .dropDuplicates(["leaf", "template"]),
        "bodies",
    )
    units = ["segment", "__left", "__right"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, units):
            a, b = _similar(table.combine_chunks(), units, rules.similarity)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    # Segments are grouped without bodies; those go to templates that share one.
    named = bodies.select("template", F.explode(_segments(F.col("leaf"), F.col("body"), rules)).alias("segment"))
    whole_bodies = bodies.select(F.col("template").alias("__template"), "body")
    edges = (
        block_pairs(named, "segment", "template", _BLOCK_ROWS)
        .join(whole_bodies.hint("merge"), F.col("template") == F.col("__template"))
        .drop("__template")
        .repartition(parts_for(docs.sparkSession), *units)
        .sortWithinPartitions(*units)
        .mapInArrow(run, "a long, b long")
    )
    return components(edges, scratch)


def _segments(leaf: Column, body: Column, rules: Rules) -> Column:
    """Hashes of the segments that a body's positions after the leading tokens are cut into.

    Templates that are one differ in at most ``1 - similarity`` of all
    positions. With one segment more than that number, a segment of both is
    equal whole, so only templates that share a segment need to be compared.
    """
    width = F.size(body)
    # Rounded up where the product is short of a whole number: a segment too many loses nothing.
    pieces = F.floor(width * F.lit(1 - rules.similarity) + F.lit(1e-9)).cast("int") + 1
    rest = F.greatest(width - rules.depth, F.lit(0))
    start = lambda i: F.floor(i.cast("long") * rest / pieces).cast("int")
    return F.transform(
        F.sequence(F.lit(0), pieces - 1),
        lambda i: F.xxhash64(leaf, i, F.slice(body, start(i) + rules.depth + 1, start(i + 1) - start(i))),
    )


def _similar(table: pa.Table, units: list[str], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the templates of a unit with enough equal positions; fields equal nothing.

    Pairs of all units are compared together: each row with the next of its
    unit, then with the next but one, and so on while its unit has rows left.
    """
    names, side = table["template"].to_numpy(), table["__side"].to_numpy()
    body = table["body"].combine_chunks()
    flat, offsets = body.values.to_numpy(), body.offsets.to_numpy().astype(np.int64)
    fresh = np.zeros(len(names), bool)
    for key in units:
        values = table[key].to_numpy()
        fresh[1:] |= values[1:] != values[:-1]
    unit = np.cumsum(fresh)
    across = np.bincount(unit, weights=side)[unit] > 0
    a = b = np.array([], np.int64)
    rows, step = np.arange(len(names)), 1
    while True:
        rows = rows[rows + step < len(names)]
        rows = rows[unit[rows] == unit[rows + step]]
        if not len(rows):
            return forest(a, b)
        wanted = rows[~across[rows] | (side[rows] != side[rows + step])]
        # Few enough positions at a time, however long the lines are.
        ends = np.cumsum(offsets[wanted + 1] - offsets[wanted])
        for i in np.split(wanted, np.flatnonzero(np.diff(ends // _POSITIONS)) + 1):
            if not len(i):
                continue
            width = offsets[i + 1] - offsets[i]
            begin = np.cumsum(width) - width
            place = np.arange(width.sum()) - np.repeat(begin, width)
            x, y = flat[np.repeat(offsets[i], width) + place], flat[np.repeat(offsets[i + step], width) + place]
            equal, field = x == y, x == _FIELD_HASH
            both = np.add.reduceat(equal & field, begin, dtype=np.int64)
            same = np.add.reduceat(equal & ~field, begin, dtype=np.int64)
            hit = i[same >= similarity * (width - both)]
            a, b = np.append(a, names[hit]), np.append(b, names[hit + step])
            if len(a) > _POSITIONS:
                a, b = forest(a, b)
        step += 1


def recurring_lines(docs: DataFrame, scratch: Scratch, rules: Rules = Rules()) -> DataFrame:
    """``(doc, numbers, n_recurring)``: the lines of each document that are to go.

    A template (class) found in ``min_docs`` documents or more is kept in the
    one with the least (id, text hash) and goes from all others. Documents
    without such lines have no row. Lines of a class that holds more than one in
    1,024 of all lines meet their keeper by broadcast; there are fewer than
    1,024 such classes at any size.
    """
    check_columns(docs, ["doc_id", "text"])
    lines = scratch.save(_lines(docs, rules), "lines")
    merged = scratch.save(_merged(docs, lines, rules, scratch), "merged").select(
        F.col("node").alias("__node"), F.col("root").alias("__root")
    )
    classed = scratch.save(
        lines.join(merged, F.col("template") == F.col("__node"), "left").select(
            "doc_id", "doc", "number", F.coalesce("__root", "template").alias("class")
        ),
        "classed",
    )
    per_doc = classed.groupBy("class", "doc").agg(F.min("doc_id").alias("doc_id"))
    recurring = scratch.save(
        per_doc.groupBy("class")
        .agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("doc_id", "doc")).alias("keeper"))
        .filter(F.col("docs") >= rules.min_docs)
        .select("class", "docs", F.col("keeper.doc").alias("keeper")),
        "recurring",
    )
    # At most _HOT_CLASSES classes can hold this share of all lines, so they fit a broadcast.
    share = F.lit(max(1, lines.count() // _HOT_CLASSES))
    hot = recurring.filter(F.col("docs") > share).select(F.col("class").alias("__hot"), F.col("keeper").alias("__of_hot"))
    cold = recurring.filter(F.col("docs") <= share).select(
        F.col("class").alias("__class"), F.lit(-1).alias("__none"), F.col("keeper").alias("__of_cold")
    )
    # Lines of hot classes have found their keeper and are dealt by document beside the rest.
    spread = F.when(F.col("__hot").isNotNull(), F.pmod(F.col("doc"), F.lit(_HOT_CLASSES)).cast("int")).otherwise(-1)
    return (
        classed.join(F.broadcast(hot), F.col("class") == F.col("__hot"), "left")
        .withColumn("__spread", spread)
        .join(cold, (F.col("class") == F.col("__class")) & (F.col("__spread") == F.col("__none")), "left")
        .filter(F.col("doc") != F.coalesce("__of_hot", "__of_cold"))
        .groupBy("doc")
        .agg(F.sort_array(F.collect_set("number")).alias("numbers"))
    )


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, numbers: pd.Series) -> pd.Series:
    def one(text: str | None, drop) -> str | None:
        if text is None or drop is None or not len(drop):
            return text
        gone = set(drop)
        return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)

    return pd.Series([one(t, n) for t, n in zip(texts, numbers)], dtype=object)


def drop_recurring_lines(docs: DataFrame, scratch: Scratch, rules: Rules = Rules()) -> DataFrame:
    """All rows, with ``text`` freed of recurring lines and their number in ``n_dropped``.

    Needs ``doc_id`` and ``text``; all other columns pass through. A null text
    stays null, an empty one empty. Rows equal in id and text are one document
    and are treated alike; null ids are allowed. An empty table stays empty.
    Texts are shuffled by document, never by line or template; lines are
    counted from hashes, so a template that a third of all lines have is a
    partial count, and is told to its lines by broadcast.
    """
    drops = scratch.save(recurring_lines(docs, scratch, rules), "drops").withColumnsRenamed(
        {"doc": "__doc", "numbers": "__numbers"}
    )
    columns = [col(c) for c in docs.columns if c not in ("text", "n_dropped")]
    return (
        docs.withColumn("__key", document_key())
        .join(drops.hint("merge"), F.col("__key") == F.col("__doc"), "left")
        .select(
            *columns,
            _without("text", "__numbers").alias("text"),
            F.coalesce(F.size("__numbers"), F.lit(0)).alias("n_dropped"),
        )
    )
