"""Secret scans with corpus-wide ownership: DataFrame functions only.

Candidates are found in every whole text with their places. The hash of each
candidate's value is then counted over the corpus by distinct documents
(repositories) and distinct sources (owners). A value that many owners have is
a copied example; one that a single owner has is live-looking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, check_columns, col

# The base kinds in their order, with their patterns, the group
# that is the secret's value and the least length of that group.
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
VALUE_GROUP = {"assign": 2, "access": 0, "hex": 0}
LEAST = {"assign": 6, "access": 20, "hex": 24}
# Matches at least as long as this are all that the scan has to look for; a
# shorter run of the same letters can never hold one.
_ONLY_LONG = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}

# The method's own kind: long tokens of letters and digits, outside base spans.
OWNED = "owned"
TOKEN = r"[A-Za-z0-9+/_-]{20,}"

SPAN = "array<struct<start:bigint,end:bigint,kind:string,value:string>>"
# Running values are found over stretches of this many elements.
STRETCH = 256


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, merge, levels: int = 2) -> Column:
    """``merge`` of each of the numbers with all before it; none of them may be below 0.

    A fold that lists its running values copies them once an element. Here it
    runs over short stretches, and what each has before it is found in the same
    way from the stretches' last values, so time grows with the length alone.
    """
    if levels == 1:
        return F.aggregate(
            values,
            F.expr("cast(array(0) as array<bigint>)"),
            lambda at, x: F.concat(at, F.array(merge(F.element_at(at, -1), x))),
            lambda at: F.slice(at, F.lit(2), F.size(at)),
        )

    def stretches(v: Column) -> Column:
        last = F.floor(F.greatest(F.size(v) - 1, F.lit(0)) / STRETCH).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last), lambda i: _running(F.slice(v, i * STRETCH + 1, F.lit(STRETCH)), merge, 1)
        )

    def carried(runs: Column) -> Column:
        lasts = F.transform(runs, lambda r: F.coalesce(F.try_element_at(r, F.lit(-1)), F.lit(0).cast("long")))
        before = F.concat(F.expr("cast(array(0) as array<bigint>)"), _running(lasts, merge, levels - 1))
        return _let(
            before,
            lambda b: F.flatten(F.transform(runs, lambda r, i: F.transform(r, lambda x: merge(b[i], x)))),
        )

    return _let(values, lambda v: _let(stretches(v), carried))


def _matches(text: Column, kind: str, pattern: str, group: int) -> Column:
    """All leftmost matches that do not overlap, with code point places.

    Splitting by the pattern gives the stretches between matches, one more than
    matches; running sums of both lengths are the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    between = F.split(text, pattern, -1)

    def place(parts: Column) -> Column:
        """Spans from (gap, match, value) triples and the running ends of their matches."""
        lengths = F.transform(parts, lambda p: (F.length(p["gap"]) + F.length(p["match"])).cast("long"))
        return _let(
            _running(lengths, lambda x, y: x + y),
            lambda at: F.transform(
                parts,
                lambda p, i: F.struct(
                    (at[i] - F.length(p["match"])).alias("start"),
                    at[i].alias("end"),
                    F.lit(kind).alias("kind"),
                    p["value"].alias("value"),
                ),
            ),
        )

    triples = F.filter(
        F.arrays_zip(between.alias("gap"), found.alias("match"), values.alias("value")),
        lambda p: p["match"].isNotNull(),
    )
    return _let(triples, place)


def _spans(text: Column, kind: str) -> Column:
    """Base spans of one kind; texts without a match cost one search."""
    pattern = _ONLY_LONG.get(kind, PATTERNS[kind])
    group, least = VALUE_GROUP[kind], LEAST[kind]
    kept = F.filter(_matches(text, kind, pattern, group), lambda s: F.length(s["value"]) >= least)
    return F.when(text.rlike(pattern), kept).otherwise(F.expr(f"cast(array() as {SPAN})"))


def _rank(kind: Column) -> Column:
    names = [*KINDS, OWNED]
    return F.array_position(F.array(*[F.lit(n) for n in names]), kind)


def _in_order(spans: Column) -> Column:
    """Spans by start, then kind as listed."""
    keyed = F.transform(
        spans, lambda s: F.struct(s["start"].alias("a"), _rank(s["kind"]).alias("b"), s["end"].alias("c"), s.alias("s"))
    )
    return F.transform(F.sort_array(keyed), lambda k: k["s"])


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def _outside(tokens: Column, base: Column) -> Column:
    """The tokens that no base span overlaps.

    Tokens by their ends and base spans by their starts are put in one order,
    a token before a span that starts where it ends. The furthest end among
    the spans before a token tells whether one reaches into it.
    """
    events = F.sort_array(
        F.concat(
            F.transform(
                base,
                lambda b: F.struct(
                    b["start"].alias("at"),
                    F.lit(1).alias("turn"),
                    b["end"].alias("reach"),
                    F.lit(None).cast(SPAN[len("array<") : -1]).alias("token"),
                ),
            ),
            F.transform(
                tokens,
                lambda t: F.struct(
                    t["end"].alias("at"), F.lit(0).alias("turn"), F.lit(0).cast("long").alias("reach"), t.alias("token")
                ),
            ),
        )
    )

    def kept(e: Column) -> Column:
        reach = _running(F.transform(e, lambda x: x["reach"]), F.greatest)
        judged = F.zip_with(e, reach, lambda x, r: F.struct(x["token"].alias("token"), r.alias("reach")))
        return F.transform(
            F.filter(judged, lambda j: j["token"].isNotNull() & (j["reach"] <= j["token"]["start"])),
            lambda j: j["token"],
        )

    return _let(events, kept)


def _candidates(text: Column, base: Column) -> Column:
    """Long mixed tokens outside all base spans."""
    mixed = F.filter(
        _matches(text, OWNED, TOKEN, 0), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")
    )
    return F.when(text.rlike(TOKEN), _outside(mixed, base)).otherwise(F.expr(f"cast(array() as {SPAN})"))


def scan(
    docs: DataFrame,
    scratch: Scratch,
    example_owners: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
) -> DataFrame:
    """``(doc_id, base, spans, n_examples, n_live)`` for every row.

    ``base`` and ``spans`` are arrays of ``(start, end, kind, value, owners,
    repositories)``. A value with ``example_owners`` owners or more is a widely
    copied example; one with a single owner is live-looking; between them it is
    neither. Base spans stay whatever their class; the tokens that the method
    adds are the live-looking ones. A null text is empty, a null owner is an
    owner of its own, rows with a null id are repositories told apart by text,
    rows equal in id and text are one repository and get one row each. An empty
    table gives no rows. A text's time grows with its length, whatever number of
    matches it has. Values are counted as hashes: a value that a third of
    all rows hold is pre-aggregated by (value, owner, repository) before any
    task sees it whole.
    """
    check_columns(docs, [id_col, text_col, owner_col])
    plain = docs.select(
        col(id_col).alias("doc_id"),
        F.coalesce(col(text_col), F.lit("")).alias("text"),
        F.coalesce(F.concat(F.lit("="), col(owner_col)), F.lit("")).alias("owner"),
    )
    found = scratch.save(
        plain.withColumn("base", F.concat(*[_spans(F.col("text"), k) for k in KINDS]))
        .withColumn("more", _candidates(F.col("text"), F.col("base")))
        .select("doc_id", "owner", F.xxhash64("doc_id", "text").alias("repository"), "base", "more"),
        "found",
    )
    each = (
        found.filter((F.size("base") > 0) | (F.size("more") > 0))
        .select("doc_id", "owner", "repository", F.explode(F.concat("base", "more")).alias("s"))
        .select("doc_id", "owner", "repository", "s", F.sha2("s.value", 256).alias("hash"))
    )
    owned = (
        each.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
        .groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))
        .withColumnRenamed("hash", "__hash")
    )
    span = F.struct("s.start", "s.end", "s.kind", "s.value", "owners", "repositories")
    judged = (
        each.dropDuplicates(["doc_id", "repository", "s"])
        .join(owned, F.col("hash") == F.col("__hash"))
        .filter((F.col("s.kind") != OWNED) | (F.col("owners") == 1))
        .groupBy(F.col("doc_id").alias("__id"), F.col("repository").alias("__repository"))
        .agg(
            _in_order(F.collect_list(span)).alias("spans"),
            F.count_if(F.col("owners") >= example_owners).alias("n_examples"),
            F.count_if(F.col("owners") == 1).alias("n_live"),
        )
    )
    empty = F.expr(
        "cast(array() as array<struct<start:bigint,end:bigint,kind:string,value:string,owners:bigint,repositories:bigint>>)"
    )
    return (
        found.select("doc_id", "repository")
        .join(judged, (F.col("repository") == F.col("__repository")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left")
        .select(
            "doc_id",
            F.coalesce(F.filter("spans", lambda s: s["kind"] != OWNED), empty).alias("base"),
            F.coalesce("spans", empty).alias("spans"),
            F.coalesce("n_examples", F.lit(0)).alias("n_examples"),
            F.coalesce("n_live", F.lit(0)).alias("n_live"),
        )
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
