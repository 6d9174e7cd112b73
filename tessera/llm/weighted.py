"""Document fingerprints by consistent weighted sampling: DataFrame functions only.

A document's terms are its words, weighted by how often they occur. For each
sample and term, hashes give r and c of a Gamma(2, 1) law and a uniform b. A
term of weight w is quantised at t = floor(ln w / r + b) and ranked by
ln c - r (t + 1 - b); the least rank is the sample, known by its term and t.
Two documents share a sample with the probability of their generalised
Jaccard similarity: the sum of least weights over the sum of greatest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, check_columns, col

SAMPLES = 32
# Bits of a sample that tell terms apart; the 40 bits above hold the rank.
_TERM_BITS = 22
_RANK_SCALE = float(1 << 33)
_RANK_SHIFT = 80.0
_UNIT = float(1 << 21)
WORDS = r"[\x20\x09-\x0D]+"
# Hashes of a term are those of its exclusive or with a constant for each sample.
_SALT = 0x9E3779B97F4A7C15
# A document without words has this one term.
NO_WORD = 0


def _salted(term: Column, n: int) -> Column:
    salt = (n + 1) * _SALT & ((1 << 63) - 1)
    return F.xxhash64(term.bitwiseXOR(F.lit(salt)))


def _uniform(bits: Column, at: int) -> Column:
    """A number in (0, 1) from 21 bits of a hash."""
    part = F.shiftright(bits, at) if at else bits
    return (part.bitwiseAND((1 << 21) - 1) + F.lit(0.5)) / F.lit(_UNIT)


def _sample(term: Column, log_weight: Column, number: int) -> Column:
    """A long that orders terms by rank and then names (term, t): its minimum is the sample."""
    one, two = _salted(term, 2 * number), _salted(term, 2 * number + 1)
    r = -F.log(_uniform(one, 0) * _uniform(one, 21))
    b = _uniform(one, 42)
    t = F.floor(log_weight / r + b)
    rank = F.log(-F.log(_uniform(two, 0) * _uniform(two, 21))) - r * (t + F.lit(1.0) - b)
    # ln c lies between -15 and 4 and r (t + 1 - b) between 0 and ln w + 31, so
    # the shifted rank is positive and below 84: 40 bits hold it.
    level = ((rank + F.lit(_RANK_SHIFT)) * F.lit(_RANK_SCALE)).cast("long")
    name = F.shiftright(two, 42).bitwiseXOR(t).bitwiseAND((1 << _TERM_BITS) - 1)
    return F.shiftleft(level, _TERM_BITS).bitwiseOR(name)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def weighted_terms(text: Column) -> Column:
    """``array<struct<term bigint, weight bigint>>`` of a text's words, from runs of their sorted hashes."""
    words = F.filter(F.split(text, WORDS), lambda w: w != "")
    hashes = F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))

    def run_starts(h: Column) -> Column:
        index = F.when(F.size(h) > 0, F.sequence(F.lit(0), F.size(h) - 1)).otherwise(F.expr("cast(array() as array<int>)"))
        return F.filter(index, lambda i: (i == 0) | (h[i] != h[F.greatest(i - 1, F.lit(0))]))

    def counted(h: Column) -> Column:
        return _let(
            run_starts(h),
            lambda s: F.transform(
                s,
                lambda at, k: F.struct(
                    h[at].alias("term"),
                    (F.coalesce(F.get(s, k + 1), F.size(h)) - at).cast("long").alias("weight"),
                ),
            ),
        )

    return _let(hashes, counted)


def signatures(rows: DataFrame, keys: list[str], text_col: str, samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``signature array<bigint>``: one row for each distinct ``keys``.

    ``keys`` decide the text: rows that agree in them must agree in it, and
    such repeated rows give one. A null or wordless text has the one term
    ``NO_WORD``. A row is split, counted and exploded where it is read; samples
    are partial minima, so each task sends one row of ``samples`` longs for a
    document.
    """
    check_columns(rows, [*keys, text_col])
    own = [col(k) for k in keys]
    none = F.array(F.struct(F.lit(NO_WORD).cast("long").alias("term"), F.lit(1).cast("long").alias("weight")))
    found = _let(
        weighted_terms(F.coalesce(col(text_col), F.lit(""))), lambda t: F.when(F.size(t) > 0, t).otherwise(none)
    )
    terms = rows.select(*own, F.explode(found).alias("t"))
    flat = terms.select(*own, F.col("t.term").alias("term"), F.log(F.col("t.weight").cast("double")).alias("lw"))
    least = flat.groupBy(*own).agg(
        *[F.min(_sample(F.col("term"), F.col("lw"), n)).alias(f"s{n}") for n in range(samples)]
    )
    return least.select(*own, F.array(*[F.col(f"s{n}") for n in range(samples)]).alias("signature"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples: an unbiased estimate of generalised Jaccard."""
    same = F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: p["a"] == p["b"]))
    return same / F.size(a).cast("double")


def as_text(signature: Column) -> Column:
    """Sixteen lowercase hex digits a sample, in order."""
    return F.array_join(F.transform(signature, lambda s: F.lower(F.lpad(F.hex(s), 16, "0"))), "")


def _bucket(value: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` are at most ``value``, by two short scans."""
    width = max(1, int(len(bounds) ** 0.5))
    chunks = [bounds[at : at + width] for at in range(0, len(bounds), width)]
    if not chunks:
        return F.lit(0)
    firsts = F.array(*[F.lit(c[0]) for c in chunks])
    upto = F.size(F.filter(firsts, lambda b: b <= value))
    lists = F.array(*[F.array(*[F.lit(x) for x in c]) for c in chunks])
    inside = F.size(F.filter(F.get(lists, upto - 1), lambda b: b <= value))
    return F.when(upto > 0, (upto - 1) * width + inside).otherwise(0)


def with_next(docs: DataFrame, parts: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row beside the next one by ascending id; after the last comes the first.

    Returns ``(bucket, place, doc_id, text, next_id, next_text)``. Null ids come
    first, rows that repeat an id in the order of their text's hash; null texts
    are empty. Rows are dealt once, by ranges of ids between sampled
    percentiles, and every range gets a copy of the first row after it, so the
    window over a range sees all it needs. One id a range reaches the driver.
    """
    rows = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    steps = [k / parts for k in range(1, parts)] or [0.5]
    cut = rows.agg(F.percentile_approx("doc_id", steps, 10_000).alias("cut")).first()["cut"] or []
    rows = rows.withColumn("bucket", F.coalesce(_bucket(F.col("doc_id"), sorted(set(cut))), F.lit(0)))
    held = (
        rows.groupBy("bucket")
        .agg(F.min("doc_id").alias("least"), F.count_if(F.col("doc_id").isNull()).alias("nulls"))
        .orderBy("bucket")
        .collect()
    )
    first_id = [None if r["nulls"] else r["least"] for r in held]
    before = {held[k]["bucket"]: held[k - 1]["bucket"] for k in range(len(held))}
    known = [i for i in first_id if i is not None]
    is_first = F.col("doc_id").isin(known) if known else F.lit(False)
    is_first = F.coalesce(is_first, F.lit(False)) | (F.col("doc_id").isNull() if None in first_id else F.lit(False))
    previous = F.lit([before.get(b, 0) for b in range(max(before, default=0) + 1)])
    copies = rows.filter(is_first).withColumn("bucket", previous[F.col("bucket")])
    order = Window.partitionBy("bucket").orderBy("__copy", "doc_id", F.xxhash64("text"))
    return (
        rows.withColumn("__copy", F.lit(0))
        .unionByName(copies.withColumn("__copy", F.lit(1)))
        .withColumns(
            {
                "place": F.row_number().over(order),
                "next_id": F.lead("doc_id").over(order),
                "next_text": F.lead("text").over(order),
            }
        )
        .filter("__copy = 0")
        .select("bucket", "place", "doc_id", "text", "next_id", "next_text")
    )


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last floor(n / 4) code points replaced by the first as many of ``following``."""
    n = F.length(text)
    cut = F.floor(n / 4).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - cut), F.substr(following, F.lit(1), cut))


def fingerprint_pairs(docs: DataFrame, parts: int, scratch: Scratch, samples: int = SAMPLES) -> DataFrame:
    """Signatures of every text and of its edited text, and of the text after it.

    ``(doc_id, n_chars, edited_sha256, signature, edited_signature,
    next_signature)``, one row for each row of ``docs``; see :func:`with_next`
    for nulls, repeats and the order. An empty table gives no rows.
    """
    both = (
        with_next(docs, parts)
        .withColumn("changed", edited(F.col("text"), F.col("next_text")))
        .select(
            "bucket",
            "place",
            "doc_id",
            F.length("text").cast("long").alias("n_chars"),
            F.xxhash64("text").alias("hash"),
            "next_id",
            F.xxhash64("next_text").alias("next_hash"),
            F.sha2(F.col("changed").cast("binary"), 256).alias("edited_sha256"),
            F.explode(
                F.array(
                    F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("body")),
                    F.struct(F.lit(True).alias("is_edited"), F.col("changed").alias("body")),
                )
            ).alias("v"),
        )
        .select("*", "v.is_edited", "v.body")
        .drop("v")
    )
    keys = [c for c in both.columns if c != "body"]
    saved = scratch.save(signatures(both, keys, "body", samples), "signatures")
    own = saved.filter(~F.col("is_edited"))
    other = saved.filter("is_edited").select(
        col("bucket").alias("__b"), col("place").alias("__p"), col("signature").alias("edited_signature")
    )
    following = own.dropDuplicates(["doc_id", "hash"]).select(
        col("doc_id").alias("__id"), col("hash").alias("__hash"), col("signature").alias("next_signature")
    )
    return (
        own.join(other, (F.col("bucket") == F.col("__b")) & (F.col("place") == F.col("__p")))
        .join(following, F.col("next_id").eqNullSafe(F.col("__id")) & (F.col("next_hash") == F.col("__hash")))
        .select("doc_id", "n_chars", "edited_sha256", "signature", "edited_signature", "next_signature")
    )
