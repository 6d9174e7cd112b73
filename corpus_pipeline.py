"""Five stages from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows the stage
before it kept; its result is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import mixing, packing, queries, simhash, templates
from tessera.llm.common import Scratch, ship_package, temporary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Fitted dictionaries, near-duplicate links and packing are beyond SQL.
ORACLE_SQL: str | None = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on ``labels``, does not reject."""
    ship_package(spark)
    scored = queries.quality_scores(spark, docs.select(*COLUMNS), sf_dir)
    return scored.filter(F.col("score") >= queries.QUALITY_THRESHOLD).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines whose template an earlier document holds."""
    ship_package(spark)
    freed = templates.drop_recurring_lines(docs.select(*COLUMNS), Scratch(spark, "lines"))
    return freed.withColumn(
        "n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    ).select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class of linked fingerprints."""
    ship_package(spark)
    return simhash.keep_one(
        docs.select(*COLUMNS), Scratch(spark, "simhash"), queries.SIMHASH_SHINGLE, queries.SIMHASH_BITS
    )


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's rate takes it."""
    ship_package(spark)
    return mixing.repeated(mixing.mix(docs.select(*COLUMNS), Scratch(spark, "mixing")), COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix with the sequence and offset that each is packed at."""
    ship_package(spark)
    pieces = packing.token_pieces(docs, queries.tokenizer_path(), queries.MAX_TOKENS, queries.END_ID)
    return packing.pack(pieces, queries.MAX_TOKENS, Scratch(spark, "packing"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each written and read again.

    Of the tables in the shared folder, those of the last two stages are left:
    the result reads them.
    """
    scratch = Scratch(spark, "pipeline")
    docs = queries.table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        with temporary():  # a stage's own tables go once its result is written
            kept = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        if before is not None:
            scratch.drop(before)
        docs = before = kept
    return STAGES[-1][1](spark, docs, sf_dir)
