"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import alignment, collisions, collocations, language, mixing, order, packing, quality, secrets, sharding, simhash, templates, weighted
from tessera.llm.common import Scratch, parts_for, ship_package

END_ID = 1
MAX_TOKENS = 4096
ORDER_KEY = 20_240_601
QUALITY_THRESHOLD = 0.3
SHARDS = 16
COSINE = 0.95
SIMHASH_SHINGLE = 3
SIMHASH_BITS = 2
PHRASE_COUNT = 100
PHRASES = 2000
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def registered(query: Callable[[SparkSession, str], DataFrame]):
    """The workers of a registered query get this package first."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of ``documents`` with its slot, shard and byte offset; shards are written."""
    docs = table(spark, sf_dir, "documents")
    return order.training_order(
        docs, tokenizer_path(), END_ID, ORDER_KEY, Scratch(spark, "order")
    ).sequences


def op2_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = collisions.near_duplicates(table(spark, sf_dir, "embeddings"), Scratch(spark, "collisions"), COSINE)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the number of lines dropped and what is left of its text."""
    out = templates.drop_recurring_lines(table(spark, sf_dir, "documents"), Scratch(spark, "lines"))
    return out.select(
        "doc_id",
        F.col("n_dropped").cast("long").alias("n_dropped"),
        F.length("text").cast("long").alias("n_chars_kept"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


def quality_scores(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns of ``docs`` and ``score``, learnt from the labels."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.withColumn("score", model.score_column(F.col("text")))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_scores(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), sf_dir)
    return scored.select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        quality.predicted(F.col("score"), QUALITY_THRESHOLD).alias("predicted"),
    )


def op5_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), Scratch(spark, "sharding"), SHARDS)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, tokenizer_path(), MAX_TOKENS, END_ID)
    return packing.pack(pieces, MAX_TOKENS, Scratch(spark, "packing"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), Scratch(spark, "mixing"))
    return mixed.select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__copies") * F.col("__size")).alias("taken"),
    )


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(
        table(spark, sf_dir, "documents"), Scratch(spark, "simhash"), SIMHASH_SHINGLE, SIMHASH_BITS
    )
    return classes.select("doc_id", simhash.fp_hex("fp").alias("fingerprint"), "component_id")


def op9_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = weighted.fingerprint_pairs(
        table(spark, sf_dir, "documents"), parts_for(spark), Scratch(spark, "weighted")
    )
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        weighted.as_text(F.col("signature")).alias("fingerprint"),
        weighted.as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        weighted.likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        weighted.likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), Scratch(spark, "secrets"))
    return found.select(
        "doc_id",
        *[secrets.count_kind(F.col("base"), k).alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(secrets.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
        "n_examples",
        "n_live",
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [tokenizer_path(name) for name in ALIGNED]
    aligned = alignment.align(table(spark, sf_dir, "documents"), *paths, Scratch(spark, "alignment"))
    counts = alignment.document_counts(aligned, alignment.pair_counts(aligned, alignment.Aligner(*paths).size_b))
    digests = aligned.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256)).alias("groups_sha256"),
        "block",
        "place",
    )
    return digests.join(counts, ["block", "place"]).drop("block", "place")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return collocations.collocations(docs, Scratch(spark, "collocations"), PHRASE_COUNT, PHRASES)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: registered(query)
    for query in (
        op1_training_order,
        op2_collision_counting,
        op3_line_dedup,
        op4_quality_classifier,
        op5_sampled_splitters,
        op6_best_fit_packing,
        op7_source_mixing,
        op8_simhash_near_dedup,
        op9_weighted_sampling,
        op10_secret_scan,
        op11_token_alignment,
        op12_collocations,
        op13_language_id,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op7_source_mixing": mixing.mix_sql(),
    "op12_collocations": collocations.collocations_sql(PHRASE_COUNT, PHRASES),
}
