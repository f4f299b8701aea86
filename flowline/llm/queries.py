"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.llm import bpe, counting, decontaminate, frames, htmltext, periodic, piecebpe, pseudolikelihood, quality
from flowline.llm import simhash, sketches, toxicity, whitening
from flowline.llm.tables import table
from flowline.llm.units import read_definition
from flowline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Token limit of op7's over_limit.
CONTEXT_TOKENS = 1024


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def byte_bpe_definition() -> str:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.tokenizer_definition(ranks, public_tokenizers.PATTERN)


def token_digests(encoded: DataFrame) -> DataFrame:
    """Digests of the ids and decoded bytes that :func:`bpe.round_trip` gives."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "n_split",
    )


@query
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return htmltext.extract(pages, htmltext.fit(pages))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    written = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", written.alias("fingerprint"), "component_id")


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(bpe.round_trip(table(spark, sf_dir, "documents"), byte_bpe_definition()))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return toxicity.score(documents, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return sketches.compare_with_edits(table(spark, sf_dir, "documents"), parts)


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = read_definition(public_tokenizers.path("byte_bpe_50k.json"))
    counted = counting.count_tokens(table(spark, sf_dir, "documents"), definition)
    return counted.withColumn("over_limit", F.col("n_tokens") > CONTEXT_TOKENS)


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = quality.score(documents, quality.fit(documents))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = read_definition(public_tokenizers.path("word_bpe_49k.json"))
    folder = scratch_path(spark, "token-files")
    n_files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frames.write_token_files(table(spark, sf_dir, "documents"), folder, definition, end_id=2, n_files=n_files)
    found = frames.read_token_files(spark, folder)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudolikelihood.score(table(spark, sf_dir, "documents"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(table(spark, sf_dir, "documents"), periodic.planted_period)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    # The greatest length; of several the smallest start, then the smallest period.
    rated = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    return found.withColumn("best", F.array_max(rated)).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piecebpe.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    found = piecebpe.round_trip(table(spark, sf_dir, "documents"), model)
    return found.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    error = whitening.identity_error(vectors, model)
    return whitening.transform(vectors, model).withColumn("identity_error", F.lit(error))
