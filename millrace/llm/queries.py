"""One query for each operator over its whole table, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    alignment,
    collision,
    extraction,
    langid,
    minhash,
    mixing,
    oracles,
    packing,
    quality,
    resampling,
    rules,
    sharding,
    tokenfiles,
    tokens,
    vafile,
)
from millrace.llm.common import load
from millrace.session import Workspace

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return minhash.near_duplicates(docs, Workspace(spark, "op1"), percent=85)


@query
def op2_shard_minimax(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    placed = sharding.shard_by_bytes(docs, Workspace(spark, "op2"), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, Workspace(spark, "op3"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_pack_first_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    definition = tokens.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.cut_documents(docs, definition, with_ids=False)
    packed = packing.pack(pieces, groups=packing.group_count(docs.count()))
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query
def op5_nearest_by_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision.nearest(load(spark, sf_dir, "embeddings"), Workspace(spark, "op5"), every=20, k=20)


@query
def op6_extract_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(load(spark, sf_dir, "pages"))


@query
def op7_quality_by_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = quality.train(docs, load(spark, sf_dir, "labels"))
    return quality.classify(docs, model)


@query
def op8_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return langid.classify(docs, langid.train(docs))


@query
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.exact_top_k(load(spark, sf_dir, "embeddings"), Workspace(spark, "op9"), every=100, k=10)


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    work = Workspace(spark, "op10")
    definition = tokens.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    tokenfiles.write_tokens(docs, work.path("tokens"), definition, work, end_id=1)
    found = tokenfiles.read_tokens(spark, work.path("tokens"), with_ids=False)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op11_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    judged = rules.apply_rules(docs, labels, Workspace(spark, "op11"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")
    return resampling.resample(docs, target, Workspace(spark, "op12"))


@query
def op13_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    definition = tokens.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    model = alignment.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.align_tokens(docs, definition, model, Workspace(spark, "op13"))


ORACLES |= {
    "op1_minhash_near_duplicates": oracles.NEAR_DUPLICATES,
    "op3_mix_sources": oracles.MIXTURE,
    "op6_extract_main_text": oracles.MAIN_TEXT,
    "op9_exact_top_k": oracles.EXACT_TOP_K,
    "op11_risk_controlled_rules": oracles.RISK_RULES,
    "op12_importance_resampling": oracles.RESAMPLING,
}
