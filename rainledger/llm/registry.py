"""The operators' queries with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

import os
import tempfile
import zipfile

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    licences,
    merkle,
    packing,
    parity_join,
    perplexity,
    segment_bpe,
    sharding,
    suffix_array,
    suffix_automaton,
    topk,
    warc,
    whitening,
    word_bpe,
)

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to Python workers that would not find it: once a session."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    app = spark.sparkContext.applicationId
    if app in _shipped or home in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _shipped.add(app)
    path = os.path.join(tempfile.mkdtemp(prefix="rainledger-ship-"), "rainledger.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(os.path.join(home, "rainledger")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, home))
    spark.sparkContext.addPyFile(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_automaton.remove_repeated_words(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_stratified_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return sharding.shard_documents(narrow, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = word_bpe.encode_and_decode(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_partners(read(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op6_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.similar_components(read(spark, sf_dir, "documents"))


def op7_licence_sentence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(read(spark, sf_dir, "documents"))


def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derive_records(read(spark, sf_dir, "pages"))
    return records.withColumn("header_sha256", F.sha2("header", 256)).drop("header", "block")


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_array.remove_repeated_bytes(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_ngram_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.rate_documents(read(spark, sf_dir, "documents"))


def op11_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


def op12_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    done = segment_bpe.encode_and_decode(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return done.select(
        "doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_substring_dedup,
        op3_stratified_sharding,
        op4_bpe_round_trip,
        op5_exact_topk,
        op6_parity_sketch_join,
        op7_licence_sentence_rules,
        op8_warc_derivatives,
        op9_suffix_array_dedup,
        op10_ngram_perplexity,
        op11_bit_sliced_whitening,
        op12_segment_tree_bpe,
        op13_merkle_manifest,
    )
}
ORACLES: dict[str, str] = {
    "op7_licence_sentence_rules": licences.sql(),
    "op8_warc_derivatives": warc.sql(),
}
