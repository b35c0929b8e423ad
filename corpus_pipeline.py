"""From raw documents to packed token sequences: quality rules, near duplicates, repeated passages, packing.

Each stage takes the documents that its predecessor kept, as written. ``run`` writes them to the shared folder too, so a lost
executor costs the current stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainledger.llm import packing, parity_join, perplexity, suffix_automaton
from rainledger.llm.registry import read
from rainledger.sinks.staging import stage, staging_scope


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return perplexity.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of similar ones."""
    return parity_join.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 13 words or more that an earlier document has; ``n_chars`` follows the text.

    Layout stays: only the passages are cut out, and a text without any is the same as before.
    """
    cut = suffix_automaton.cut_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    length = F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), "n_chars")
    return cut.withColumn("n_chars", length).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens."""
    packed = packing.pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("substring dedup", repeated_passages),
    ("best-fit packing", pack),
]

#: SQL has no tokenizer and no Kneser-Ney model: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        with staging_scope(spark):  # a stage's own tables go when its result is written
            docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"), scoped=False)
    return STAGES[-1][1](spark, docs, sf_dir)
