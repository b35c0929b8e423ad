"""Shards of many one-row sources, running sums in two levels, and the digests of the query."""

import zlib

import pytest
from pyspark.sql import functions as F

from rainledger.llm import registry, sharding

SMALL = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, size long, text_crc32 long")


@pytest.mark.parametrize("run", [3, 4096])
def test_one_row_sources_are_spread(spark, monkeypatch, run):
    monkeypatch.setattr(sharding, "RUN", run)
    rows = [(i, f"host{i}", 9, i) for i in range(2000)] + [(i, "hot", 9, i) for i in range(2000, 3001)]
    found = sharding.shard_documents(table(spark, rows), 7).toPandas()
    sizes = found.groupby("shard").size()
    assert sorted(found.doc_id) == list(range(3001)) and sizes.max() - sizes.min() == 1
    assert (found.groupby("shard").slot.max() + 1 == sizes).all() and not found.duplicated(["shard", "slot"]).any()
    hot = found[found.source == "hot"].groupby("shard").size()
    # One-row sources are spread like drawn numbers: six standard deviations of a shard's share.
    assert abs(hot - 143).max() < 6 * (2000 / 7) ** 0.5
    # Sources of one row stand at all places of the order, in an order that is not that of their ids.
    ordered = found[found.source != "hot"].sort_values(["shard", "slot"]).doc_id.to_numpy()
    assert abs(ordered[:700].mean() - 1000) < 150


def test_running_sums_of_two_levels_give_one_order(spark, monkeypatch):
    rows = [(i, f"s{i % 5}" if i % 3 else None, 9, i) for i in range(500)]
    whole = {tuple(r) for r in sharding.shard_documents(table(spark, rows), 6).collect()}
    monkeypatch.setattr(sharding, "RUN", 2)
    assert {tuple(r) for r in sharding.shard_documents(table(spark, rows), 6).collect()} == whole


def test_sizes_and_digests_of_the_query(spark):
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = registry.op3_stratified_sharding(spark, SMALL).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {i: (len(t) + 8, zlib.crc32(t)) for i, t in docs.items()}
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}


def test_null_source_and_repeated_ids(spark):
    rows = [(1, None, 8, 0), (1, None, 8, 0), (None, "a", 8, 0), (2, "", 8, 0)]
    clash = table(spark, rows).withColumn("_rank", F.lit(1)).withColumn("shard", F.lit("x"))
    found = sharding.shard_documents(clash, 3).collect()
    assert sorted(r["shard"] for r in found) in ([0, 0, 1, 2], [0, 1, 1, 2], [0, 1, 2, 2])
