"""More rows make more tasks, not larger ones, although adaptive execution would merge them by their few bytes."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from rainledger.operators import spread
from workbench import adapters
from workbench.registry import QUERIES

TASK = 500


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setitem(spread.__globals__, "ROWS_PER_TASK", TASK)


def test_rows_are_dealt_by_key_and_kept(spark, small_tasks):
    df = spark.range(20_000).withColumn("k", F.col("id") % 4_000)
    out = spread(df, ["k"], 20_000)
    assert out.rdd.getNumPartitions() == 40 and out.count() == 20_000
    assert out.select("k", F.spark_partition_id().alias("task")).distinct().count() == 4_000
    assert spread(df, ["k"], 0).rdd.getNumPartitions() == 1


def test_bronze_tasks_are_bounded(spark, small_tasks):
    """Lines are dealt out before they are grouped, and records before they are de-duplicated."""
    tasks = -(-adapters.line_count(spark, SMALL) // TASK)
    bronze = QUERIES["weather_bronze_dedup"](spark, SMALL)
    assert bronze.rdd.getNumPartitions() == tasks
    plan = bronze._jdf.queryExecution().optimizedPlan().toString()
    dealt = [place for place, line in enumerate(plan.split("\n")) if "RepartitionByExpression" in line and f", {tasks}" in line]
    grouped = next(place for place, line in enumerate(plan.split("\n")) if "Aggregate" in line)
    assert len(dealt) == 2 and dealt[0] < grouped < dealt[1]


@pytest.mark.parametrize("name", ["drought_risk", "fire_risk", "mitigation"])
def test_window_tasks_are_bounded(spark, small_tasks, name):
    tasks = -(-adapters.line_count(spark, SMALL) // TASK)
    assert QUERIES[name](spark, SMALL).rdd.getNumPartitions() == tasks


def test_many_places_are_joined_in_bounded_tasks(spark, small_tasks, monkeypatch):
    """Places beyond a broadcast: their records are dealt out by place, and all of them are the same."""
    few = QUERIES["weather_bronze_dedup"](spark, SMALL)
    monkeypatch.setattr(adapters, "is_small", lambda side: False, raising=False)
    tasks = -(-adapters.line_count(spark, SMALL) // TASK)
    many = QUERIES["weather_bronze_dedup"](spark, SMALL)
    plan = many._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert any("RepartitionByExpression [place" in line and f", {tasks}" in line for line in plan)
    assert many.count() == few.count() and many.exceptAll(few).isEmpty()
