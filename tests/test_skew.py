"""A third of the rows on one key: the work must not gather in one task."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from rainledger.operators import Tile, global_ntile, keep_first
from rainledger.plans import rfm, sales
from rainledger.sinks import stage

ROWS = 300_000
HOT = 7


def final_plan(df):
    """The plan after adaptive execution, as it ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_partitions(spark):
    """Limits at which the test data counts as large: no broadcast, skew from 64 KB."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.fixture(scope="module")
def orders(spark):
    """Order 7 holds a third of all lines and product 7 another third."""
    line = F.col("id")
    detail = spark.range(ROWS, numPartitions=4).select(
        F.when(line % 3 == 0, HOT).otherwise(line % 20_000).cast("int").alias("SalesOrderID"),
        line.cast("int").alias("SalesOrderDetailID"),
        F.when(line % 3 == 1, HOT).otherwise(line % 5_000).cast("int").alias("ProductID"),
        F.lit(1).alias("OrderQty"),
        F.lit(D("2.00")).alias("UnitPrice"),
        F.lit(None).cast("decimal(4,2)").alias("UnitPriceDiscount"),
        F.lit(D("2.00")).alias("LineTotal"),
    )
    header = spark.range(20_000).select(
        F.col("id").cast("int").alias("SalesOrderID"),
        F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id")).cast("int").alias("CustomerID"),
        F.lit("2026-01-01").cast("timestamp_ntz").alias("OrderDate"),
        F.lit(1).alias("TerritoryID"),
        F.lit(5).alias("Status"),
        F.lit(False).alias("OnlineOrderFlag"),
    )
    territory = spark.createDataFrame(
        [(1, "Northwest", "US", "America")], "TerritoryID int, Name string, CountryRegionCode string, `Group` string"
    )
    return header, stage(detail, "skewed_detail"), territory


def test_join_of_a_huge_order_is_split(spark, orders, small_partitions):
    lines = sales.order_lines(*orders)
    assert "skew=true" in final_plan(lines)
    assert lines.count() == ROWS


def test_product_sums_start_before_the_shuffle(spark, orders, small_partitions):
    product = spark.range(5_000).select(
        F.col("id").cast("int").alias("ProductID"),
        F.lit("p").alias("ProductName"),
        F.lit("n").alias("ProductNumber"),
        F.lit(D("3.00")).cast("decimal(10,2)").alias("ListPrice"),
        F.lit(D("1.00")).cast("decimal(10,2)").alias("StandardCost"),
        F.lit("c").alias("Category"),
        F.lit("s").alias("Subcategory"),
    )
    summary = sales.sales_summary(sales.order_lines(*orders), product)
    hot = summary.where(F.col("ProductID") == HOT).first()
    expected = orders[1].where(F.col("ProductID") == HOT).count()
    assert (hot["TotalQty"], hot["TotalRevenue"]) == (expected, D("2.00") * expected)
    assert summary.agg(F.sum("TotalQty")).first()[0] == ROWS


def test_orders_are_summed_before_their_join(spark, orders, small_partitions):
    """One row per order reaches the join, so the huge order is no longer special."""
    out = rfm.customer_orders(*orders)
    hot = out.where(F.col("SalesOrderID") == HOT).first()
    assert hot["LineCount"] == orders[1].where(F.col("SalesOrderID") == HOT).count()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate")


def test_customers_without_a_person_skip_the_join(spark, small_partitions):
    customer = spark.range(30_000).select(
        F.col("id").cast("int").alias("CustomerID"), F.when(F.col("id") % 3 != 0, F.col("id").cast("int")).alias("PersonID")
    )
    person = spark.range(30_000).selectExpr("CAST(id AS INT) AS BusinessEntityID", "'A' AS FirstName", "'B' AS LastName")
    out = rfm.customers(customer, person)
    assert out.where("IsIndividual").count() == 20_000 and out.count() == 30_000
    joined = rfm._with_person(customer, person, ["FirstName"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in joined and joined.count("Filter") == 2


def test_one_value_for_a_third_of_the_ranks(spark, small_partitions):
    df = stage(
        spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000).alias("v")), "hot"
    )
    sizes = [r["count"] for r in global_ntile(df, 4, [Tile("t", "v")], ["id"]).groupBy("t").count().collect()]
    assert sizes == [15_000] * 4


def test_one_key_for_a_third_of_the_duplicates(spark, small_partitions):
    df = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    kept = keep_first(df, ["k"], [F.col("id").desc()])
    assert kept.count() == 60_001
    assert kept.where("k = -1").first()["id"] == 89_997
