"""Sales performance: revenue, quantity and margin by product and territory.

Money keeps the scale of its source from the order line to the fact and is rounded once, in the last
projection, so totals are exact and repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import margin_percent, rounded_mean
from ..operators.joins import broadcast_if_small
from ..sinks.tables import with_audit

# Fixed value: status code of a completed order.
COMPLETED = 5

SALE_KEYS = ["TerritoryID", "TerritoryName", "CountryRegionCode"]
PRODUCT_KEYS = ["ProductID", "ProductName", "ProductNumber", "Category", "Subcategory", "ListPrice", "StandardCost"]
SUMMARY_COLUMNS = [
    *PRODUCT_KEYS[:5],
    *SALE_KEYS,
    "TotalRevenue",
    "TotalQty",
    "AvgUnitPrice",
    "ListPrice",
    "StandardCost",
    "Margin",
    "MarginPct",
]


def declared(required: Sequence[str] = (), **columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in required) for name, kind in columns.items()])


_INT, _PRICE, _text = T.IntegerType(), T.DecimalType(10, 2), T.VarcharType

# Declared types of the database variant.
TYPED_LINES = declared(
    SalesOrderID=_INT,
    SalesOrderDetailID=_INT,
    OrderDate=T.DateType(),
    ProductID=_INT,
    OrderQty=T.ShortType(),
    UnitPrice=_PRICE,
    LineTotal=T.DecimalType(12, 2),
    TerritoryID=_INT,
    TerritoryName=_text(100),
    CountryRegionCode=_text(10),
)
TYPED_PRODUCTS = declared(
    ProductID=_INT,
    ProductName=_text(255),
    ProductNumber=_text(50),
    ListPrice=_PRICE,
    StandardCost=_PRICE,
    Category=_text(100),
    Subcategory=_text(100),
)
TYPED_SUMMARY = declared(
    ["ProductID", "TerritoryID"],
    ProductID=_INT,
    ProductName=_text(255),
    ProductNumber=_text(50),
    Category=_text(100),
    Subcategory=_text(100),
    TerritoryID=_INT,
    TerritoryName=_text(100),
    CountryRegionCode=_text(10),
    TotalRevenue=T.DecimalType(15, 2),
    TotalQty=_INT,
    AvgUnitPrice=_PRICE,
    ListPrice=_PRICE,
    StandardCost=_PRICE,
    Margin=_PRICE,
    MarginPct=T.DecimalType(6, 2),
)
TYPED_FACT = T.StructType([*TYPED_SUMMARY.fields, T.StructField("LoadTimestamp", T.TimestampType())])


def completed(header: DataFrame, online: bool | None = None) -> DataFrame:
    """Completed orders; with ``online`` also only those with that flag (a NULL flag drops out)."""
    kept = header.where(F.col("Status") == COMPLETED)
    return kept if online is None else kept.where(F.col("OnlineOrderFlag") == online)


def territory_names(territory: DataFrame) -> DataFrame:
    """The few territories an order joins; shuffling orders by territory would make huge groups."""
    return broadcast_if_small(
        territory.select("TerritoryID", F.col("Name").alias("TerritoryName"), "CountryRegionCode")
    )


def order_lines(
    header: DataFrame, detail: DataFrame, territory: DataFrame, *, online: bool | None = None
) -> DataFrame:
    """Lines of completed orders with their territory; grain: order line.

    An order with very many lines is a skewed key of the header join; adaptive execution splits
    its lines over several tasks.
    """
    return (
        completed(header, online)
        .select("SalesOrderID", F.col("OrderDate").cast("date").alias("OrderDate"), "TerritoryID")
        .join(territory_names(territory), "TerritoryID")
        .join(detail, "SalesOrderID")
        .select(
            "SalesOrderID",
            "SalesOrderDetailID",
            "OrderDate",
            "ProductID",
            F.col("OrderQty").cast("int").alias("OrderQty"),
            "UnitPrice",
            "LineTotal",
            *SALE_KEYS,
        )
    )


def products(product: DataFrame, subcategory: DataFrame, category: DataFrame) -> DataFrame:
    """Priced products with category names, ``N/A`` where there is none; grain: product."""
    families = subcategory.select(
        "ProductSubcategoryID", F.col("Name").alias("_subcategory"), "ProductCategoryID"
    ).join(category.select("ProductCategoryID", F.col("Name").alias("_category")), "ProductCategoryID", "left")
    return (
        product.where(F.col("ListPrice") > 0)
        .join(broadcast_if_small(families), "ProductSubcategoryID", "left")
        .select(
            "ProductID",
            F.col("Name").alias("ProductName"),
            "ProductNumber",
            "ListPrice",
            "StandardCost",
            F.coalesce("_category", F.lit("N/A")).alias("Category"),
            F.coalesce("_subcategory", F.lit("N/A")).alias("Subcategory"),
        )
    )


def sales_summary(lines: DataFrame, catalog: DataFrame, *, guard: bool = True) -> DataFrame:
    """Revenue, quantity, mean price and margin; grain: product x territory.

    Lines are summed per product and territory before the product join, so a best-seller's lines
    meet in map-side sums and not in one join task. A product listed twice counts twice: the
    catalog's equal rows are counted before the join, and the sums multiplied, so no task sums the
    wide joined rows again.
    """
    sold = lines.groupBy("ProductID", *SALE_KEYS).agg(
        F.sum("LineTotal").alias("_revenue"),
        F.sum(F.col("OrderQty").cast("bigint")).alias("_quantity"),
        F.sum("UnitPrice").alias("_prices"),
        F.count("UnitPrice").alias("_priced"),
    )
    listed = catalog.groupBy(*PRODUCT_KEYS).agg(F.count("*").alias("_listed"))
    totals = sold.join(listed, "ProductID").withColumns(
        {c: _times(sold, c, F.col("_listed")) for c in ("_revenue", "_quantity", "_prices", "_priced")}
    )
    price, cost = F.col("ListPrice"), F.col("StandardCost")
    return totals.withColumns(
        {
            "TotalRevenue": F.round("_revenue", 2),
            "TotalQty": F.col("_quantity"),
            "AvgUnitPrice": rounded_mean(F.col("_prices"), F.col("_priced")),
            "Margin": F.round(price - cost, 2),
            "MarginPct": margin_percent(price, cost, guard=guard),
        }
    ).select(*SUMMARY_COLUMNS)


def _times(sold: DataFrame, column: str, copies: Column) -> Column:
    """A sum over ``copies`` equal rows, in the type that summing them has."""
    kind = sold.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        kind = T.DecimalType(min(kind.precision + 10, 38), kind.scale)
    return F.when(copies == 1, F.col(column).cast(kind)).otherwise((F.col(column) * copies).cast(kind))


def sales_fact(summary: DataFrame, as_of: str | None) -> DataFrame:
    """The summary with load time and batch date."""
    return with_audit(summary.select(*SUMMARY_COLUMNS), as_of)


def category_summary(sales: DataFrame, *, with_mean: bool = True) -> DataFrame:
    """Transactions, turnover and mean price per category, largest turnover first."""
    price = F.col("price").cast("bigint")
    totals = sales.groupBy("category").agg(
        F.count("*").alias("total_transaksi"), F.sum(price).alias("total_omzet"), F.count(price).alias("_priced")
    )
    if with_mean:
        mean = rounded_mean(F.col("total_omzet"), F.col("_priced"), 0)
        totals = totals.withColumn("avg_harga", mean.cast("double"))
    return totals.drop("_priced").orderBy(F.col("total_omzet").desc_nulls_last(), "category")
