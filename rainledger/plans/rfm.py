"""Customer segments by recency, frequency and monetary value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cell_code, display_name, full_days_between, ladder, line_amount, rounded_mean
from ..operators.joins import broadcast_if_small
from ..operators.ranking import Tile, global_ntile, keep_first
from ..sinks.staging import stage
from ..sinks.tables import with_audit
from .sales import completed, declared, territory_names

QUARTILES = 4

_INT, _AMOUNT, _text = T.IntegerType(), T.DecimalType(15, 2), T.VarcharType

# Declared types of the first variant.
TYPED_V1_ORDERS = declared(
    ["SalesOrderID", "CustomerID"],
    SalesOrderID=_INT,
    CustomerID=_INT,
    OrderDate=T.TimestampNTZType(),
    TerritoryID=_INT,
    TerritoryName=_text(100),
    OrderAmount=_AMOUNT,
    CustomerName=_text(255),
)
TYPED_V1_FACT = declared(
    ["CustomerID"],
    CustomerID=_INT,
    CustomerName=_text(255),
    TerritoryName=_text(100),
    Recency=_INT,
    Frequency=_INT,
    Monetary=_AMOUNT,
    R_Score=_INT,
    F_Score=_INT,
    M_Score=_INT,
    RFM_Score=_INT,
    Segment=_text(50),
    LoadTimestamp=T.TimestampType(),
)

# Territories of the first variant.
V1_TERRITORIES = ["Northwest", "Southwest"]


@dataclass(frozen=True)
class Preset:
    """Quartile directions and segment cuts of one variant."""

    tiles: tuple[Tile, ...]
    segments: tuple[tuple[int, str], ...]
    other: str = "Lost"


# Fixed values. v2 gives 4 to the best quartile. v1 gives 1 to the best quartile but labels high
# sums Champions, and its last label is out of reach (the lowest sum is 3); it also sorts NULLs as
# its database does, first when descending.
PRESETS = {
    "v2": Preset(
        (
            Tile("R_Score", "Recency", descending=True),
            Tile("F_Score", "Frequency"),
            Tile("M_Score", "Monetary"),
        ),
        ((10, "Champions"), (7, "Loyal"), (4, "At Risk")),
    ),
    "v1": Preset(
        (
            Tile("R_Score", "Recency"),
            Tile("F_Score", "Frequency", descending=True, nulls_first=True),
            Tile("M_Score", "Monetary", descending=True, nulls_first=True),
        ),
        ((9, "Champions"), (6, "Loyal"), (3, "At Risk")),
    ),
}


def _order_sums(detail: DataFrame, wanted: DataFrame, amount: Column) -> DataFrame:
    """Amount and line count of the wanted orders, summed before any wide join.

    Lines of other orders leave by a semi join on the key of the sum, so they are neither summed nor shuffled again.
    """
    detail = detail.join(wanted.select("SalesOrderID"), "SalesOrderID", "left_semi")
    return detail.groupBy("SalesOrderID").agg(F.sum(amount).alias("OrderAmount"), F.count("*").alias("LineCount"))


def customer_orders(header: DataFrame, detail: DataFrame, territory: DataFrame) -> DataFrame:
    """Completed orders with their amount; grain: order."""
    amount = line_amount(F.col("LineTotal"), F.col("OrderQty"), F.col("UnitPrice"), F.col("UnitPriceDiscount"))
    keys = ["SalesOrderID", "CustomerID", "OrderDate", "TerritoryID", "TerritoryName", "CountryRegionCode"]
    wanted = completed(header)
    return (
        wanted.withColumn("OrderDate", F.col("OrderDate").cast("date"))
        .join(_order_sums(detail, wanted, amount), "SalesOrderID")
        .join(territory_names(territory), "TerritoryID")
        .groupBy(*keys)
        .agg(F.sum("OrderAmount").alias("OrderAmount"), F.sum("LineCount").alias("LineCount"))
    )


def _with_person(customer: DataFrame, person: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Left join to the person table; customers without a person skip the join.

    Their NULL keys would otherwise all meet in one task.
    """
    people = person.select("BusinessEntityID", *columns)
    matched = customer.where(F.col("PersonID").isNotNull()).join(
        people, F.col("PersonID") == F.col("BusinessEntityID"), "left"
    )
    blank = {f.name: F.lit(None).cast(f.dataType) for f in people.schema.fields}
    return matched.unionByName(customer.where(F.col("PersonID").isNull()).withColumns(blank))


def customers(customer: DataFrame, person: DataFrame) -> DataFrame:
    """Customers with a display name; grain: customer."""
    named = _with_person(customer, person, ["FirstName", "LastName"]).select(
        "CustomerID",
        "PersonID",
        display_name(F.col("FirstName"), F.col("LastName"), F.col("CustomerID")).alias("CustomerName"),
        F.col("BusinessEntityID").isNotNull().alias("IsIndividual"),
    )
    return keep_first(named, ["CustomerID"])


def territories(territory: DataFrame) -> DataFrame:
    """Territories; grain: territory."""
    renamed = territory.select(
        "TerritoryID", F.col("Name").alias("TerritoryName"), "CountryRegionCode", F.col("Group").alias("RegionGroup")
    )
    return keep_first(renamed, ["TerritoryID"])


def rfm_raw(
    orders: DataFrame, people: DataFrame, places: DataFrame, as_of: str, *, unique_orders: bool = False
) -> DataFrame:
    """Unscored measures as of a date; grain: customer.

    The territory is that of the latest order (the higher order number on one day). Where each order is known to be
    one row, ``unique_orders`` counts them in the same map-side sums, without a distinct count.
    """
    frequency = F.count("SalesOrderID") if unique_orders else F.count_distinct("SalesOrderID")
    latest = F.when(F.col("TerritoryID").isNotNull(), F.struct("OrderDate", "SalesOrderID"))
    measured = orders.groupBy("CustomerID").agg(
        F.min("OrderDate").alias("FirstPurchaseDate"),
        F.max("OrderDate").alias("LastPurchaseDate"),
        frequency.alias("Frequency"),
        F.sum("OrderAmount").alias("_monetary"),
        F.max_by("TerritoryID", latest).alias("TerritoryID"),
    )
    day = F.lit(as_of).cast("date")
    return (
        measured.join(people.select("CustomerID", "CustomerName", "IsIndividual"), "CustomerID", "left")
        .join(broadcast_if_small(places.select("TerritoryID", "TerritoryName")), "TerritoryID", "left")
        .select(
            "CustomerID",
            "CustomerName",
            "IsIndividual",
            "TerritoryID",
            "TerritoryName",
            "FirstPurchaseDate",
            "LastPurchaseDate",
            F.date_diff(day, "LastPurchaseDate").cast("bigint").alias("Recency"),
            "Frequency",
            F.round("_monetary", 2).alias("Monetary"),
            rounded_mean(F.col("_monetary"), F.col("Frequency")).alias("AvgOrderValue"),
            F.date_diff("LastPurchaseDate", "FirstPurchaseDate").cast("bigint").alias("TenureDays"),
        )
    )


def _scored(measured: DataFrame, preset: Preset, tiebreak: Sequence[str]) -> DataFrame:
    total = F.col("R_Score") + F.col("F_Score") + F.col("M_Score")
    scored = global_ntile(measured, QUARTILES, preset.tiles, tiebreak).withColumn("RFM_Score", total)
    return scored.withColumn("Segment", ladder(F.col("RFM_Score"), ">=", preset.segments, preset.other))


def rfm_fact(raw: DataFrame, as_of: str, preset: str = "v2") -> DataFrame:
    """Quartile scores, cell code and segment with audit columns; grain: customer.

    ``raw`` is read twice; pass a stored table (see ``stage``).
    """
    scored = _scored(raw, PRESETS[preset], ["CustomerID"])
    cell = cell_code(F.col("R_Score"), F.col("F_Score"), F.col("M_Score"))
    columns = [*raw.columns, "R_Score", "F_Score", "M_Score", "RFM_Score", "RFM_Cell", "Segment"]
    return with_audit(scored.withColumn("RFM_Cell", cell).select(*columns), as_of)


def segment_distribution(fact: DataFrame) -> DataFrame:
    """Customers and money per segment, richest first."""
    return (
        fact.groupBy("Segment")
        .agg(F.count("*").alias("customers"), F.round(F.sum("Monetary"), 2).alias("total_monetary"))
        .orderBy(F.col("total_monetary").desc_nulls_last(), "Segment")
    )


def rfm_v1_staging(
    header: DataFrame,
    detail: DataFrame,
    territory: DataFrame,
    customer: DataFrame,
    person: DataFrame,
    names: Sequence[str] = tuple(V1_TERRITORIES),
) -> DataFrame:
    """Orders of the named territories whatever their status; grain: order.

    Orders, customers and persons are unique by their keys, as in their database. A customer with
    very many orders is a skewed key of the last join; store the result, so that adaptive execution
    may split that join freely.
    """
    wanted = territory_names(territory.where(F.col("Name").isin(list(names)))).drop("CountryRegionCode")
    people = _with_person(customer.select("CustomerID", "PersonID"), person, ["FirstName", "LastName"])
    orders = header.select("SalesOrderID", "CustomerID", "OrderDate", "TerritoryID").join(wanted, "TerritoryID")
    return (
        orders.join(_order_sums(detail, orders, F.col("LineTotal")), "SalesOrderID")
        .join(people.select("CustomerID", "FirstName", "LastName"), "CustomerID")
        .select(
            "SalesOrderID",
            "CustomerID",
            "OrderDate",
            "TerritoryID",
            "TerritoryName",
            F.col("OrderAmount").cast("decimal(15,2)").alias("OrderAmount"),
            F.concat("FirstName", F.lit(" "), "LastName").alias("CustomerName"),
        )
    )


def rfm_v1_scored(staging: DataFrame, as_of: str) -> DataFrame:
    """First variant's scores; its grain is customer x territory x order amount x name."""
    keys = ["CustomerID", "TerritoryName", "OrderAmount", "CustomerName"]
    day = F.lit(as_of).cast("timestamp_ntz")
    measured = staging.groupBy(*keys).agg(
        full_days_between(F.max("OrderDate"), day).alias("Recency"),
        F.count("SalesOrderID").alias("Frequency"),
        F.sum("OrderAmount").cast("decimal(15,2)").alias("Monetary"),
    )
    scored = _scored(stage(measured, "rfm_v1"), PRESETS["v1"], keys)
    measures = ["Recency", "Frequency", "Monetary", "R_Score", "F_Score", "M_Score", "RFM_Score", "Segment"]
    return scored.select("CustomerID", "TerritoryName", "CustomerName", *measures)


def rfm_v1_fact(scored: DataFrame) -> DataFrame:
    """First variant's fact: the scored rows with their load time."""
    return with_audit(scored.select("CustomerID", "CustomerName", "TerritoryName", *scored.columns[3:]))
