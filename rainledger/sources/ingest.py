"""Ingest of many tables into one day of the landing zone, with a manifest and its validation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession

from ..functions.zones import drop_timezones
from ..jobs import in_parallel
from ..operators.quality import QualityError
from ..sinks.partitions import write_partition
from .files import read_partition

MANIFEST_SCHEMA = "table string, folder string, as_of string, path string, rows bigint, columns int"


@dataclass(frozen=True)
class TableSpec:
    """A source table, its landing folder, and the key to slice its scan by."""

    schema: str
    table: str
    folder: str
    key: str


# Tables of the sales plan and those the customer plan adds.
SALES_TABLES = [
    TableSpec("Sales", "SalesOrderHeader", "sales_order_header", "SalesOrderID"),
    TableSpec("Sales", "SalesOrderDetail", "sales_order_detail", "SalesOrderDetailID"),
    TableSpec("Sales", "SalesTerritory", "sales_territory", "TerritoryID"),
    TableSpec("Production", "Product", "product", "ProductID"),
    TableSpec("Production", "ProductSubcategory", "product_subcategory", "ProductSubcategoryID"),
    TableSpec("Production", "ProductCategory", "product_category", "ProductCategoryID"),
]
CUSTOMER_TABLES = [
    TableSpec("Sales", "Customer", "customer", "CustomerID"),
    TableSpec("Person", "Person", "person", "BusinessEntityID"),
]


def ingest_tables(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    root: str,
    as_of: str,
    reader: Callable[[TableSpec], DataFrame],
    parallel: int = 4,
) -> DataFrame:
    """Land each table and return the manifest, one row per table.

    The tables are independent Spark jobs; ``parallel`` of them run at a time.
    """
    if not specs:
        raise QualityError("no tables to ingest")

    def land(spec: TableSpec) -> tuple:
        df = drop_timezones(reader(spec))
        rows = write_partition(df, root, spec.folder, as_of)
        return (spec.table, spec.folder, as_of, f"{spec.folder}/dt={as_of}", rows, len(df.columns))

    return spark.createDataFrame(in_parallel(spark, land, specs, parallel), MANIFEST_SCHEMA)


def validate_manifest(spark: SparkSession, manifest: DataFrame, root: str) -> DataFrame:
    """Read every landed table back and compare rows and columns; one error names all failures.

    The manifest has one row per table, and the counts come from Parquet footers.
    """
    entries = manifest.collect()
    if not entries:
        raise QualityError("the manifest is empty")

    def check(entry: Row) -> tuple[str, int, int] | str:
        try:
            back = read_partition(spark, root, entry["folder"], entry["as_of"]).drop("dt")
            rows, columns = back.count(), len(back.columns)
        except PySparkException as error:
            return f"{entry['table']}: {error.getCondition()}"
        if (rows, columns) != (entry["rows"], entry["columns"]):
            return f"{entry['table']}: {rows} rows x {columns}, expected {entry['rows']} x {entry['columns']}"
        return entry["table"], rows, columns

    checked = in_parallel(spark, check, entries)
    failed = [answer for answer in checked if isinstance(answer, str)]
    if failed:
        raise QualityError(f"validation failed for {failed}")
    return spark.createDataFrame(checked, "table string, rows bigint, columns int")
