"""The given tables as sales, customer and weather sources (see FIXTURES.md, part 2).

All rows of the tables are used. Remainders map keys to attributes; they never filter rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rainledger.operators import spread
from rainledger.operators.joins import is_small
from rainledger.sources import inline_rows
from rainledger.sources.fixed import LOCATION_SCHEMA, LOCATIONS
from rainledger.sources.payload import RECORD_SCHEMA

AS_OF = "2001-08-02"
STAMP = "20010802T000000"
V1_TERRITORIES = ["NATION_0", "NATION_1"]
SEASON_START, DROUGHT_END, FIRE_END = "1998-06-01", "1998-09-30", "1998-10-31"

#: The calendar of climate events that the event queries use: the second event begins before the first has ended.
EVENTS = [("El Nino", "1997-05-01", "1998-05-31"), ("La Nina", "1998-05-20", "2001-03-31")]

# Category 3 is absent on purpose: its subcategories have no category name.
SUBCATEGORIES = [(i, f"Subcategory {i}", i % 4) for i in range(8)]
CATEGORIES = [(i, f"Category {i}") for i in range(3)]


# Declared schemas of the given tables: no job to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def header(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", 5).otherwise(1)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("SalesOrderID"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("o_orderdate").alias("OrderDate"),
        (F.col("o_orderkey") % 25).cast("int").alias("TerritoryID"),
        status.alias("Status"),
        (F.col("o_orderpriority") == "5-LOW").alias("OnlineOrderFlag"),
    )


def detail(spark: SparkSession, sf_dir: str, *, with_gaps: bool = False) -> DataFrame:
    """``with_gaps`` leaves every third line total NULL, for the fallback amount."""
    price = F.col("l_extendedprice").cast("decimal(8,2)")
    discount = F.col("l_discount").cast("decimal(3,2)")
    one = F.lit(1).cast("decimal(1,0)")
    total = price * F.col("l_quantity").cast("decimal(3,0)") * (one - discount) * (one + F.col("l_tax").cast("decimal(3,2)"))
    if with_gaps:
        total = F.when(F.col("l_linenumber") % 3 != 0, total)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("SalesOrderID"),
        F.col("l_linenumber").alias("SalesOrderDetailID"),
        F.col("l_partkey").alias("ProductID"),
        F.col("l_quantity").cast("int").alias("OrderQty"),
        price.alias("UnitPrice"),
        F.when(F.col("l_linenumber") != 6, discount).alias("UnitPriceDiscount"),
        total.cast("decimal(28,6)").alias("LineTotal"),
    )


def territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("TerritoryID"),
        F.col("n_name").alias("Name"),
        F.col("n_regionkey").cast("string").alias("CountryRegionCode"),
        F.col("r_name").alias("Group"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, price = F.col("p_size"), F.col("p_retailprice").cast("decimal(10,2)")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("Name"),
        F.col("p_brand").alias("ProductNumber"),
        F.when(size % 10 == 0, F.lit(0).cast("decimal(10,2)")).otherwise(price).alias("ListPrice"),
        (price * F.lit("0.61").cast("decimal(2,2)")).cast("decimal(19,4)").alias("StandardCost"),
        F.when(size % 7 != 0, size % 8).alias("ProductSubcategoryID"),
    )


def subcategory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inline_rows(spark, SUBCATEGORIES, "ProductSubcategoryID int, Name string, ProductCategoryID int")


def category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inline_rows(spark, CATEGORIES, "ProductCategoryID int, Name string")


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("CustomerID"), F.when(key % 3 != 0, key).alias("PersonID")
    )


def person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A last name is missing for some, so that a matched person can still lack a name."""
    key, parts = F.col("c_custkey"), F.split("c_name", "#")
    return table(spark, sf_dir, "customer").select(
        key.alias("BusinessEntityID"),
        parts[0].alias("FirstName"),
        F.when(key % 11 != 0, parts[1]).alias("LastName"),
    )


SOURCES = {
    "sales_order_header": header,
    "sales_order_detail": lambda spark, sf_dir: detail(spark, sf_dir, with_gaps=True),
    "sales_territory": territory,
    "product": product,
    "product_subcategory": subcategory,
    "product_category": category,
    "customer": customer,
    "person": person,
}


def source_reader(spark: SparkSession, sf_dir: str):
    """The reader an ingest calls per table."""
    return lambda spec: SOURCES[spec.folder](spark, sf_dir)


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("order "), F.col("o_orderkey")).alias("product"),
        F.floor("o_totalprice").cast("int").alias("price"),
        F.col("o_orderpriority").alias("category"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("sale_date"),
    )


def supplier_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as a monitored location."""
    key = F.col("s_suppkey")
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("place"),
            F.col("s_name").alias("location_key"),
            F.col("s_name").alias("location_name"),
            F.col("n_name").alias("province"),
            F.col("r_name").alias("island"),
            ((key % 180) * F.lit(0.5) - 45).alias("latitude"),
            ((key % 360) * F.lit(0.5)).alias("longitude"),
            (key % 5 == 0).alias("peatland_flag"),
        )
    )


def fixed_places(spark: SparkSession) -> DataFrame:
    """The library's own location list, numbered."""
    return inline_rows(spark, [(i, *row) for i, row in enumerate(LOCATIONS)], f"place bigint, {LOCATION_SCHEMA}")


def events(spark: SparkSession) -> DataFrame:
    named = inline_rows(spark, EVENTS, "climate_event string, first_day string, last_day string")
    return named.withColumns({day: F.col(day).cast("date") for day in ("first_day", "last_day")})


def zoned_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order header with its date as a zone-aware time stamp."""
    return header(spark, sf_dir).withColumn("OrderDate", F.col("OrderDate").cast("timestamp"))


def _points(column: str) -> Column:
    """Hundredths of a rate as an integer."""
    return F.round(F.col(column) * 100).cast("int")


def line_count(spark: SparkSession, sf_dir: str) -> int:
    """Order lines, as the files' footers count them: a bound of the weather records."""
    return table(spark, sf_dir, "lineitem").count()


def weather_records(spark: SparkSession, sf_dir: str, places: DataFrame | None = None, modulo: int | None = None):
    """Landed weather records from the order lines; grain: data set x location x ship date.

    Values are integers or exact binary fractions, so sums do not depend on their order. At the grain of suppliers nearly
    every line is a record of its own, so sums before the shuffle would hold a whole scan in memory: the lines are dealt out
    instead. Of a few places (``modulo``) the sums are small and come first. Too many places for a broadcast are joined in
    tasks of bounded size too; a place has two records a day at most, so none of them outgrows its task.
    """
    places = supplier_places(spark, sf_dir) if places is None else places
    place = F.col("l_suppkey") if modulo is None else F.col("l_suppkey") % modulo
    grain = ["dataset", "place", "day"]
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", "forecast").otherwise("archive").alias("dataset"),
        place.alias("place"),
        F.col("l_shipdate").cast("date").alias("day"),
        "l_quantity",
        _points("l_tax").alias("tax_points"),
        _points("l_discount").alias("discount_points"),
    )
    rows = line_count(spark, sf_dir)
    if modulo is None:
        lines = spread(lines, grain, rows)
    daily = lines.groupBy(*grain).agg(
        F.max("l_quantity").alias("most"),
        F.min("l_quantity").alias("least"),
        F.sum("tax_points").alias("tax"),
        F.max("tax_points").alias("top_tax"),
        F.max("discount_points").alias("top_discount"),
    )
    if is_small(places):
        places = F.broadcast(places)
    else:
        daily = spread(daily, ["place"], rows)
    month = F.month("day")
    rain = F.when(month.isin(6, 7, 8, 9), 0.2578125).when(month.isin(12, 1, 2, 3), 1.0).otherwise(0.5)
    values = daily.withColumns(
        {
            "date": F.col("day").cast("string"),
            "temperature_2m_max_c": 28 + F.col("most") * 0.25,
            "temperature_2m_min_c": 18 + F.col("least") * 0.125,
            "precipitation_sum_mm": F.col("tax") * rain,
            "relative_humidity_min_pct": 72 - F.col("most"),
            "wind_speed_10m_max_kmh": (5 + 3 * F.col("top_discount")).cast("double"),
            "evapotranspiration_mm": 1 + 1.25 * F.col("top_tax"),
            "soil_moisture_avg": (5 + 3 * F.col("top_discount")) / F.lit(100.0),
        }
    )
    mean = F.bround((F.col("temperature_2m_max_c") + F.col("temperature_2m_min_c")) / 2, 3)
    named = values.withColumn("temperature_2m_mean_c", mean).join(places, "place")
    return named.withColumn("location", F.col("location_name")).select(*RECORD_SCHEMA.fieldNames())


def payloads(spark: SparkSession, sf_dir: str, places: DataFrame | None = None, modulo: int | None = None) -> DataFrame:
    """API answers, one per data set and location, in the shape of parallel daily arrays.

    The records hold one row per day, so an answer is never longer than the calendar. Humidity
    is left out of forecasts, as an absent variable.
    """
    days = F.array_sort(
        F.collect_list(
            F.struct(
                "date",
                "temperature_2m_max_c",
                "temperature_2m_min_c",
                "precipitation_sum_mm",
                "relative_humidity_min_pct",
                "wind_speed_10m_max_kmh",
                "evapotranspiration_mm",
                "soil_moisture_avg",
            )
        )
    )
    answers = weather_records(spark, sf_dir, places, modulo).groupBy("dataset", "location").agg(days.alias("days"))
    humidity = F.when(F.col("dataset") == "archive", F.col("days.relative_humidity_min_pct"))
    daily = F.struct(
        F.col("days.date").alias("time"),
        F.col("days.temperature_2m_max_c").alias("temperature_2m_max"),
        F.col("days.temperature_2m_min_c").alias("temperature_2m_min"),
        F.col("days.precipitation_sum_mm").alias("precipitation_sum"),
        humidity.alias("relative_humidity_2m_min"),
        F.col("days.wind_speed_10m_max_kmh").alias("wind_speed_10m_max"),
        F.col("days.evapotranspiration_mm").alias("et0_fao_evapotranspiration"),
        F.col("days.soil_moisture_avg").alias("soil_moisture_0_to_7cm_mean"),
    )
    return answers.select(
        "dataset", F.col("location").alias("location_key"), F.to_json(F.struct(daily.alias("daily"))).alias("body")
    )
