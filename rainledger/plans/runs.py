"""Daily runs: landed data in, silver and gold tables out.

Each silver table is written once and read by all later steps, so nothing is computed twice and
join sides have known sizes. A run depends only on its inputs and ``as_of``; repeating it gives
the same tables.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from ..jobs import in_parallel
from ..operators.quality import assert_not_all_null, assert_unique
from ..sinks.partitions import write_landing_json, write_partition, write_table
from ..sinks.staging import stage, staging_scope
from ..sinks.tables import ensure_schemas, recreate_views, replace_typed
from ..sources.files import assert_readable, read_landing_json, read_partition
from ..sources.fixed import DATASETS
from ..sources.ingest import CUSTOMER_TABLES, SALES_TABLES, TableSpec
from ..sources.payload import flatten_daily_payload
from . import rfm, sales, weather

log = logging.getLogger(__name__)

RFM_FOLDERS = ["sales_order_header", "sales_order_detail", "sales_territory", "customer", "person"]


def bronze_views(spark: SparkSession, landing: str, folders: Sequence[str], as_of: str) -> dict[str, DataFrame]:
    """Views over one landed day, one per table; fails at once when a table is not readable."""
    for folder, rows in assert_readable(spark, landing, folders, as_of).items():
        log.info("%s: %d rows", folder, rows)
    tables = {folder: read_partition(spark, landing, folder, as_of).drop("dt") for folder in folders}
    recreate_views(tables)
    return tables


def run_sales(spark: SparkSession, landing: str, store: str, as_of: str) -> dict[str, DataFrame]:
    raw = bronze_views(spark, landing, [spec.folder for spec in SALES_TABLES], as_of)
    lines = write_table(
        sales.order_lines(raw["sales_order_header"], raw["sales_order_detail"], raw["sales_territory"]),
        store,
        "silver",
        "sales_order_lines",
    )
    catalog = write_table(
        sales.products(raw["product"], raw["product_subcategory"], raw["product_category"]),
        store,
        "silver",
        "products",
    )
    summary = write_table(sales.sales_summary(lines, catalog), store, "silver", "sales_summary")
    fact = write_table(sales.sales_fact(summary, as_of), store, "gold", "fact_sales_performance")
    write_partition(fact, f"{store}/export", "fact_sales_performance", as_of)
    return {"sales_order_lines": lines, "products": catalog, "sales_summary": summary, "fact_sales_performance": fact}


def run_rfm(spark: SparkSession, landing: str, store: str, as_of: str) -> dict[str, DataFrame]:
    raw = bronze_views(spark, landing, RFM_FOLDERS, as_of)
    orders = write_table(
        rfm.customer_orders(raw["sales_order_header"], raw["sales_order_detail"], raw["sales_territory"]),
        store,
        "silver",
        "customer_orders",
    )
    assert_unique(orders, ["SalesOrderID"], "customer_orders")
    assert_not_all_null(orders, "OrderAmount", "customer_orders")
    people = write_table(rfm.customers(raw["customer"], raw["person"]), store, "silver", "customers")
    places = write_table(rfm.territories(raw["sales_territory"]), store, "silver", "territories")
    measured = write_table(rfm.rfm_raw(orders, people, places, as_of, unique_orders=True), store, "silver", "customer_rfm")
    assert_unique(measured, ["CustomerID"], "customer_rfm")
    with staging_scope(spark):
        fact = write_table(rfm.rfm_fact(measured, as_of), store, "gold", "fact_customer_rfm")
    assert_unique(fact, ["CustomerID"], "fact_customer_rfm")
    write_partition(fact, f"{store}/export", "fact_customer_rfm", as_of)
    return {
        "customer_orders": orders,
        "customers": people,
        "territories": places,
        "customer_rfm": measured,
        "fact_customer_rfm": fact,
        "segment_distribution": rfm.segment_distribution(fact),
    }


def run_sales_typed(
    spark: SparkSession, reader: Callable[[TableSpec], DataFrame], folder: str, database: str = "dwh"
) -> dict[str, DataFrame]:
    """The database variant: offline orders read in place, loaded into declared tables.

    Each table is switched to its new rows only after they are complete and checked.
    """
    ensure_schemas(spark, [database], folder)
    raw = {spec.folder: reader(spec) for spec in SALES_TABLES}

    def load(name: str, df: DataFrame, schema: StructType, keys: Sequence[str] = ()) -> DataFrame:
        return replace_typed(df, f"{database}.{name}", schema, f"{folder}/{name}", keys)

    tables = [raw[name] for name in ("sales_order_header", "sales_order_detail", "sales_territory")]
    lines = load("stg_sales_orders", sales.order_lines(*tables, online=False), sales.TYPED_LINES)
    catalog = load(
        "stg_products",
        sales.products(raw["product"], raw["product_subcategory"], raw["product_category"]),
        sales.TYPED_PRODUCTS,
    )
    grain = ["ProductID", "TerritoryID"]
    summary = load("trf_sales_summary", sales.sales_summary(lines, catalog, guard=False), sales.TYPED_SUMMARY, grain)
    fact = load("fact_sales_performance", sales.sales_fact(summary, None), sales.TYPED_FACT, grain)
    return {"stg_sales_orders": lines, "stg_products": catalog, "trf_sales_summary": summary, "fact_sales_performance": fact}


def run_rfm_v1(
    spark: SparkSession,
    reader: Callable[[TableSpec], DataFrame],
    folder: str,
    as_of: str,
    names: Sequence[str] = tuple(rfm.V1_TERRITORIES),
    database: str = "dwh",
) -> dict[str, DataFrame]:
    """The first customer variant, read in place and loaded into declared tables.

    Its scored rows are finer than a customer, so only the order table has a key to check.
    """
    ensure_schemas(spark, [database], folder)
    specs = {spec.folder: spec for spec in [*SALES_TABLES, *CUSTOMER_TABLES]}
    raw = [reader(specs[name]) for name in RFM_FOLDERS]
    orders = replace_typed(
        rfm.rfm_v1_staging(*raw, names),
        f"{database}.stg_customer_orders",
        rfm.TYPED_V1_ORDERS,
        f"{folder}/stg_customer_orders",
        ["SalesOrderID", "CustomerID"],
    )
    with staging_scope(spark):
        fact = replace_typed(
            rfm.rfm_v1_fact(rfm.rfm_v1_scored(orders, as_of)),
            f"{database}.fact_customer_rfm",
            rfm.TYPED_V1_FACT,
            f"{folder}/fact_customer_rfm",
        )
    return {"stg_customer_orders": orders, "fact_customer_rfm": fact}


def run_landing(
    raw: DataFrame, places: DataFrame, landing: str, as_of: str, stamp: str, datasets: Sequence[str] = DATASETS
) -> dict[str, int | list[str]]:
    """Flatten API payloads and land them as JSON; one warning names each payload that gave no rows.

    The payloads are read once: what is warned of is counted while they are written. The same run again lands the
    same records. Returns the number of payloads and the names warned of.
    """
    seen = Observation()
    write_landing_json(flatten_daily_payload(raw, places, seen), landing, as_of, stamp, datasets)
    report = seen.get
    for name in report["without_days"]:
        log.warning("%s: the payload has no daily data", name)
    for name in report["unknown_places"]:
        log.warning("%s: the location is not known, nothing is landed", name)
    return report


def run_weather(
    spark: SparkSession,
    landing: str,
    store: str,
    as_of: str,
    datasets: Sequence[str] = DATASETS,
    required: Sequence[str] = (),
    events: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Fails when a ``required`` data set has not landed; another that is missing is logged.

    ``events`` is the calendar that names the climate event of each day (see ``dim_date``).
    """
    records = read_landing_json(spark, landing, as_of, datasets, required)
    return weather_tables(records, store, events)


def write_by_month(fact: DataFrame, store: str, name: str) -> DataFrame:
    """A daily fact in one folder per month, so that questions to a period read its months only."""
    keyed = fact.withColumn(weather.MONTH, weather.month_key()).hint("rebalance", weather.MONTH)
    return write_table(keyed, store, "silver", name, [weather.MONTH])


def weather_tables(records: DataFrame, store: str, events: DataFrame | None = None) -> dict[str, DataFrame]:
    """Bronze, silver and gold from landed records; the risk facts are laid out by month."""

    spark = records.sparkSession

    def written(
        layer: str, frames: dict[str, Callable[[], DataFrame]], monthly: Sequence[str] = ()
    ) -> dict[str, DataFrame]:
        def write(name: str) -> DataFrame:
            return write_by_month(frames[name](), store, name) if name in monthly else write_table(frames[name](), store, layer, name)

        return dict(zip(frames, in_parallel(spark, write, frames)))

    with staging_scope(spark):
        tables = written("bronze", {"weather_daily": lambda: weather.build_bronze(records)})
        bronze = tables["weather_daily"]
        tables |= written(
            "silver",
            {"dim_date": lambda: weather.dim_date(bronze, events), "dim_location": lambda: weather.dim_location(bronze)},
        )
        dates, places = tables["dim_date"], tables["dim_location"]
        assert_unique(places, ["location_name"], "dim_location")
        tables |= written("silver", {"fact_weather_daily": lambda: weather.weather_fact(bronze, dates, places)})
        facts = tables["fact_weather_daily"]
        # With one row per day and place the risk facts are columns of one pass over the windows.
        assert_unique(facts, ["date_key", "location_key"], "fact_weather_daily")
        risk = stage(weather.daily_risk(facts, places, facts.count()), "daily_risk")
        tables |= written(
            "silver",
            {
                "fact_drought_risk_daily": lambda: risk.select(*weather.DROUGHT_COLUMNS),
                "fact_fire_risk_daily": lambda: risk.select(*weather.FIRE_COLUMNS),
                "fact_mitigation_daily": lambda: weather.mitigation(risk),
            },
            monthly=["fact_drought_risk_daily", "fact_fire_risk_daily"],
        )
    drought, fire, action = (tables[f"fact_{name}_daily"] for name in ("drought_risk", "fire_risk", "mitigation"))
    return tables | written(
        "gold",
        {
            "drought_risk_by_region": lambda: weather.gold_drought(drought, places, dates),
            "el_nino_weather_trend": lambda: weather.gold_trend(facts, places, dates),
            "karhutla_risk_by_region": lambda: weather.gold_fire(fire, places, dates),
            "mitigation_priority_daily": lambda: weather.gold_mitigation(action, places, dates),
        },
    )
