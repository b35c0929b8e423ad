import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from rainledger.operators import QualityError
from rainledger.plans import rfm, runs, sales, weather
from rainledger.sinks import write_landing_json
from rainledger.sources import CUSTOMER_TABLES, DATASETS, LOCATIONS, RECORD_SCHEMA, SALES_TABLES, ingest_tables
from workbench import adapters


def day(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def shop(spark):
    """A shop of a few rows: order 4 is not completed, product 3 has no price."""
    header = spark.createDataFrame(
        [
            (1, 10, day("2026-01-01"), 1, 5, False),
            (2, 10, day("2026-02-01"), 2, 5, True),
            (3, 11, day("2026-02-01"), 1, 5, None),
            (4, 12, day("2026-03-01"), 1, 1, False),
            (5, 10, day("2026-02-01"), 1, 5, False),
        ],
        "SalesOrderID int, CustomerID int, OrderDate timestamp_ntz, TerritoryID int, Status int, OnlineOrderFlag boolean",
    )
    detail = spark.createDataFrame(
        [
            (1, 1, 1, 2, D("10.00"), None, None),
            (1, 2, 1, 1, D("10.01"), D("0.10"), None),
            (2, 1, 2, 1, D("5.00"), None, D("4.50")),
            (3, 1, 3, 1, D("7.00"), None, D("7.00")),
            (4, 1, 1, 9, D("1.00"), None, D("9.00")),
            (5, 1, 2, 2, D("5.00"), None, D("10.00")),
        ],
        "SalesOrderID int, SalesOrderDetailID int, ProductID int, OrderQty int, UnitPrice decimal(10,2), "
        "UnitPriceDiscount decimal(4,2), LineTotal decimal(12,2)",
    )
    territory = spark.createDataFrame(
        [(1, "Northwest", "US", "America"), (2, "Central", "US", "America")],
        "TerritoryID int, Name string, CountryRegionCode string, `Group` string",
    )
    product = spark.createDataFrame(
        [(1, "Bike", "B-1", D("30.00"), D("20.00"), 1), (2, "Bell", "B-2", D("8.00"), D("9.00"), None), (3, "Gift", "G", D("0.00"), D("1.00"), 1)],
        "ProductID int, Name string, ProductNumber string, ListPrice decimal(10,2), StandardCost decimal(10,2), "
        "ProductSubcategoryID int",
    )
    subcategory = spark.createDataFrame([(1, "Road", 9)], "ProductSubcategoryID int, Name string, ProductCategoryID int")
    category = spark.createDataFrame([(1, "Bikes")], "ProductCategoryID int, Name string")
    customer = spark.createDataFrame([(10, 100), (11, None), (11, None), (12, 999)], "CustomerID int, PersonID int")
    person = spark.createDataFrame([(100, "Ann", "Lee")], "BusinessEntityID int, FirstName string, LastName string")
    return dict(
        header=header,
        detail=detail,
        territory=territory,
        product=product,
        subcategory=subcategory,
        category=category,
        customer=customer,
        person=person,
    )


def pick(shop, *names):
    return [shop[n] for n in names]


def test_order_lines_filter(shop):
    tables = pick(shop, "header", "detail", "territory")
    ids = lambda **k: sorted(r[0] for r in sales.order_lines(*tables, **k).select("SalesOrderID").collect())
    assert ids() == [1, 1, 2, 3, 5]
    assert ids(online=False) == [1, 1, 5]


def test_products(shop):
    rows = sales.products(*pick(shop, "product", "subcategory", "category")).orderBy("ProductID").collect()
    assert [(r["ProductID"], r["Category"], r["Subcategory"]) for r in rows] == [(1, "N/A", "Road"), (2, "N/A", "N/A")]


def test_sales_summary(shop):
    lines = sales.order_lines(*pick(shop, "header", "detail", "territory"))
    catalog = sales.products(*pick(shop, "product", "subcategory", "category"))
    rows = {(r["ProductID"], r["TerritoryID"]): r for r in sales.sales_summary(lines, catalog).collect()}
    assert set(rows) == {(1, 1), (2, 2), (2, 1)}
    bike = rows[1, 1]
    # Both totals of the bike lines are unknown; the mean price rounds half up.
    assert (bike["TotalRevenue"], bike["TotalQty"], bike["AvgUnitPrice"]) == (None, 3, D("10.01"))
    assert (bike["Margin"], bike["MarginPct"]) == (D("10.00"), D("33.33"))
    assert rows[2, 1]["TotalRevenue"] == D("10.00")
    fact = sales.sales_fact(sales.sales_summary(lines, catalog), "2026-03-02").first()
    assert fact["BatchDate"] == dt.date(2026, 3, 2)


def test_a_product_listed_twice_counts_twice(shop):
    lines = sales.order_lines(*pick(shop, "header", "detail", "territory"))
    catalog = sales.products(*pick(shop, "product", "subcategory", "category"))
    doubled = sales.sales_summary(lines, catalog.unionAll(catalog)).where("ProductID = 2 AND TerritoryID = 1").first()
    assert (doubled["TotalRevenue"], doubled["TotalQty"], doubled["AvgUnitPrice"]) == (D("20.00"), 4, D("5.00"))


def test_the_joined_rows_are_not_summed_again(shop):
    """Sums of wide rows after the product join would hold the whole summary in the memory of few tasks."""
    lines = sales.order_lines(*pick(shop, "header", "detail", "territory"))
    catalog = sales.products(*pick(shop, "product", "subcategory", "category"))
    once, twice = sales.sales_summary(lines, catalog), sales.sales_summary(lines, catalog.unionAll(catalog))
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")
    # A doubled catalog doubles every sum and keeps types, unknown totals and the mean price.
    assert once.schema == twice.schema
    rows = {(r["ProductID"], r["TerritoryID"]): r for r in once.collect()}
    for r in twice.collect():
        own = rows[r["ProductID"], r["TerritoryID"]]
        assert r["TotalQty"] == 2 * own["TotalQty"] and r["AvgUnitPrice"] == own["AvgUnitPrice"]
        assert r["TotalRevenue"] == (own["TotalRevenue"] and 2 * own["TotalRevenue"])


def test_category_summary_golden(spark):
    rows = [
        (1, "Laptop", 15000000, "Electronics"),
        (2, "Mouse", 250000, "Electronics"),
        (3, "Keyboard", 500000, "Electronics"),
        (4, "Monitor", 3500000, "Electronics"),
        (5, "Buku", 75000, "Education"),
        (6, "Pulpen", 15000, "Education"),
    ]
    df = spark.createDataFrame(rows, "id int, product string, price int, category string")
    assert [tuple(r) for r in sales.category_summary(df).collect()] == [
        ("Electronics", 4, 19250000, 4812500.0),
        ("Education", 2, 90000, 45000.0),
    ]
    assert sales.category_summary(df, with_mean=False).columns == ["category", "total_transaksi", "total_omzet"]


def test_customer_orders(shop):
    rows = rfm.customer_orders(*pick(shop, "header", "detail", "territory")).orderBy("SalesOrderID").collect()
    got = [(r["SalesOrderID"], r["OrderAmount"], r["LineCount"]) for r in rows]
    # Order 1: 2 x 10.00 without discount, and 10.01 less 10 percent.
    assert got == [(1, D("29.0090"), 2), (2, D("4.5000"), 1), (3, D("7.0000"), 1), (5, D("10.0000"), 1)]


def test_customers_keep_one_row_and_unmatched_persons(shop):
    rows = rfm.customers(*pick(shop, "customer", "person")).orderBy("CustomerID").collect()
    assert [(r["CustomerID"], r["CustomerName"], r["IsIndividual"]) for r in rows] == [
        (10, "Ann Lee", True),
        (11, "Store Customer #11", False),
        (12, "Store Customer #12", False),
    ]


def test_rfm_raw_takes_the_latest_territory(shop):
    orders = rfm.customer_orders(*pick(shop, "header", "detail", "territory"))
    people, places = rfm.customers(*pick(shop, "customer", "person")), rfm.territories(shop["territory"])
    ann = rfm.rfm_raw(orders, people, places, "2026-03-01").where("CustomerID = 10").first()
    # Orders 2 and 5 share the latest day; the higher number decides.
    assert (ann["TerritoryID"], ann["TerritoryName"]) == (1, "Northwest")
    assert (ann["Recency"], ann["Frequency"], ann["TenureDays"]) == (28, 3, 31)
    assert (ann["Monetary"], ann["AvgOrderValue"]) == (D("43.51"), D("14.50"))


def test_rfm_fact_scores(spark):
    rows = [(i, 100 - i, i, D(i)) for i in range(1, 9)]
    raw = spark.createDataFrame(rows, "CustomerID int, Recency bigint, Frequency bigint, Monetary decimal(30,2)")
    out = rfm.rfm_fact(raw, "2026-01-01").orderBy("CustomerID").collect()
    assert [r["RFM_Cell"] for r in out] == ["1-1-1"] * 2 + ["2-2-2"] * 2 + ["3-3-3"] * 2 + ["4-4-4"] * 2
    assert [r["Segment"] for r in out][::2] == ["Lost", "At Risk", "Loyal", "Champions"]
    report = rfm.segment_distribution(rfm.rfm_fact(raw, "2026-01-01")).collect()
    assert [tuple(r) for r in report] == [
        ("Champions", 2, D("15.00")),
        ("Loyal", 2, D("11.00")),
        ("At Risk", 2, D("7.00")),
        ("Lost", 2, D("3.00")),
    ]


def test_rfm_v1_ignores_status_and_keeps_named_territories(shop):
    staging = rfm.rfm_v1_staging(*pick(shop, "header", "detail", "territory"), shop["customer"].distinct(), shop["person"])
    rows = {r["SalesOrderID"]: r for r in staging.collect()}
    assert set(rows) == {1, 3, 4, 5}
    assert rows[1]["OrderAmount"] is None and rows[1]["CustomerName"] == "Ann Lee"
    assert rows[3]["CustomerName"] is None
    scored = rfm.rfm_v1_scored(staging, "2026-03-02").collect()
    assert len(scored) == 4
    # A NULL amount sorts first in the descending monetary order, as in its database.
    assert next(r for r in scored if r["Monetary"] is None)["M_Score"] == 1
    assert "LoadTimestamp" in rfm.rfm_v1_fact(rfm.rfm_v1_scored(staging, "2026-03-02")).columns


# --- weather ------------------------------------------------------------------------------------


def weather_row(dataset, location, date, **given):
    row = {name: None for name in RECORD_SCHEMA.fieldNames()}
    row |= {"dataset": dataset, "location": location, "province": "P", "island": "I", "date": date}
    row |= {"latitude": 1.0, "longitude": 2.0, "peatland_flag": False, **given}
    return tuple(row.values())


def test_archive_wins_even_when_empty(spark):
    rows = [
        weather_row("forecast", "a", "2026-06-01", soil_moisture_avg=0.1),
        weather_row("archive", "a", "2026-06-01"),
        weather_row("forecast", "a", "2026-06-02", soil_moisture_avg=0.3),
    ]
    kept = weather.build_bronze(spark.createDataFrame(rows, RECORD_SCHEMA)).orderBy("date").collect()
    assert [(r["dataset"], r["soil_moisture_avg"]) for r in kept] == [("archive", None), ("forecast", 0.3)]


def star(spark, rows):
    bronze = spark.createDataFrame(rows, RECORD_SCHEMA)
    dates, places = weather.dim_date(bronze), weather.dim_location(bronze)
    return weather.weather_fact(bronze, dates, places), places, dates


def test_rows_without_measures_score_zero_but_peatland(spark):
    facts, places, _ = star(spark, [weather_row("archive", "a", "2026-06-01", peatland_flag=True)])
    row = weather.daily_risk(facts, places).first()
    assert (row["crop_stress_score"], row["drought_risk_score"], row["fire_risk_score"]) == (0, 0, D("5.0"))
    assert (row["drought_risk_level"], row["fire_risk_level"]) == ("low", "low")


def test_extreme_day_reaches_100(spark):
    extreme = dict(
        temperature_2m_max_c=40.0,
        soil_moisture_avg=0.05,
        evapotranspiration_mm=250.0,
        precipitation_sum_mm=0.0,
        relative_humidity_min_pct=20.0,
        wind_speed_10m_max_kmh=35.0,
        peatland_flag=True,
    )
    facts, places, dates = star(spark, [weather_row("archive", "a", "2026-06-01", **extreme)])
    risk = weather.daily_risk(facts, places)
    row = weather.mitigation(risk).first()
    assert (row["drought_risk_score"], row["fire_risk_score"]) == (100, D("100.0"))
    assert row["recommended_action"] == "Evacuation prep & fire patrol"
    assert weather.mitigation_periods(weather.mitigation(risk), places, dates).count() == 1
    assert weather.top_risk(risk, places, "fire_risk_score").first()["peak"] == D("100.0")


@pytest.fixture(scope="module")
def small_star(spark):
    bronze = weather.build_bronze(adapters.weather_records(spark, SMALL, adapters.fixed_places(spark), len(LOCATIONS)))
    dates, places = weather.dim_date(bronze), weather.dim_location(bronze)
    return weather.weather_fact(bronze, dates, places).cache(), places, dates


def test_every_ladder_step_occurs_in_the_test_tables(small_star):
    facts, places, _ = small_star
    risk = weather.daily_risk(facts, places).cache()
    for scheme in (weather.CROP_STRESS, weather.DROUGHT, weather.FIRE):
        for measure, (comparison, steps) in scheme.items():
            seen = {r[0] for r in risk.select(weather.ladder(F.col(measure), comparison, steps, 0)).distinct().collect()}
            assert seen == {points for _, points in steps} | {0}, measure


def test_one_pass_equals_the_join_of_facts(small_star):
    facts, places, _ = small_star
    joined = weather.fire_risk(weather.drought_risk(facts), facts, places)
    one_pass = weather.daily_risk(facts, places).select(*weather.FIRE_COLUMNS)
    assert joined.exceptAll(one_pass).isEmpty() and one_pass.exceptAll(joined).isEmpty()


def test_scores_stay_within_bounds(small_star):
    facts, places, _ = small_star
    risk = weather.mitigation(weather.daily_risk(facts, places))
    low, high = risk.agg(F.min("mitigation_priority_score"), F.max("mitigation_priority_score")).first()
    assert 0 <= low <= high <= 100


def test_reports_are_sorted(small_star):
    facts, places, dates = small_star
    risk = weather.daily_risk(facts, places)
    peaks = [r["peak_drought_risk"] for r in weather.drought_ranking(risk, places, dates, "1996-01-01", "1999-12-31").collect()]
    assert peaks == sorted(peaks, reverse=True) and len(peaks) == places.count()
    periods = weather.mitigation_periods(weather.mitigation(risk), places, dates, 50).collect()
    keys = [(r["full_date"], -r["mitigation_priority_score"]) for r in periods]
    assert keys == sorted(keys)
    trend = weather.climate_trend(facts, places, dates).collect()
    assert [(r["full_date"], r["province"]) for r in trend] == sorted((r["full_date"], r["province"]) for r in trend)
    assert weather.climate_trend(facts, places, dates, "La Nina").isEmpty()
    assert weather.top_risk(risk, places, "drought_risk_score", 3).count() == 3


# --- daily runs ---------------------------------------------------------------------------------


def contents(tables):
    return {
        name: sorted(map(repr, df.drop("LoadTimestamp").collect())) for name, df in tables.items()
    }


def test_runs_are_repeatable(spark, tmp_path):
    landing, store = str(tmp_path / "raw"), str(tmp_path / "store")
    specs = [*SALES_TABLES, *CUSTOMER_TABLES]
    ingest_tables(spark, specs, landing, adapters.AS_OF, adapters.source_reader(spark, SMALL))
    for run in (runs.run_sales, runs.run_rfm):
        first = contents(run(spark, landing, store, adapters.AS_OF))
        assert all(first.values())
        assert contents(run(spark, landing, store, adapters.AS_OF)) == first
    assert (tmp_path / "store" / "export" / "fact_customer_rfm" / f"dt={adapters.AS_OF}").is_dir()
    with pytest.raises(QualityError, match="unreadable"):
        runs.run_sales(spark, landing, store, "2001-08-03")


def test_weather_run_is_repeatable(spark, tmp_path):
    landing, store = str(tmp_path / "raw"), str(tmp_path / "store")
    records = adapters.weather_records(spark, SMALL, adapters.fixed_places(spark), len(LOCATIONS))
    write_landing_json(records, landing, adapters.AS_OF, adapters.STAMP, DATASETS)
    first = contents(runs.run_weather(spark, landing, store, adapters.AS_OF))
    assert len(first) == 11 and all(first.values())
    # A later landing of the same day with the same rows changes nothing.
    write_landing_json(records, landing, adapters.AS_OF, "20010802T010000", DATASETS)
    assert contents(runs.run_weather(spark, landing, store, adapters.AS_OF)) == first


def test_two_places_of_one_name_stop_the_run(spark, tmp_path):
    rows = [weather_row("archive", "a", "2026-06-01"), weather_row("archive", "a", "2026-06-02", latitude=9.0)]
    with pytest.raises(QualityError, match="dim_location"):
        runs.weather_tables(spark.createDataFrame(rows, RECORD_SCHEMA), str(tmp_path))
