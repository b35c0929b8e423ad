"""Values keep the scale of their source, and unreadable input ends a run."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from rainledger import functions as fn
from rainledger.operators.quality import QualityError
from rainledger.plans import sales
from rainledger.sinks import conform
from rainledger.sources import flatten_daily_payload, jdbc_reader, read_folder, read_landing_json
from rainledger.sources import jdbc
from rainledger.sources.payload import payload_profile


def _lines(spark, totals):
    rows = [(1, i, 7, 1, D("10.0000"), D(t), 3, "North", "US") for i, t in enumerate(totals)]
    kinds = "SalesOrderID int, SalesOrderDetailID int, ProductID int, OrderQty int, UnitPrice decimal(19,4), " \
        "LineTotal decimal(28,6), TerritoryID int, TerritoryName string, CountryRegionCode string"
    return spark.createDataFrame(rows, kinds).withColumn("OrderDate", F.lit("2026-01-01").cast("date"))


def _catalog(spark):
    product = spark.createDataFrame(
        [(7, "Bike", "B-7", D("3578.2700"), D("2171.2942"), None)],
        "ProductID int, Name string, ProductNumber string, ListPrice decimal(19,4), StandardCost decimal(19,4), "
        "ProductSubcategoryID int",
    )
    sub = spark.createDataFrame([], "ProductSubcategoryID int, Name string, ProductCategoryID int")
    return sales.products(product, sub, spark.createDataFrame([], "ProductCategoryID int, Name string"))


def test_costs_keep_four_decimals_and_sums_round_once(spark):
    catalog = _catalog(spark)
    assert catalog.first()["StandardCost"] == D("2171.2942")
    row = sales.sales_summary(_lines(spark, ["0.100040"] * 1000), catalog).first()
    assert row["TotalRevenue"] == D("100.04")
    assert row["Margin"] == D("1406.98")


def test_declared_totals_round_once(spark):
    typed = conform(_lines(spark, ["10.004950"]), sales.TYPED_LINES)
    assert typed.first()["LineTotal"] == D("10.00")


def test_small_values_keep_their_mean(spark):
    df = spark.createDataFrame([(0.00004,), (0.00004,)], "x double")
    assert df.agg(fn.exact_mean(F.col("x"))).first()[0] == 0.00004


@pytest.mark.parametrize("text", ["not json\n", '[{"dataset": "archive"\n', '[\n  {"dataset": "archive"}\n]\n'])
def test_unreadable_landed_lines_raise(spark, tmp_path, text):
    folder = tmp_path / "archive" / "location=medan" / "ingestion_date=2026-01-01" / "ts=20260101T000000"
    folder.mkdir(parents=True)
    (folder / "part.json").write_text('{"dataset": "archive", "date": "2026-01-01"}\n' + text)
    with pytest.raises(Exception, match="(?i)malformed|json"):
        read_landing_json(spark, str(tmp_path), "2026-01-01", ["archive"]).collect()
    with pytest.raises(QualityError):
        read_landing_json(spark, str(tmp_path), "2026-01-01", ["archive", "forecast"], ["forecast"])


def test_payloads_are_reported_or_raise(spark):
    raw = spark.createDataFrame(
        [
            ("archive", "medan", '{"daily": {"time": ["2026-01-01"], "temperature_2m_max": [1.0, 2.0]}}'),
            ("forecast", "medan", '{"daily": {}}'),
        ],
        "dataset string, location_key string, body string",
    )
    found = {r["dataset"]: tuple(r)[2:] for r in payload_profile(raw).collect()}
    assert found == {"archive": (1, 6, 1, 0), "forecast": (0, 7, 0, 0)}
    places = spark.createDataFrame(
        [("medan", "medan", "p", "i", 1.0, 2.0, False)],
        "location_key string, location_name string, province string, island string, latitude double, longitude double, "
        "peatland_flag boolean",
    )
    broken = raw.withColumn("body", F.lit("{broken"))
    with pytest.raises(Exception, match="(?i)malformed"):
        flatten_daily_payload(broken, places).collect()


def test_folders_keep_the_columns_of_all_files(spark, tmp_path):
    spark.range(1).selectExpr("id AS a").write.parquet(str(tmp_path / "x"))
    spark.range(1).selectExpr("id AS a", "id AS b").write.parquet(str(tmp_path / "y"))
    assert sorted(read_folder(spark, str(tmp_path)).columns) == ["a", "b"]


def test_jdbc_bounds_keep_the_fetch_size(monkeypatch):
    seen = {}

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            seen.update(table=table, cuts=len(predicates), **properties)

    class Session:
        read = Reader()

    spec = type("Spec", (), {"schema": "s", "table": "t", "key": "k"})
    jdbc_reader(Session(), "jdbc:x", 8, {"t": [1, 5]}, user="u")(spec)
    assert seen == {"table": '"s"."t"', "cuts": 3, "fetchsize": jdbc.FETCH_ROWS, "user": "u"}
