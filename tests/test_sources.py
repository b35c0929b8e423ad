import json

import pytest
from pyspark.sql import functions as F

from rainledger.operators import QualityError
from rainledger.plans import weather
from rainledger.sinks import write_jdbc, write_landing_json, write_partition
from rainledger.sources import (
    DATASETS,
    LOCATIONS,
    RECORD_SCHEMA,
    SALES_TABLES,
    assert_readable,
    count_jdbc,
    flatten_daily_payload,
    ingest_plan,
    ingest_tables,
    inline_rows,
    jdbc_options,
    locations,
    payloads_without_days,
    read_folder,
    read_jdbc,
    read_landing_json,
    read_partition,
    regional_orders,
    split_predicates,
    validate_manifest,
)

DAY = "2026-06-27"


def record(**given):
    return {name: None for name in RECORD_SCHEMA.fieldNames()} | {
        "dataset": "archive",
        "location": "jakarta",
        "date": "2026-06-26",
        **given,
    }


def records(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], RECORD_SCHEMA)


# --- payloads -----------------------------------------------------------------------------------


def flattened(spark, body, key="jakarta"):
    raw = spark.createDataFrame([("forecast", key, json.dumps(body))], "dataset string, location_key string, body string")
    return flatten_daily_payload(raw, locations(spark)).orderBy("date").collect()


def test_payload_with_few_variables(spark):
    daily = {
        "time": ["2026-06-26", "2026-06-27"],
        "temperature_2m_max": [32.1, 31.8],
        "precipitation_sum": [0.0, 1.2],
    }
    first, second = flattened(spark, {"latitude": -6.2, "longitude": 106.8, "daily": daily})
    assert (first["date"], first["temperature_2m_max_c"], first["precipitation_sum_mm"]) == ("2026-06-26", 32.1, 0.0)
    assert (second["date"], second["temperature_2m_max_c"], second["precipitation_sum_mm"]) == ("2026-06-27", 31.8, 1.2)
    assert first["temperature_2m_mean_c"] is None and first["soil_moisture_avg"] is None
    assert (first["province"], first["latitude"]) == ("DKI Jakarta", -6.2088)


@pytest.mark.parametrize("top, low, mean", [(28.0625, 28.0625, 28.062), (28.1875, 28.1875, 28.188), (None, 20.0, None)])
def test_payload_mean_rounds_half_even(spark, top, low, mean):
    daily = {"time": ["2026-06-26"], "temperature_2m_max": [top], "temperature_2m_min": [low]}
    assert flattened(spark, {"daily": daily})[0]["temperature_2m_mean_c"] == mean


def test_payload_arrays_of_other_lengths(spark):
    daily = {"time": ["2026-06-26", "2026-06-27"], "temperature_2m_max": [30.0], "precipitation_sum": [1.0, 2.0, 3.0]}
    rows = flattened(spark, {"daily": daily})
    assert [(r["temperature_2m_max_c"], r["precipitation_sum_mm"]) for r in rows] == [(30.0, 1.0), (None, 2.0)]


@pytest.mark.parametrize("body", [{}, {"daily": {}}, {"daily": {"time": []}}, {"daily": None}])
def test_payload_without_days_gives_no_rows(spark, body):
    assert flattened(spark, body) == []
    raw = spark.createDataFrame(
        [("forecast", "medan", json.dumps(body)), ("archive", "medan", '{"daily": {"time": ["2026-06-26"]}}')],
        "dataset string, location_key string, body string",
    )
    assert [tuple(r) for r in payloads_without_days(raw).collect()] == [("forecast", "medan")]


# --- fixed tables -------------------------------------------------------------------------------


def test_locations(spark):
    rows = locations(spark).collect()
    assert len(rows) == len(LOCATIONS) == 15
    assert sorted(r["location_key"] for r in rows if r["peatland_flag"]) == ["palangkaraya", "pekanbaru", "samarinda"]


def test_ingest_plan_covers_every_pair(spark):
    plan = ingest_plan(locations(spark), "2026-06-27").collect()
    assert len(plan) == 30
    archive = next(r for r in plan if r["dataset"] == "archive" and r["location_key"] == "medan")
    assert (str(archive["start_date"]), str(archive["end_date"])) == ("2025-06-28", "2026-06-27")
    assert archive["forecast_days"] is None
    assert {(r["start_date"], r["forecast_days"]) for r in plan if r["dataset"] == "forecast"} == {(None, 14)}


def test_regional_orders(spark):
    regions = inline_rows(spark, [("US",), ("EU",)], "region string")
    rows = regional_orders(regions).where("region = 'EU'").orderBy("order_id").collect()
    assert [(r["order_id"], r["amount"]) for r in rows] == [(1, 100), (2, 250), (3, 75), (4, 300), (5, 150)]


# --- landed JSON --------------------------------------------------------------------------------


def test_landing_round_trip_keeps_every_field(spark, tmp_path):
    rows = [record(location="a b/c=d", peatland_flag=True, soil_moisture_avg=0.25), record(dataset="forecast")]
    write_landing_json(records(spark, rows), str(tmp_path), DAY, "20260627T010203", DATASETS)
    back = read_landing_json(spark, str(tmp_path), DAY, DATASETS)
    assert {r["ts"] for r in back.collect()} == {"20260627T010203"}
    assert back.drop("ts").exceptAll(records(spark, rows)).isEmpty() and back.count() == 2


def test_landing_appends_and_reads_one_day(spark, tmp_path):
    root = str(tmp_path)
    write_landing_json(records(spark, [record(soil_moisture_avg=0.1)]), root, DAY, "20260627T010000", DATASETS)
    write_landing_json(records(spark, [record(soil_moisture_avg=0.2)]), root, DAY, "20260627T020000", DATASETS)
    write_landing_json(records(spark, [record(soil_moisture_avg=0.3)]), root, "2026-06-28", "20260628T010000", DATASETS)
    day = read_landing_json(spark, root, DAY, DATASETS)
    assert sorted(r["soil_moisture_avg"] for r in day.collect()) == [0.1, 0.2]
    # The newest file of the day wins.
    assert [r["soil_moisture_avg"] for r in weather.build_bronze(day).collect()] == [0.2]


def test_files_holding_one_array_are_read_too(spark, tmp_path):
    folder = tmp_path / "archive" / "location=jakarta" / f"ingestion_date={DAY}"
    folder.mkdir(parents=True)
    (folder / "20260627T030405.json").write_text(json.dumps([record(), record(date="2026-06-25")]))
    back = read_landing_json(spark, str(tmp_path), DAY, DATASETS).collect()
    assert sorted((r["ts"], r["date"]) for r in back) == [
        ("20260627T030405", "2026-06-25"),
        ("20260627T030405", "2026-06-26"),
    ]


def test_missing_or_empty_landing_fails(spark, tmp_path):
    with pytest.raises(QualityError, match="no landed files"):
        read_landing_json(spark, str(tmp_path), DAY, DATASETS)
    folder = tmp_path / "archive" / "location=jakarta" / f"ingestion_date={DAY}"
    folder.mkdir(parents=True)
    (folder / "20260627T030405.json").write_text("[]")
    with pytest.raises(QualityError, match="no rows"):
        read_landing_json(spark, str(tmp_path), DAY, DATASETS)


# --- landed Parquet -----------------------------------------------------------------------------


def test_partition_rerun_replaces_its_day_only(spark, tmp_path):
    root = str(tmp_path)
    assert write_partition(spark.range(5).toDF("id"), root, "t", "2026-01-01") == 5
    assert write_partition(spark.range(7).toDF("id"), root, "t", "2026-01-02") == 7
    assert write_partition(spark.range(2).toDF("id"), root, "t", "2026-01-01") == 2
    assert read_partition(spark, root, "t", "2026-01-01").count() == 2
    assert read_partition(spark, root, "t", "2026-01-02").count() == 7
    assert write_partition(spark.range(0).toDF("id"), root, "t", "2026-01-02") == 0
    assert read_partition(spark, root, "t", "2026-01-02").count() == 0
    assert read_folder(spark, root).count() == 2


def test_readable_names_every_missing_table(spark, tmp_path):
    root = str(tmp_path)
    write_partition(spark.range(5).toDF("id"), root, "here", "2026-01-01")
    assert assert_readable(spark, root, ["here"], "2026-01-01") == {"here": 5}
    with pytest.raises(QualityError, match="gone_a.*gone_b"):
        assert_readable(spark, root, ["gone_a", "here", "gone_b"], "2026-01-01")


def test_ingest_and_validation(spark, tmp_path):
    root = str(tmp_path)

    def reader(spec):
        stamp = F.lit("2026-01-01 00:00:00").cast("timestamp")
        return spark.range(len(spec.table)).select("id", stamp.alias("changed"))

    manifest = ingest_tables(spark, SALES_TABLES, root, DAY, reader)
    assert {(r["table"], r["path"], r["rows"], r["columns"]) for r in manifest.collect()} == {
        (s.table, f"{s.folder}/dt={DAY}", len(s.table), 2) for s in SALES_TABLES
    }
    assert dict(read_partition(spark, root, "product", DAY).dtypes)["changed"] == "timestamp_ntz"
    assert validate_manifest(spark, manifest, root).count() == len(SALES_TABLES)
    # Both a short and a missing table are reported, in one error.
    write_partition(spark.range(1).toDF("id"), root, "product", DAY)
    gone = manifest.withColumn("folder", F.when(F.col("table") == "SalesTerritory", "gone").otherwise(F.col("folder")))
    with pytest.raises(QualityError, match="SalesTerritory.*Product"):
        validate_manifest(spark, gone, root)
    with pytest.raises(QualityError, match="empty"):
        validate_manifest(spark, manifest.where("false"), root)
    with pytest.raises(QualityError, match="no tables"):
        ingest_tables(spark, [], root, DAY, reader)


# --- JDBC: no database here, so the options are checked -----------------------------------------


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "Sales", "SalesOrderHeader")
    assert plain["dbtable"] == '"Sales"."SalesOrderHeader"' and "numPartitions" not in plain
    sliced = jdbc_options("jdbc:x", "S", "T", key="K", lowest=1, highest=90, slices=8, extra={"user": "u"})
    assert (sliced["partitionColumn"], sliced["lowerBound"], sliced["upperBound"]) == ("K", "1", "90")
    assert (sliced["numPartitions"], sliced["user"]) == ("8", "u")
    assert jdbc_options("jdbc:mysql://h/db", "shop", "dim_customers")["dbtable"] == "`shop`.`dim_customers`"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "S", "T", key="K", slices=8)


@pytest.mark.parametrize("how", [{}, {"key": "K", "bounds": [10, 20]}, {"key": "K", "slices": 4}])
def test_jdbc_scan_reaches_the_driver(spark, how):
    with pytest.raises(Exception, match="No suitable driver"):
        read_jdbc(spark, "jdbc:none://host/db", "Sales", "SalesOrderHeader", **how)
    with pytest.raises(Exception, match="No suitable driver"):
        count_jdbc(spark, "jdbc:none://host/db", "public", "dim_customers")
    with pytest.raises(Exception, match="No suitable driver"):
        write_jdbc(spark.range(1), "jdbc:none://host/db", "dwh.t")


def test_split_predicates_cover_every_key_once(spark):
    predicates = split_predicates("k", [10, 20, 30])
    df = spark.createDataFrame([(k,) for k in [None, 0, 9, 10, 19, 20, 29, 30, 99]], "k int")
    hits = sum(F.coalesce(F.expr(p.replace('"', "`")), F.lit(False)).cast("int") for p in predicates)
    assert {r[0] for r in df.select(hits).collect()} == {1}
    assert split_predicates("k", []) == ["1 = 1"]
