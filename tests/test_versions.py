"""Writes that fail or run side by side with readers: folders, tables, database targets, landed runs."""

import logging
import threading

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.operators import QualityError
from rainledger.plans import runs
from rainledger.sinks import (
    current_folder,
    declared_columns,
    ensure_schemas,
    finished_versions,
    read_table,
    rebuild_table,
    replace_typed,
    switching_statement,
    write_landing_json,
    write_partition,
    write_table,
    write_version,
)
from rainledger.sinks.database import side_options, switch_options
from rainledger.sources import DATASETS, cuts, locations, read_folder, read_landing_json, read_partition, share_query, split_predicates
from test_sources import record, records

DAY = "2026-06-27"


def ids(n, start=0):
    return lambda spark: spark.range(start, start + n).toDF("id")


def failing(spark, n=100):
    """Rows of which a later one ends the job, when files of the earlier ones are written."""
    bad = F.raise_error(F.lit("no more")).cast("long")
    return spark.range(0, n, 1, 4).select(F.when(F.col("id") == n - 1, bad).otherwise(F.col("id")).alias("id"))


# --- versioned folders --------------------------------------------------------------------------


def test_a_failed_write_leaves_the_old_day(spark, tmp_path):
    root = str(tmp_path)
    write_partition(ids(5)(spark), root, "t", DAY)
    with pytest.raises(PySparkException):
        write_partition(failing(spark), root, "t", DAY)
    assert read_partition(spark, root, "t", DAY).count() == 5 == read_folder(spark, root).count()
    assert len(finished_versions(spark, f"{root}/t/dt={DAY}")) == 1
    assert write_partition(ids(7)(spark), root, "t", DAY) == 7 == read_partition(spark, root, "t", DAY).count()


def test_a_failed_first_write_leaves_no_day(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(PySparkException):
        write_partition(failing(spark), root, "t", DAY)
    with pytest.raises(PySparkException):
        read_partition(spark, root, "t", DAY).count()


def test_readers_keep_one_whole_version(spark, tmp_path):
    root, seen, stop = str(tmp_path), set(), threading.Event()
    write_table(ids(10)(spark), root, "silver", "t")

    def read():
        while not stop.is_set():
            rows = read_table(spark, root, "silver", "t").agg(F.count("id"), F.min("id")).first()
            seen.add(tuple(rows))

    reader = threading.Thread(target=read)
    reader.start()
    old = read_table(spark, root, "silver", "t")
    for start in (100, 200, 300):
        write_table(ids(start // 10, start)(spark), root, "silver", "t")
        if start == 100:
            assert old.count() == 10  # a reader that had begun
    stop.set()
    reader.join()
    assert seen <= {(10, 0), (10, 100), (20, 200), (30, 300)}
    assert read_table(spark, root, "silver", "t").count() == 30


def test_a_table_may_be_rebuilt_from_itself(spark, tmp_path):
    root = str(tmp_path)
    table = write_table(ids(3)(spark), root, "silver", "t")
    for _ in range(4):
        table = write_table(table.select((F.col("id") + 1).alias("id"), F.lit("x").alias("added")), root, "silver", "t")
    assert sorted(r["id"] for r in read_table(spark, root, "silver", "t").collect()) == [4, 5, 6]


def test_old_versions_are_emptied(spark, tmp_path):
    place = tmp_path / "t"
    for n in range(1, 5):
        write_version(spark.range(n * 10).repartition(2), str(place))
    sizes = sorted(spark.read.parquet(str(p)).count() for p in place.glob("_v-*"))
    assert sizes == [0, 0, 30, 40]
    assert spark.read.parquet(current_folder(spark, str(place))).count() == 40


def test_of_two_writers_the_last_to_finish_counts(spark, tmp_path, monkeypatch):
    place, times = str(tmp_path / "t"), iter([2000, 1000])  # the second writer's clock is behind
    monkeypatch.setattr("rainledger.sinks.versions.time.time_ns", lambda: next(times))
    write_version(spark.range(1), place)
    write_version(spark.range(2), place)
    assert spark.read.parquet(current_folder(spark, place)).count() == 2


def test_plain_folders_are_read_as_they_are(spark, tmp_path):
    root = str(tmp_path / "a b")  # names with spaces too
    spark.range(4).write.parquet(f"{root}/t/dt={DAY}")
    write_partition(spark.range(6), root, "u", DAY)
    write_partition(spark.range(2), root, "u", DAY)
    assert read_partition(spark, root, "t", DAY).count() == 4
    assert read_partition(spark, root, "t", DAY).columns == ["id", "dt"] == read_partition(spark, root, "u", DAY).columns
    assert read_folder(spark, root).count() == 6


# --- catalog tables -----------------------------------------------------------------------------


def test_a_failed_rebuild_keeps_the_old_rows(spark):
    ensure_schemas(spark, ["versions_rebuild"])
    name = "versions_rebuild.t"
    rebuild_table(ids(3)(spark), name)
    with pytest.raises(PySparkException):
        rebuild_table(failing(spark), name)
    assert spark.table(name).count() == 3
    assert rebuild_table(spark.table(name).withColumn("more", F.lit("x")), name).columns == ["id", "more"]
    with pytest.raises(PySparkException):
        rebuild_table(failing(spark), name)
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 3


def test_loads_before_the_last_are_emptied(spark):
    ensure_schemas(spark, ["versions_loads"])
    home = spark.catalog.getDatabase("versions_loads").locationUri.removeprefix("file:")
    for n in (1, 2, 3, 4):
        rebuild_table(spark.range(n * 10), "versions_loads.t")
    from pathlib import Path

    assert sorted(spark.read.parquet(str(p)).count() for p in Path(home).glob("t/load=*")) == [0, 0, 30, 40]


TYPED = T.StructType(
    [T.StructField("id", T.IntegerType(), False), T.StructField("name", T.VarcharType(5)), T.StructField("code", T.CharType(2))]
)


def named(spark, *rows):
    return spark.createDataFrame(rows, "id long, name string, code string")


def test_an_overlong_text_ends_the_load(spark, tmp_path):
    ensure_schemas(spark, ["versions_typed"], str(tmp_path / "db"))
    folder, name = str(tmp_path / "loads"), "versions_typed.t"
    replace_typed(named(spark, (1, "12345", "ab"), (2, None, "é")), name, TYPED, folder, ["id"])
    for bad in ((3, "123456", "ab"), (4, "x", "abc")):
        with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH"):
            replace_typed(named(spark, bad), name, TYPED, folder, ["id"])
    assert {(r["id"], r["name"], r["code"]) for r in spark.table(name).collect()} == {(1, "12345", "ab"), (2, None, "é ")}
    assert declared_columns(spark, name) == [("id", "int"), ("name", "varchar(5)"), ("code", "char(2)")]
    assert [t.name for t in spark.catalog.listTables("versions_typed")] == ["t"]  # no side table is left


def test_a_table_of_another_declaration_is_declared_anew(spark, tmp_path):
    ensure_schemas(spark, ["versions_other"], str(tmp_path / "db"))
    folder, name = str(tmp_path / "loads"), "versions_other.t"
    spark.sql(f"CREATE TABLE {name} (id STRING, gone INT) USING parquet LOCATION '{tmp_path}/old'")
    with pytest.raises(QualityError):
        replace_typed(named(spark, (1, "a", "b"), (1, "a", "b")), name, TYPED, folder, ["id"])
    assert declared_columns(spark, name) == [("id", "string"), ("gone", "int")]
    loaded = replace_typed(named(spark, (1, "a", "b")), name, TYPED, folder, ["id"])
    assert dict(loaded.dtypes)["id"] == "int" and declared_columns(spark, name)[1] == ("name", "varchar(5)")


# --- database targets: no database here, so the statements and options are checked ---------------


def test_switching_statements():
    body = 'DELETE FROM dwh.t; INSERT INTO dwh.t ("A", "b") SELECT "A", "b" FROM dwh.t__load;'
    assert switching_statement("jdbc:postgresql://h/db", "dwh.t", ["A", "b"]) == f"DO $$ BEGIN {body} END $$"
    assert switching_statement("jdbc:other:x", "dwh.t", ["A", "b"]) == f"BEGIN ATOMIC {body} END"
    assert "BEGIN TRANSACTION; DELETE FROM dwh.t; INSERT INTO dwh.t ([A])" in switching_statement("jdbc:sqlserver://h", "dwh.t", ["A"])
    with pytest.raises(ValueError, match="mysql"):
        switching_statement("jdbc:mysql://h/db", "t", ["a"])


def test_side_table_and_switch_options():
    side = side_options("jdbc:postgresql://h/db", "dwh.t", {"user": "u"})
    assert (side["dbtable"], side["user"]) == ("dwh.t__load", "u") and "sessionInitStatement" not in side
    switch = switch_options("jdbc:postgresql://h/db", "dwh.t", "DO 1", {"user": "u"})
    assert (switch["sessionInitStatement"], switch["user"]) == ("DO 1", "u")
    assert switch["query"] == "SELECT COUNT(*) AS row_count FROM dwh.t"


def test_a_repeated_switch_changes_nothing():
    """The statements inside, run in order by another engine: twice the same rows, and all or none."""
    db = duckdb.connect()
    db.execute("CREATE SCHEMA dwh; CREATE TABLE dwh.t (a INT PRIMARY KEY, b VARCHAR); INSERT INTO dwh.t VALUES (1, 'old')")
    db.execute("CREATE TABLE dwh.t__load (b VARCHAR, a INT); INSERT INTO dwh.t__load VALUES ('x', 1), ('y', 2)")
    body = switching_statement("jdbc:other:x", "dwh.t", ["a", "b"]).removeprefix("BEGIN ATOMIC ").removesuffix(" END")
    for _ in range(2):
        db.execute(body)
        assert db.execute("SELECT * FROM dwh.t ORDER BY a").fetchall() == [(1, "x"), (2, "y")]


def test_shares_of_a_skewed_key_are_equal():
    """The grouped query and the predicates, run by another engine over a table whose keys are uneven."""
    db = duckdb.connect()
    db.execute('CREATE SCHEMA "S"; CREATE TABLE "S"."T" AS SELECT CASE WHEN i < 900 THEN i ELSE 1000000 + i * 1000 END AS "K" FROM range(1000) r(i)')
    db.execute('INSERT INTO "S"."T" SELECT NULL FROM range(5)')
    bounds = cuts([low for _, low in db.execute(share_query("jdbc:x", "S", "T", "K", 10)).fetchall()])
    assert len(bounds) == 9
    counts = [db.execute(f'SELECT COUNT(*) FROM "S"."T" WHERE {p}').fetchone()[0] for p in split_predicates("K", bounds)]
    assert sum(counts) == 1005 and max(counts) <= 105
    assert cuts([]) == [] and cuts([3, 3, 3]) == [] and cuts([1, 5, 5, 5, 9]) == [5, 9]
    assert split_predicates("k", ["it's"]) == ["\"k\" < 'it''s' OR \"k\" IS NULL", "\"k\" >= 'it''s'"]


def test_equal_shares_ask_the_database(spark):
    from rainledger.sources import read_jdbc

    with pytest.raises(Exception, match="No suitable driver"):
        read_jdbc(spark, "jdbc:none://host/db", "S", "T", key="K", slices=4, even=True)


# --- landed runs --------------------------------------------------------------------------------


def test_the_same_run_again_lands_its_records_once(spark, tmp_path):
    root = str(tmp_path)
    rows = [record(location=place, soil_moisture_avg=0.1) for place in ("jakarta", "medan")]
    write_landing_json(records(spark, rows), root, DAY, "20260627T010000", DATASETS)
    write_landing_json(records(spark, [record(soil_moisture_avg=0.5)]), root, DAY, "20260627T020000", DATASETS)
    for row in rows:
        row["soil_moisture_avg"] = 0.2
    write_landing_json(records(spark, rows), root, DAY, "20260627T010000", DATASETS)
    landed = sorted((r["ts"], r["location"], r["soil_moisture_avg"]) for r in read_landing_json(spark, root, DAY, DATASETS).collect())
    assert landed == [("20260627T010000", "jakarta", 0.2), ("20260627T010000", "medan", 0.2), ("20260627T020000", "jakarta", 0.5)]


def test_a_run_warns_of_payloads_without_days(spark, tmp_path, caplog):
    body = '{"daily": {"time": ["2026-06-26"], "temperature_2m_max": [30.0]}}'
    raw = [("archive", "jakarta", body), ("forecast", "jakarta", "{}"), ("archive", "medan", '{"daily": {"time": []}}'), ("archive", "mars", body)]
    frame = spark.createDataFrame(raw, "dataset string, location_key string, body string")
    with caplog.at_level(logging.WARNING):
        report = runs.run_landing(frame, locations(spark), str(tmp_path), DAY, "20260627T010000")
    assert report["payloads"] == 4 and report["without_days"] == ["archive/medan", "forecast/jakarta"]
    assert [r.getMessage().split(":")[0] for r in caplog.records if r.name.endswith("runs")] == ["archive/medan", "forecast/jakarta", "archive/mars"]
    assert [(r["location"], r["date"]) for r in read_landing_json(spark, str(tmp_path), DAY, DATASETS).collect()] == [("jakarta", "2026-06-26")]
    with caplog.at_level(logging.WARNING):
        caplog.clear()
        report = runs.run_landing(frame.where("body like '%2026%' and location_key <> 'mars'"), locations(spark), str(tmp_path / "b"), DAY, "20260627T010000")
    assert report["payloads"] == 1 and not [r for r in caplog.records if r.name.endswith("runs")]


def test_profile_tells_corrupt_bodies_from_empty_ones(spark):
    from rainledger.sources.payload import payload_profile

    bodies = ['{"daily": {"time": ["2026-06-26"]}}', "{}", "", None, '{"daily": ', "no json", '{"daily": {"time": 5}}']
    raw = spark.createDataFrame([("archive", str(i), b) for i, b in enumerate(bodies)], "dataset string, location_key string, body string")
    found = {int(r["location_key"]): (r["days"], r["corrupt"]) for r in payload_profile(raw).collect()}
    assert found == {0: (1, 0), 1: (0, 0), 2: (0, 0), 3: (0, 0), 4: (0, 1), 5: (0, 1), 6: (0, 1)}
