import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.jobs import in_parallel
from rainledger.operators import QualityError
from rainledger.sinks import (
    conform,
    ensure_schemas,
    read_table,
    rebuild_table,
    recreate_views,
    replace_typed,
    shared_folder,
    stage,
    staging_scope,
    with_audit,
    write_by_region,
    write_table,
)

TYPED = T.StructType(
    [T.StructField("id", T.IntegerType(), False), T.StructField("amount", T.DecimalType(12, 2), True)]
)


def amounts(spark, *rows):
    return spark.createDataFrame([(i, D(a) if a else None) for i, a in rows], "id long, amount decimal(18,4)")


def test_stage_uses_the_named_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    staged = stage(spark.range(5).toDF("id"), "numbers")
    assert staged.count() == 5 and all(folder in f for f in staged.inputFiles())


def test_scope_deletes_what_was_staged_inside(spark, tmp_path):
    outside = stage(spark.range(3).toDF("id"), "outside")
    with pytest.raises(RuntimeError), staging_scope(spark):
        inside = stage(spark.range(4).toDF("id"), "inside")
        kept = write_table(inside, str(tmp_path), "silver", "t")
        raise RuntimeError
    assert (outside.count(), kept.count()) == (3, 4)
    with pytest.raises(Exception, match="(?i)not.*exist|FILE_NOT_EXIST"):
        inside.collect()


def test_scope_covers_tables_staged_by_its_threads(spark):
    with staging_scope(spark):
        staged = in_parallel(spark, lambda n: stage(spark.range(n).toDF("id"), "thread"), [1, 2, 3])
        assert [df.count() for df in staged] == [1, 2, 3]
    for df in staged:
        with pytest.raises(Exception, match="(?i)not.*exist|FILE_NOT_EXIST"):
            df.collect()


def test_conform_rounds_half_up(spark):
    rows = conform(amounts(spark, (1, "1.005"), (2, "-1.005"), (3, None)), TYPED).orderBy("id").collect()
    assert [r["amount"] for r in rows] == [D("1.01"), D("-1.01"), None]


def test_typed_load_switches_or_stays(spark, tmp_path):
    ensure_schemas(spark, ["typed_test"], str(tmp_path / "db"))
    folder = str(tmp_path / "loads")
    first = replace_typed(amounts(spark, (1, "1"), (2, "2")), "typed_test.t", TYPED, folder, ["id"])
    assert first.count() == 2 and dict(first.dtypes) == {"id": "int", "amount": "decimal(12,2)"}
    with pytest.raises(QualityError, match="more than once"):
        replace_typed(amounts(spark, (3, "1"), (3, "2")), "typed_test.t", TYPED, folder, ["id"])
    with pytest.raises(QualityError, match="required"):
        replace_typed(amounts(spark, (None, "1")), "typed_test.t", TYPED, folder)
    assert {r["id"] for r in spark.table("typed_test.t").collect()} == {1, 2}
    replace_typed(amounts(spark, (7, "1")), "typed_test.t", TYPED, folder, ["id"])
    assert {r["id"] for r in spark.table("typed_test.t").collect()} == {7}


def test_rebuild_is_repeatable_and_may_change_columns(spark):
    ensure_schemas(spark, ["rebuild_test"])
    rebuild_table(spark.range(3).toDF("a"), "rebuild_test.t")
    assert rebuild_table(spark.range(3).toDF("a"), "rebuild_test.t").count() == 3
    assert rebuild_table(spark.range(4).toDF("b"), "rebuild_test.t").columns == ["b"]


def test_layer_tables(spark, tmp_path):
    root = str(tmp_path)
    write_table(spark.range(3).toDF("a"), root, "silver", "t")
    again = write_table(spark.range(5).toDF("a"), root, "silver", "t")
    assert again.count() == 5 == read_table(spark, root, "silver", "t").count()


def test_views_are_replaced(spark):
    assert recreate_views({"v": spark.range(1).toDF("id")}) == ["bronze_v"]
    recreate_views({"v": spark.range(2).toDF("id")})
    assert spark.table("bronze_v").count() == 2


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_regions_get_their_own_folder(spark, tmp_path, file_format):
    df = spark.createDataFrame([("US", 1), ("US", 2), ("EU", 3)], "region string, order_id int")
    write_by_region(df, str(tmp_path / "out"), file_format)
    assert {p.name for p in (tmp_path / "out").glob("region=*")} == {"region=US", "region=EU"}
    back = spark.read.schema("order_id int, region string").option("header", True).format(file_format)
    assert {tuple(r) for r in back.load(str(tmp_path / "out")).collect()} == {(1, "US"), (2, "US"), (3, "EU")}


def test_other_formats_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="xlsx"):
        write_by_region(spark.range(1).selectExpr("'US' AS region", "id"), str(tmp_path / "out"), "xlsx")


def test_audit_columns(spark):
    row = with_audit(spark.range(1), "2026-01-02").first()
    assert row["BatchDate"] == dt.date(2026, 1, 2) and isinstance(row["LoadTimestamp"], dt.datetime)
    assert "BatchDate" not in with_audit(spark.range(1)).columns


def test_staging_leaves_no_shuffle_files_and_the_session_as_it_was(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    counted = lambda n: spark.range(1000).groupBy((F.col("id") % n).alias("k")).count()
    staged = in_parallel(spark, lambda n: stage(counted(n), "counted"), [3, 5, 7])
    assert [df.count() for df in staged] == [3, 5, 7] and spark.conf.get(key, None) == before
    spark.conf.set(key, "false")
    stage(counted(2), "counted")
    assert spark.conf.get(key) == "false"
    spark.conf.unset(key) if before is None else spark.conf.set(key, before)
