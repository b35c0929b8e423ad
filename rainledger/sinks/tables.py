"""Catalog tables and views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import assert_no_nulls, assert_unique
from .versions import empty

LAYERS = ("bronze", "silver", "gold")
# Table properties that name the folders of the last two loads.
_LAST, _FORMER = "rainledger.load", "rainledger.former"


def ensure_schemas(spark: SparkSession, names: Sequence[str] = LAYERS, root: str | None = None) -> None:
    """Create missing schemas, below ``root`` if given, else in the session's warehouse."""
    for name in names:
        place = f" LOCATION '{root}/{name}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def rebuild_table(df: DataFrame, name: str) -> DataFrame:
    """Rebuild a table from ``df``; running it again gives the same table.

    The rows are loaded into a folder of their own below the schema's. A load that fails leaves the table as it was, and
    ``df`` may read the table. Columns may change.
    """
    spark = df.sparkSession
    database = name.rpartition(".")[0] or spark.catalog.currentDatabase()
    home = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    path = f"{home}/{name.rpartition('.')[2]}/load={uuid4().hex}"
    df.write.option("compression", "snappy").parquet(path)
    return _switch(spark, name, _columns(df.schema), path)


def declared_columns(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    """A table's columns and their declared types, text lengths included."""
    listed = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE {name}").collect()]
    # Partition columns and details follow after a headline.
    return listed[: next((i for i, (column, _) in enumerate(listed) if not column or column.startswith("# ")), len(listed))]


def _columns(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _switch(spark: SparkSession, name: str, columns: list[tuple[str, str]], path: str) -> DataFrame:
    """Point a table to complete files; the load before the last is emptied.

    With the same columns this is one change of the catalog. With other columns the table is declared anew, in two
    changes of the catalog between which no rows are moved: a run that ends there is mended by its repetition.
    """
    former = None
    if spark.catalog.tableExists(name):
        declared = declared_columns(spark, name)
        settings = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        former, last = settings.get(_FORMER), settings.get(_LAST)
        if declared == columns:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        else:
            spark.sql(f"DROP TABLE {name}")
            _declare(spark, name, columns, path)
    else:
        last = None
        _declare(spark, name, columns, path)
    remembered = f"'{_LAST}' = '{path}'" + (f", '{_FORMER}' = '{last}'" if last else "")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({remembered})")
    spark.catalog.refreshTable(name)
    if former:
        empty(spark, former)
    return spark.table(name)


def _declare(spark: SparkSession, name: str, columns: list[tuple[str, str]], path: str) -> None:
    listed = ", ".join(f"`{column}` {kind}" for column, kind in columns)
    spark.sql(f"CREATE TABLE {name} ({listed}) USING parquet LOCATION '{path}'")


def recreate_views(tables: Mapping[str, DataFrame], prefix: str = "bronze_") -> list[str]:
    """Register each frame as a view without copying any rows."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in tables]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in declared order and type; decimals round half up to their scale.

    A declared text length is not cut to: ``replace_typed`` refuses longer values.
    """

    def kind(field: T.StructField) -> T.DataType:
        return T.StringType() if isinstance(field.dataType, (T.VarcharType, T.CharType)) else field.dataType

    return df.select(*[F.col(f"`{f.name}`").cast(kind(f)).alias(f.name) for f in schema.fields])


def replace_typed(
    df: DataFrame, name: str, schema: T.StructType, folder: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Load ``df`` into a table of declared types; readers see all of the old rows or all of the new.

    The load goes through a table of the same declaration with a folder of its own, so Spark's checks of written values
    hold: a text longer than declared ends it. It is checked there (unique ``keys``, no NULL in required columns). Only
    then does the table point to it, so a failed load leaves the table as it was. A table that exists with other columns is
    declared anew. The rows of the load before the last are deleted.
    """
    spark = df.sparkSession
    path, columns = f"{folder}/load={uuid4().hex}", _columns(schema)
    side = f"{name}__{uuid4().hex[:12]}"
    _declare(spark, side, columns, path)
    try:
        conform(df, schema).write.option("compression", "snappy").insertInto(side)
        loaded = spark.table(side)
        if keys:
            assert_unique(loaded, keys, name)
        required = [f.name for f in schema.fields if not f.nullable]
        if required:
            assert_no_nulls(loaded, required, name)
    finally:
        spark.sql(f"DROP TABLE {side}")  # its files stay
    return _switch(spark, name, columns, path)


def with_audit(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Add the load time and, when given, the batch date."""
    added = {"LoadTimestamp": F.current_timestamp()}
    if as_of is not None:
        added["BatchDate"] = F.lit(as_of).cast("date")
    return df.withColumns(added)
