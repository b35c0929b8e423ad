"""File sinks: one folder per day, location or region."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..jobs import in_parallel
from .staging import stage, staging_scope
from .versions import current_folder, write_version

REGION_FORMATS = ("parquet", "csv")


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root}/{layer}/{name}"


def partition_path(root: str, folder: str, as_of: str) -> str:
    """Layout contract between ingest and transform: one folder per table and day."""
    return f"{root}/{folder}/dt={as_of}"


def write_partition(df: DataFrame, root: str, folder: str, as_of: str) -> int:
    """Replace one day of a table as a whole; other days stay. Returns its rows, as the files' footers count them.

    Readers see the old day until the new one is complete, and keep it if the write fails.
    """
    written = write_version(df, partition_path(root, folder, as_of))
    return df.sparkSession.read.schema(df.schema).parquet(written).count()


def write_table(df: DataFrame, root: str, layer: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Rebuild a layer table as Parquet, as a whole, and return a scan of its new version."""
    folder = write_version(df, table_path(root, layer, name), tuple(partition_by))
    columns = [f for f in df.schema.fields if f.name not in partition_by]
    schema = T.StructType(columns + [df.schema[c] for c in partition_by])
    return df.sparkSession.read.schema(schema).parquet(folder)


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """The current version of a layer table."""
    return spark.read.parquet(current_folder(spark, table_path(root, layer, name)))


def write_landing_json(records: DataFrame, root: str, as_of: str, stamp: str, datasets: Sequence[str]) -> None:
    """Land records as JSON lines below ``{dataset}/location=/ingestion_date=/ts=``.

    A run is named by its stamp: the same run again replaces what it landed per data set and location, and
    all other runs stay. Every line keeps the whole record, ``location`` included. The records are computed once and
    staged, since each data set is a write of its own. Rebalancing gives each location few files,
    and splits a location that holds much of the data over several tasks.
    """
    spark = records.sparkSession
    lines = records.select(
        "dataset",
        "location",
        F.lit(as_of).alias("ingestion_date"),
        F.lit(stamp).alias("ts"),
        F.to_json(F.struct(*records.columns)).alias("value"),
    )
    with staging_scope(spark):
        staged = stage(lines, "landing")

        def land(dataset: str) -> None:
            mine = staged.where(F.col("dataset") == dataset).drop("dataset").hint("rebalance", "location")
            writer = mine.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("location", "ingestion_date", "ts").text(f"{root}/{dataset}")

        in_parallel(spark, land, datasets)


def write_by_region(df: DataFrame, path: str, file_format: str) -> None:
    """One folder of Parquet or CSV files per region; a large region gets several files."""
    if file_format not in REGION_FORMATS:
        raise ValueError(f"unsupported format {file_format!r}; use one of {REGION_FORMATS}")
    writer = df.hint("rebalance", "region").write.mode("overwrite").partitionBy("region").format(file_format)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.save(path)
