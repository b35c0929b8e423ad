"""Readers of landed files."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..jobs import in_parallel
from ..operators.quality import QualityError, assert_not_empty
from ..sinks.partitions import partition_path
from ..sinks.versions import current_folder, current_folders
from .payload import RECORD_SCHEMA

log = logging.getLogger(__name__)


def read_partition(spark: SparkSession, root: str, folder: str, as_of: str) -> DataFrame:
    """The current version of one day of a landed table; lists that day's folder only, and fails when it is missing.

    A day landed by others, as plain files without versions, is read as it is.
    """
    day = current_folder(spark, partition_path(root, folder, as_of))
    return spark.read.option("basePath", f"{root}/{folder}").parquet(day)


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet file below a path, at any depth, with the columns of all files; of versioned places the current version.

    A column that a file lacks is NULL there; one column of unlike types raises.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return reader.option("mergeSchema", True).parquet(path, *current_folders(spark, path))


def assert_readable(spark: SparkSession, root: str, folders: Iterable[str], as_of: str) -> dict[str, int]:
    """Row count per landed table; one error names every table that cannot be read."""

    def count(folder: str) -> int | str:
        try:
            return read_partition(spark, root, folder, as_of).count()
        except AnalysisException as error:
            return f"{folder}: {error.getCondition()}"

    names = list(folders)
    counts = in_parallel(spark, count, names)
    failed = [answer for answer in counts if isinstance(answer, str)]
    if failed:
        raise QualityError(f"unreadable input for {as_of}: {failed}")
    return dict(zip(names, counts))


def read_landing_json(
    spark: SparkSession, root: str, as_of: str, datasets: Sequence[str], required: Sequence[str] = ()
) -> DataFrame:
    """All landed records of one ingestion date with ``ts``, the time stamp of their file.

    A line may hold one record or an array of records. Only folders of that date are listed.
    Raises when the day has no record, or nothing of a ``required`` data set; another one that is missing is
    logged. A line that is not whole JSON (broken, or a piece of an indented array) ends the job.
    """
    parts = []
    for dataset in datasets:
        try:
            lines = (
                spark.read.schema("value string, location string, ingestion_date string")
                .option("basePath", f"{root}/{dataset}")
                .option("recursiveFileLookup", True)
                .text(f"{root}/{dataset}/location=*/ingestion_date={as_of}")
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            if dataset in required:
                raise QualityError(f"no landed files of {dataset} for ingestion_date={as_of}") from error
            log.warning("no landed files of %s for ingestion_date=%s", dataset, as_of)
            continue
        parts.append(lines.select("value", F.col("_metadata.file_path").alias("path")))
    if not parts:
        raise QualityError(f"no landed files for ingestion_date={as_of}")
    whole = F.from_json("value", T.ArrayType(RECORD_SCHEMA), {"mode": "FAILFAST"})
    unread = F.raise_error(F.concat(F.lit("no JSON record in a line of "), F.col("path")))
    records = reduce(DataFrame.unionAll, parts).where(F.trim("value") != "").select(
        F.regexp_extract("path", r"(\d{8}T\d{6})[^/]*(?:/[^/]+)?$", 1).alias("ts"),
        F.inline(F.coalesce(whole, unread.cast(T.ArrayType(RECORD_SCHEMA)))),
    )
    assert_not_empty(records, f"landed records for ingestion_date={as_of}")
    return records
