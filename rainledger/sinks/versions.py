"""Folders that change as a whole: a write makes a new version, and one small pointer, written last, names it.

A place holds ``_v-<token>`` folders, one per version, and ``version_log``, with one small entry per finished write. Readers take
the newest entry, so they see all of one version, also while the next is being written; a write that fails leaves no entry and
changes nothing. Entries are numbered by time; a write whose number is not the newest once it has finished (clocks differ) adds
a newer entry. Of writes side by side one may fail; of two that finish the last counts. Readers that have begun keep reading
their version: the last ``KEPT`` stay, older ones are emptied.

Version folders begin with an underscore, which scans of whole trees skip; ``current_folders`` lists those that count.
"""

from __future__ import annotations

import time
from typing import NamedTuple
from urllib.parse import unquote
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "version_log"
KEPT = 2


class Version(NamedTuple):
    """An entry of the log; the newest has the greatest number, or the greatest token among equals."""

    number: int
    token: str

    def folder(self, place: str) -> str:
        return f"{place}/_v-{self.token}"


def _entry(text: str) -> Version:
    number, token = text.split(" ")
    return Version(int(number), token)


def _add_entry(spark: SparkSession, place: str, version: Version) -> None:
    entry = spark.createDataFrame([(f"{version.number} {version.token}",)], "value string")
    entry.coalesce(1).write.mode("append").text(f"{place}/{LOG}")


def finished_versions(spark: SparkSession, place: str) -> list[Version]:
    """All finished writes of a place, the oldest first; none where nothing was written in versions."""
    try:
        entries = spark.read.text(f"{place}/{LOG}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(_entry(row["value"]) for row in entries)


def current_folder(spark: SparkSession, place: str) -> str:
    """The folder of the current version; the place itself where files lie in it without versions."""
    done = finished_versions(spark, place)
    return done[-1].folder(place) if done else place


def current_folders(spark: SparkSession, root: str) -> list[str]:
    """The current folder of every versioned place at any depth below ``root``."""
    path = F.col("_metadata.file_path")
    logs = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.txt")
        .text(root)
        .where(path.rlike(f"/{LOG}/[^/]*$"))
        .select(F.substring_index(path, f"/{LOG}/", 1).alias("place"), "value")
        .collect()
    )
    newest: dict[str, Version] = {}
    for row in logs:
        place = unquote(row["place"])
        newest[place] = max(newest.get(place, Version(0, "")), _entry(row["value"]))
    return [version.folder(place) for place, version in sorted(newest.items())]


def write_version(df: DataFrame, place: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write ``df`` as the next version of a place and switch readers to it; returns its folder.

    ``df`` may read the place itself: it reads the version that was current when it was made.
    """
    spark = df.sparkSession
    new = Version(time.time_ns(), uuid4().hex)
    folder = new.folder(place)
    df.write.option("compression", "snappy").partitionBy(*partition_by).parquet(folder)
    _add_entry(spark, place, new)
    done = finished_versions(spark, place)
    if done[-1] != new:
        _add_entry(spark, place, Version(done[-1].number + 1, new.token))
    tokens = list(dict.fromkeys(version.token for version in reversed(done)))
    if len(tokens) > KEPT:
        empty(spark, Version(0, tokens[KEPT]).folder(place))
    return folder


def empty(spark: SparkSession, folder: str) -> None:
    """Delete the files of a folder that nobody reads any more."""
    spark.range(0).write.mode("overwrite").parquet(folder)
