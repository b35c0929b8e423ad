"""Tables of an operational database, read over JDBC in parallel slices."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession


#: Rows a connection holds at a time, on every path.
FETCH_ROWS = "10000"


def _mark(url: str) -> str:
    """The database's quotation mark for names."""
    return "`" if url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) else '"'


def quoted(url: str, schema: str, table: str) -> str:
    mark = _mark(url)
    return f"{mark}{schema}{mark}.{mark}{table}{mark}"


def split_predicates(key: str, bounds: Sequence[Any], mark: str = '"') -> list[str]:
    """One predicate per slice of ``key`` between sorted ``bounds`` (numbers, dates or text); NULL keys join the first.

    Give bounds that cut the rows evenly (``equal_shares``) when key ranges are skewed.
    """
    column = f"{mark}{key}{mark}"
    if not bounds:
        return ["1 = 1"]
    bounds = [b if isinstance(b, (int, float, Decimal)) else "'" + str(b).replace("'", "''") + "'" for b in bounds]
    middle = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(bounds, bounds[1:])]
    return [f"{column} < {bounds[0]} OR {column} IS NULL", *middle, f"{column} >= {bounds[-1]}"]


def jdbc_options(
    url: str,
    schema: str,
    table: str,
    *,
    key: str | None = None,
    lowest: int | None = None,
    highest: int | None = None,
    slices: int = 1,
    extra: Mapping[str, str] | None = None,
) -> dict[str, Any]:
    """Options of a scan; with a numeric or date ``key`` it is read in ``slices`` equal ranges."""
    options = {"url": url, "dbtable": quoted(url, schema, table), "fetchsize": FETCH_ROWS, **(extra or {})}
    if key is not None and slices > 1:
        if lowest is None or highest is None:
            raise ValueError("a sliced scan needs the lowest and the highest key")
        options |= {
            "partitionColumn": key,
            "lowerBound": str(lowest),
            "upperBound": str(highest),
            "numPartitions": str(slices),
        }
    return options


def key_range(spark: SparkSession, url: str, schema: str, table: str, key: str, **extra: str) -> tuple[Any, Any]:
    """Lowest and highest key, computed by the database."""
    column = f"{_mark(url)}{key}{_mark(url)}"
    query = f"SELECT MIN({column}) AS lowest, MAX({column}) AS highest FROM {quoted(url, schema, table)}"
    row = spark.read.format("jdbc").options(url=url, query=query, **extra).load().first()
    return row["lowest"], row["highest"]


def share_query(url: str, schema: str, table: str, key: str, slices: int) -> str:
    """The least key of each of ``slices`` equal shares of a table's rows, by one grouped query.

    The database ranks its own key; only one row a share leaves it. A key that fills several shares comes several
    times: it can't be cut.
    """
    column = f"{_mark(url)}{key}{_mark(url)}"
    ranked = f"SELECT {column} AS k, NTILE({slices}) OVER (ORDER BY {column}) AS share FROM {quoted(url, schema, table)} WHERE {column} IS NOT NULL"
    return f"SELECT share, MIN(k) AS lowest FROM ({ranked}) ranked GROUP BY share"


def cuts(lowest: Sequence[Any]) -> list[Any]:
    """The bounds between shares, from the least key of each share in order."""
    return sorted(set(lowest) - {min(lowest)}) if lowest else []


def equal_shares(spark: SparkSession, url: str, schema: str, table: str, key: str, slices: int, **extra: str) -> list[Any]:
    """Bounds that cut a table into slices of equally many rows, however its keys are spread."""
    query = share_query(url, schema, table, key, slices)
    rows = spark.read.format("jdbc").options(url=url, query=query, **extra).load().collect()  # one row a slice
    return cuts([row["lowest"] for row in rows])


def read_jdbc(
    spark: SparkSession,
    url: str,
    schema: str,
    table: str,
    *,
    key: str | None = None,
    slices: int = 1,
    bounds: Sequence[int] = (),
    even: bool = False,
    **extra: str,
) -> DataFrame:
    """Scan a table; filters and column choices on the result run in the database.

    With a ``key`` the scan runs in ``slices`` equal key ranges. Where the keys are unevenly spread it runs in the ranges
    between ``bounds``; with ``even`` these are asked of the database, so that slices have equally many rows.
    """
    if key is not None and even and slices > 1 and not bounds:
        bounds = equal_shares(spark, url, schema, table, key, slices, **extra)
    if key is not None and bounds:
        predicates = split_predicates(key, bounds, _mark(url))
        return spark.read.jdbc(url, quoted(url, schema, table), predicates=predicates, properties={"fetchsize": FETCH_ROWS, **extra})
    lowest = highest = None
    if key is not None and slices > 1:
        lowest, highest = key_range(spark, url, schema, table, key, **extra)
        if lowest is None:
            key = None
    options = jdbc_options(url, schema, table, key=key, lowest=lowest, highest=highest, slices=slices, extra=extra)
    return spark.read.format("jdbc").options(**options).load()


def jdbc_reader(
    spark: SparkSession,
    url: str,
    slices: int,
    bounds: Mapping[str, Sequence[int]] | None = None,
    skewed: Sequence[str] = (),
    **extra: str,
) -> Callable[[Any], DataFrame]:
    """The reader an ingest calls per table: each scan is sliced by the key in its spec.

    Where a table's keys are unevenly spread, ``bounds`` gives its own cuts, or, for the tables in ``skewed``, the
    database is asked for them.
    """
    own = bounds or {}
    return lambda spec: read_jdbc(
        spark,
        url,
        spec.schema,
        spec.table,
        key=spec.key,
        slices=slices,
        bounds=own.get(spec.table, ()),
        even=spec.table in skewed,
        **extra,
    )


def count_jdbc(spark: SparkSession, url: str, schema: str, table: str, **extra: str) -> DataFrame:
    """Row count of a table, computed by the database."""
    query = f"SELECT COUNT(*) AS row_count FROM {quoted(url, schema, table)}"
    return spark.read.format("jdbc").options(url=url, query=query, **extra).load()
