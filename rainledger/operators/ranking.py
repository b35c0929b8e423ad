"""De-duplication and exact ranks over a whole table.

A window without PARTITION BY sends every row to one task. The global operators here range-
partition the rows instead, number them inside each partition, and need only the row count per
partition (one small row each) to know every rank.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..sinks.staging import stage

# monotonically_increasing_id() keeps the partition number above this many bits.
_ROW_BITS = 33


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first by ``order``, ties settled by the remaining columns.

    Spark limits each map task to its own first row before the shuffle, so a key that holds a
    large share of the rows sends one row per map task.
    """
    rest = [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in keys]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *(rest or [F.lit(0)])))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def _numbered(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows in global order, staged, with ``_row`` = partition number and row number within it.

    Staging fixes the partition bounds: Spark samples them anew each time the plan runs.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ordered.withColumn("_row", F.monotonically_increasing_id()), "ranked")


def _pieces(numbered: DataFrame, groups: Sequence[str] = ()) -> list[Row]:
    """Row count and first ``_row`` per (group, partition), in order; one row per partition."""
    part = F.shiftright("_row", _ROW_BITS).alias("part")
    counts = numbered.groupBy(*groups, part).agg(F.count("*").alias("rows"), F.min("_row").alias("first"))
    return counts.orderBy(*groups, "part").collect()


def surrogate_key(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add ``ROW_NUMBER() OVER (ORDER BY order, remaining columns)`` as bigint ``name``."""
    sequence = [F.col(c).asc_nulls_last() for c in [*order, *(c for c in df.columns if c not in order)]]
    return _counted_off(_numbered(df, sequence), df.columns, name)


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows of a sorted frame in the order it has, from 1, as bigint ``name``; nothing is sorted again."""
    return _counted_off(stage(df.withColumn("_row", F.monotonically_increasing_id()), "sorted"), df.columns, name)


def _counted_off(numbered: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    pieces = _pieces(numbered)
    if len(pieces) <= 1:
        first = pieces[0]["first"] if pieces else 0
        return numbered.withColumn(name, F.col("_row") - first + 1).drop("_row")
    before = accumulate((piece["rows"] for piece in pieces), initial=0)
    shifts = {
        "part": [piece["part"] for piece in pieces],
        "shift": [seen - piece["first"] + 1 for seen, piece in zip(before, pieces)],
    }
    # One row per partition of the sort, hence safe to broadcast.
    offsets = F.broadcast(numbered.sparkSession.createDataFrame(pa.table(shifts)))
    placed = numbered.withColumn("part", F.shiftright("_row", _ROW_BITS)).join(offsets, "part")
    return placed.withColumn(name, F.col("_row") + F.col("shift")).select(*columns, name)


@dataclass(frozen=True)
class Tile:
    """A bucket column ``name`` by ``column``; NULLs go last unless ``nulls_first``."""

    name: str
    column: str
    descending: bool = False
    nulls_first: bool = False

    def sort(self, column: str) -> Column:
        direction = "desc" if self.descending else "asc"
        return getattr(F.col(column), f"{direction}_nulls_{'first' if self.nulls_first else 'last'}")()


def global_ntile(df: DataFrame, buckets: int, tiles: Sequence[Tile], tiebreak: Sequence[str]) -> DataFrame:
    """Exact ``NTILE(buckets)`` columns over the whole table, ordered by tile column and tiebreak.

    One range shuffle of the narrow sort columns serves all tiles. It yields the last row of each
    bucket (``buckets - 1`` rows per tile); a row's bucket is then one plus the number of those
    rows it comes after, so the wide rows are scored in place, without a shuffle or a join.
    ``tiebreak`` should make rows distinct. ``df`` is read twice: stage it when it is costly.
    """
    ends = _bucket_ends(df, buckets, tiles, tiebreak)
    breaks = [Tile(c, c) for c in tiebreak]
    scored = {}
    for place, tile in enumerate(tiles):
        beyond = [
            F.when(_after(df, [tile, *breaks], [row[f"_by{place}"], *(row[c] for c in tiebreak)]), 1).otherwise(0)
            for row in ends[place]
        ]
        scored[tile.name] = reduce(lambda a, b: a + b, beyond, F.lit(1)).cast("bigint")
    return df.withColumns(scored)


def _bucket_ends(df: DataFrame, buckets: int, tiles: Sequence[Tile], tiebreak: Sequence[str]) -> list[list[Row]]:
    types = {f.name: f.dataType for f in df.schema.fields}
    arms = [
        F.struct(
            F.lit(place).alias("_tile"),
            *[
                (F.col(t.column) if other == place else F.lit(None).cast(types[t.column])).alias(f"_by{other}")
                for other, t in enumerate(tiles)
            ],
            *tiebreak,
        )
        for place in range(len(tiles))
    ]
    narrow = df.select(F.inline(F.array(*arms)))
    order = [
        F.col("_tile").asc(),
        *[t.sort(f"_by{place}") for place, t in enumerate(tiles)],
        *[F.col(c).asc_nulls_last() for c in tiebreak],
    ]
    numbered = _numbered(narrow, order)
    pieces = _pieces(numbered, ["_tile"])
    wanted = {row: place for place in range(len(tiles)) for row in _end_rows(pieces, place, buckets)}
    if not wanted:
        return [[] for _ in tiles]
    found = {r["_row"]: r for r in numbered.where(F.col("_row").isin(list(wanted))).collect()}
    return [[found[row] for row in _end_rows(pieces, place, buckets)] for place in range(len(tiles))]


def _end_rows(pieces: list[Row], place: int, buckets: int) -> list[int]:
    """``_row`` of the last row of each bucket but the final one; larger buckets come first."""
    mine = [p for p in pieces if p["_tile"] == place]
    size, larger = divmod(sum(p["rows"] for p in mine), buckets)
    rows = []
    for bucket in range(1, buckets):
        rank = bucket * size + min(bucket, larger)
        for piece in mine:
            if rank <= piece["rows"]:
                rows.append(piece["first"] + rank - 1)
                break
            rank -= piece["rows"]
    return rows


def _after(df: DataFrame, order: Sequence[Tile], bound: Sequence) -> Column:
    """Whether a row sorts strictly after ``bound``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    result = F.lit(False)
    for step, value in reversed(list(zip(order, bound))):
        column, edge = F.col(step.column), F.lit(value).cast(types[step.column])
        if value is None:
            later = column.isNotNull() if step.nulls_first else F.lit(False)
        else:
            later = F.coalesce(column < edge if step.descending else column > edge, F.lit(not step.nulls_first))
        result = later | (column.eqNullSafe(edge) & result)
    return result
