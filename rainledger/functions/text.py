"""Labels put together from several columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def display_name(first: Column, last: Column, customer_id: Column) -> Column:
    """Person name, or a store label when either part is NULL or both are blank."""
    person = F.trim(F.concat(first, F.lit(" "), last))
    store = F.concat(F.lit("Store Customer #"), customer_id.cast("string"))
    return F.coalesce(F.nullif(person, F.lit("")), store)


def cell_code(*scores: Column) -> Column:
    """Scores joined by dashes; NULL when any score is NULL (``concat_ws`` would skip it)."""
    parts = [scores[0].cast("string")]
    for score in scores[1:]:
        parts += [F.lit("-"), score.cast("string")]
    return F.concat(*parts)
