"""Reusable table operators."""

from .joins import broadcast_if_small
from .quality import (
    QualityError,
    assert_no_nulls,
    assert_not_all_null,
    assert_not_empty,
    assert_unique,
    grain_violations,
    layer_counts,
    null_profile,
)
from .ranking import Tile, global_ntile, keep_first, surrogate_key, with_position
from .rolling import rolling_sums
from .spread import spread

__all__ = [
    "QualityError",
    "Tile",
    "assert_no_nulls",
    "assert_not_all_null",
    "assert_not_empty",
    "assert_unique",
    "broadcast_if_small",
    "global_ntile",
    "grain_violations",
    "keep_first",
    "layer_counts",
    "null_profile",
    "rolling_sums",
    "spread",
    "surrogate_key",
    "with_position",
]
