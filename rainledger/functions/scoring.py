"""Threshold ladders: a measure becomes points or a label by the first rule that holds."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Sequence[tuple[Any, Any]]

_COMPARE = {">=": operator.ge, ">": operator.gt, "<=": operator.le, "<": operator.lt}

# Upper bounds of the risk levels.
RISK_LEVELS = [(25, "low"), (50, "medium"), (75, "high")]
HIGHEST_RISK = "extreme"


def ladder(value: Column, comparison: str, rules: Rules, default: Any) -> Column:
    """Result of the first ``(cut, result)`` with ``value <comparison> cut``.

    A NULL value meets no rule and gets ``default``.
    """
    if not rules:
        raise ValueError("a ladder needs at least one rule")
    holds = _COMPARE[comparison]
    chain = reduce(lambda steps, rule: steps.when(holds(value, rule[0]), rule[1]), rules, F)
    return chain.otherwise(default)


def clamp(score: Column, highest: int = 100) -> Column:
    return F.least(F.lit(highest), score)


def flag_points(flag: Column, points: int) -> Column:
    """Points for a true flag; none for false or NULL."""
    return F.when(flag, points).otherwise(0)


def risk_level(score: Column) -> Column:
    return ladder(score, "<", RISK_LEVELS, HIGHEST_RISK)
