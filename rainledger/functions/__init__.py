"""Column expressions; all of them stay inside generated code."""

from .dates import date_key, full_days_between, month_name, season
from .money import exact_mean, line_amount, margin_percent, rounded_mean
from .scoring import clamp, flag_points, ladder, risk_level
from .text import cell_code, display_name
from .zones import drop_timezones

__all__ = [
    "cell_code",
    "clamp",
    "date_key",
    "display_name",
    "drop_timezones",
    "exact_mean",
    "flag_points",
    "full_days_between",
    "ladder",
    "line_amount",
    "margin_percent",
    "month_name",
    "risk_level",
    "rounded_mean",
    "season",
]
