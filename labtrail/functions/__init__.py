"""Column expressions: built-in functions only, so they stay inside code generation."""

from labtrail.functions.dates import elapsed_days, parse_timestamp, period_text, week_window
from labtrail.functions.messages import any_blank, exceeds, join_messages, outside, rpd, triggered
from labtrail.functions.results import decimal_comma, parse_result, quantification_limit
from labtrail.functions.text import (
    base_parameter,
    clean_sample_name,
    custody_label,
    depth_from_name,
    first_int,
    fold_value,
    map_codes,
)
from labtrail.functions.urls import url_folder, url_site

__all__ = [
    "any_blank",
    "base_parameter",
    "clean_sample_name",
    "custody_label",
    "decimal_comma",
    "depth_from_name",
    "elapsed_days",
    "exceeds",
    "first_int",
    "fold_value",
    "join_messages",
    "map_codes",
    "outside",
    "parse_result",
    "parse_timestamp",
    "period_text",
    "quantification_limit",
    "rpd",
    "triggered",
    "url_folder",
    "url_site",
    "week_window",
]
