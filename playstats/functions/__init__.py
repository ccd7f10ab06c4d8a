"""Column expressions (all built-in Spark functions, no Python UDFs)."""

from playstats.functions.lists import first_element, split_list, list_length
from playstats.functions.timefn import (
    epoch_to_ts,
    epoch_to_date,
    shift_months,
    shift_days,
    at_or_after,
    year_of,
    month_of,
)
from playstats.functions.jsonfn import credit_genres, json_scalar
from playstats.functions.fmt import fill_unknown, thousands, round_half_even

__all__ = [
    "first_element",
    "split_list",
    "list_length",
    "epoch_to_ts",
    "epoch_to_date",
    "shift_months",
    "shift_days",
    "at_or_after",
    "year_of",
    "month_of",
    "credit_genres",
    "json_scalar",
    "fill_unknown",
    "thousands",
    "round_half_even",
]
