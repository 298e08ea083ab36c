"""Column functions and column shaping, all built from Spark's own functions."""

from surveyqa.functions.columns import (
    drop_index,
    fill_cast_int,
    nan_to_null,
    split_list,
    strip_round_suffix,
    upper_columns,
    with_default,
)
from surveyqa.functions.dates import days_since, parse_survey_date
from surveyqa.functions.text import (
    batch_time,
    collapse_whitespace,
    condition_variables,
    group_number,
    leading_variable,
    strip_accents,
    too_short_or_stopword,
)

__all__ = [
    "batch_time",
    "collapse_whitespace",
    "condition_variables",
    "days_since",
    "drop_index",
    "fill_cast_int",
    "group_number",
    "leading_variable",
    "nan_to_null",
    "parse_survey_date",
    "split_list",
    "strip_accents",
    "strip_round_suffix",
    "too_short_or_stopword",
    "upper_columns",
    "with_default",
]
