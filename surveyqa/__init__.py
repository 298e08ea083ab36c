"""Survey microdata checks on Spark: rules kept as rows, evaluated over joined survey tables."""

from surveyqa.operators.assemble import SurveyTables, assemble, locate
from surveyqa.operators.conditions import ConditionError, compile_condition
from surveyqa.plans.cleaning import (
    cleaning_extract,
    cleaning_query,
    correct_table,
    correction_script,
)
from surveyqa.plans.full_run import run
from surveyqa.plans.validate import (
    cross_module_check,
    filter_rule,
    open_text_check,
    validate,
)
from surveyqa.session import tune

__all__ = [
    "ConditionError",
    "SurveyTables",
    "assemble",
    "cleaning_extract",
    "cleaning_query",
    "compile_condition",
    "correct_table",
    "correction_script",
    "cross_module_check",
    "filter_rule",
    "locate",
    "open_text_check",
    "run",
    "tune",
    "validate",
]
