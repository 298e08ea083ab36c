"""Working on the rule sheet itself: picking rules, their variables and tables, reviewed codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyqa import fixed_values as fv
from surveyqa.functions.text import condition_variables, leading_variable


def select_rules(
    rules: DataFrame, analyst: str | None = None, chapter: int | None = None,
    section: str | None = None,
) -> DataFrame:
    chosen = rules
    for column, value in (
        (fv.RULE_ANALYST, analyst), (fv.RULE_CHAPTER, chapter), (fv.RULE_SECTION, section)
    ):
        if value is not None:
            chosen = chosen.filter(F.col(f"`{column}`") == value)
    return chosen


def sections(rules: DataFrame) -> DataFrame:
    return rules.select(fv.RULE_CHAPTER, fv.RULE_SECTION).dropna().distinct()


def rule_variables(rules: DataFrame, condition: str = fv.RULE_CONDITION) -> DataFrame:
    """Rules with the names they use and the name they start with."""
    text = F.col(f"`{condition}`")
    return rules.withColumns(
        {"variables": condition_variables(text), "primera": leading_variable(text)}
    )


def route(rules: DataFrame, catalog: DataFrame, rule: str, condition: str = fv.RULE_CONDITION) -> DataFrame:
    """The tables each rule needs: one row per rule, table and round.

    Words that are no variable of the catalog fall out in the join.
    """
    names = rules.select(
        F.col(f"`{rule}`"), F.explode(condition_variables(F.col(f"`{condition}`"))).alias("variable")
    )
    return (
        names.distinct().join(catalog.select("variable", "table", "round"), "variable")
        .select(F.col(f"`{rule}`"), "table", "round").distinct()
    )


def approved(rules: DataFrame, codes: DataFrame, code: str = fv.RULE_CODE) -> DataFrame:
    """Rules whose code is on the approved list."""
    return rules.join(codes.select(F.col(f"`{code}`")), code, "left_semi").select(*[
        F.col(f"`{c}`") for c in rules.columns
    ])


def unreviewed(emitted: DataFrame, reviewed: DataFrame, code: str) -> DataFrame:
    """Emitted codes that are not on the reviewed list, each as often as emitted."""
    return emitted.filter(F.col(f"`{code}`").isNotNull()).join(
        reviewed.select(F.col(f"`{code}`")), code, "left_anti"
    )
