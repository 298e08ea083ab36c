"""The full validation run, from survey tables to the files that supervisors get."""

from __future__ import annotations

import datetime
import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyqa import fixed_values as fv
from surveyqa import schemas
from surveyqa.operators.assemble import SurveyTables
from surveyqa.operators.compare import fingerprint
from surveyqa.operators.conditions import ConditionError
from surveyqa.operators.groups import assign_groups, deliverable_groups
from surveyqa.operators.reports import (
    frequency_by_code,
    frequency_by_interviewer,
    merge_reports,
    violations_rollup,
)
from surveyqa.operators.triage import select_rules
from surveyqa.plans.validate import ValidationResult, cross_module_check, open_text_check, validate
from surveyqa.session import file_states, is_whole, staged_once, tune
from surveyqa.sinks import write_by, write_consolidated, write_sorted_report


def input_state(df: DataFrame) -> object:
    """What tells one state of an input from another: its files as they are, or its rows where it has none."""
    files = df.inputFiles()
    if files:
        return df.schema.simpleString(), file_states(df.sparkSession, files)
    return df.schema.simpleString(), [str(v) for v in fingerprint(df).first()]


def run_key(tables: SurveyTables, sheets: Sequence[DataFrame], settings: tuple) -> str:
    """A name for the results of a run, from its survey tables, sheets and settings."""
    states = [(key, input_state(df)) for key, df in sorted(tables.tables.items())]
    text = repr((states, [[str(v) for v in fingerprint(s).first()] for s in sheets], list(tables.precedence), settings))
    return hashlib.sha256(text.encode()).hexdigest()[:16]


@dataclass(frozen=True)
class RunResult:
    violations: DataFrame
    open_text: DataFrame
    report: DataFrame
    rejected: DataFrame
    deliverable: DataFrame


def run(
    tables: SurveyTables, rules: DataFrame, sector_groups: DataFrame, place_groups: DataFrame,
    start: str, end: str, out: str, as_of: str | None = None, left_groups_only: bool = False,
) -> RunResult:
    """Rules, cross-module and open-text checks; reports and group files under ``out``.

    ``sector_groups`` (GRUPO, SECTOR) places rule violations, ``place_groups`` (DEPTO, MUPIO, SECTOR,
    GRUPO) the open-text ones. Violations are written once and every report is made from that table,
    so the rules run once and a lost executor costs no more than its own tasks. ``out`` must be on
    shared storage.

    A run that failed goes on when it is repeated with the same ``out``: staged tables are kept under a key
    of everything they are made from, and one that is there whole is read. Other rules, dates or survey
    files have other keys.
    """
    spark = tune(rules.sparkSession)
    day = as_of or str(datetime.date.today())
    key = run_key(tables, [rules, sector_groups, place_groups], (start, end, day, left_groups_only))
    kept = f"{out}/tables/{key}"
    done = is_whole(spark, f"{kept}/violations")  # then no base is needed
    outcome = validate(tables, rules, start, end, work_dir=None if done else f"{kept}/bases")
    found, rejected = outcome.violations, outcome.rejected
    try:
        found = found.unionByName(cross_module_check(tables, start, end))
    except ConditionError as error:
        rejected = rejected.unionByName(spark.createDataFrame(
            [(fv.CROSS_CODE, fv.CROSS_LEFT_CONDITION, None, str(error))], schemas.REJECTED
        ))
    violations = staged_once(found, f"{kept}/violations")
    write_consolidated(rejected, f"{out}/rejected_rules")
    write_consolidated(outcome.warnings, f"{out}/rule_warnings")
    write_consolidated(violations, f"{out}/violations_csv")
    write_consolidated(
        frequency_by_code(violations).orderBy(fv.CODE, fv.DEFINITION), f"{out}/by_code"
    )
    write_consolidated(
        frequency_by_interviewer(violations).orderBy(fv.INTERVIEWER), f"{out}/by_interviewer"
    )
    by_rule = assign_groups(violations, sector_groups, ["SECTOR"])
    write_by(by_rule, f"{out}/rules_by_group", ["GRUPO"])

    open_text = staged_once(
        assign_groups(
            open_text_check(tables, day), place_groups, ["DEPTO", "MUPIO", "SECTOR"], "left"
        ),
        f"{kept}/open_text",
    )
    write_consolidated(open_text, f"{out}/open_text_csv")
    write_consolidated(violations_rollup(open_text), f"{out}/open_text_counts")
    by_text = open_text.filter(F.col("GRUPO").isNotNull()).drop("VALOR")
    write_by(by_text, f"{out}/open_text_by_group", ["GRUPO"])

    report = staged_once(
        merge_reports(by_rule, by_text, left_groups_only=left_groups_only), f"{kept}/report"
    )
    write_sorted_report(report, f"{out}/final")
    deliverable = deliverable_groups(report)
    write_consolidated(deliverable, f"{out}/deliverable_groups")
    return RunResult(violations, open_text, report, rejected, deliverable)


def write_by_section(violations: DataFrame, out: str) -> None:
    """Violations with one directory per chapter and section."""
    write_by(violations, out, ["CAPITULO", "SECCION"])


def write_by_rule(violations: DataFrame, out: str) -> None:
    """Violations with one directory per chapter, section and rule."""
    write_by(violations, out, ["CAPITULO", "SECCION", fv.CODE])


def run_section(
    tables: SurveyTables, rules: DataFrame, analyst: str, chapter: int, section: str, start: str | None = None,
    end: str | None = None,
) -> ValidationResult:
    """The rules of one analyst for one section of a chapter."""
    return validate(tables, select_rules(rules, analyst, chapter, section), start, end)
