"""Frequency reports, merged reports and the order of the final report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyqa import fixed_values as fv
from surveyqa.functions.text import batch_time


def households_once(violations: DataFrame, *keys: str, codes: Sequence[str] = (fv.CROSS_CODE,)) -> DataFrame:
    """Rows to count: of the codes that compare chapters one per household, of others all.

    Such a code's rows are the differing persons of a household, which is one violation. ``keys`` are
    further columns in which the same household counts anew. A frame without codes or places has none of
    those codes.
    """
    if not {fv.CODE, *fv.CARTOGRAPHY} <= set(violations.columns):
        return violations
    own = F.coalesce(F.col(f"`{fv.CODE}`").isin(*codes), F.lit(False))
    once = violations.filter(own).dropDuplicates([*dict.fromkeys([fv.CODE, *fv.CARTOGRAPHY, *keys])])
    return violations.filter(~own).unionByName(once)


def frequency(violations: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key combination; rows with a NULL key are not counted."""
    return (
        violations.dropna(subset=list(keys))
        .groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count("*").alias("FRECUENCIA"))
    )


def frequency_by_code(violations: DataFrame) -> DataFrame:
    return frequency(households_once(violations), [fv.CODE, fv.DEFINITION])


def frequency_by_interviewer(violations: DataFrame) -> DataFrame:
    return frequency(households_once(violations, fv.INTERVIEWER), [fv.INTERVIEWER])


def violations_rollup(grouped: DataFrame, group: str = "GRUPO") -> DataFrame:
    """Rows per group and, flagged ``es_total``, of all groups: one aggregation."""
    return households_once(grouped, group).rollup(F.col(f"`{group}`")).agg(
        F.grouping(F.col(f"`{group}`")).cast("int").alias("es_total"), F.count("*").alias("n")
    )


def merge_reports(
    left: DataFrame, right: DataFrame, group: str = "GRUPO", left_groups_only: bool = False
) -> DataFrame:
    """Both reports' rows, by column name.

    With ``left_groups_only`` a group found only on the right is left out, unless the left report
    is empty.
    """
    if left_groups_only:
        groups = left.select(F.col(f"`{group}`")).distinct()
        nothing_left = left.select(F.lit(1).alias("_one")).limit(1).agg(
            (F.count("*") == 0).alias("_nothing")
        )
        matched = right.join(groups, group, "left_semi")
        if nothing_left.first()["_nothing"]:
            matched = right
        right = matched
    return left.unionByName(right, allowMissingColumns=True)


def report_order(report: DataFrame, group: str | None = None) -> DataFrame:
    """Department, then code; the remaining columns settle ties.

    The ties make the order total, so that a department and code holding much of the report is
    still cut in several ranges.
    """
    first = [c for c in ([group] if group else []) + ["DEPTO", fv.CODE] if c in report.columns]
    rest = [c for c in report.columns if c not in first]
    return report.orderBy(*[F.col(f"`{c}`") for c in first + rest])


def latest_batch(batches: DataFrame, name: str) -> DataFrame:
    """The batch with the newest time in its name; other names are passed over."""
    stamped = batches.select(F.col(f"`{name}`"), batch_time(F.col(f"`{name}`")).alias("fecha"))
    return (
        stamped.filter(F.col("fecha").isNotNull())
        .orderBy(F.col("fecha").desc(), F.col(f"`{name}`")).limit(1)
    )
