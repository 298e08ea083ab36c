"""Field groups: which sectors a group holds, and which group a violation goes to."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyqa import fixed_values as fv
from surveyqa.operators.reports import households_once


def unit_sector(unit):
    """The sector number inside a unit code."""
    length = F.length(unit) - fv.UNIT_SECTOR_TRIM
    return F.substring(unit, F.lit(fv.UNIT_SECTOR_START), length).try_cast("int")


def group_sector_map(units: DataFrame) -> DataFrame:
    """``GRUPO, SECTOR`` from the unit sheet; a substitute unit replaces the unit it stands for."""
    unit = F.coalesce(F.col("`SUSTITUTO UPM`"), F.col("UPM"))
    return units.filter(F.col("GRUPO").isNotNull()).select("GRUPO", unit_sector(unit).alias("SECTOR"))


def assign_groups(
    violations: DataFrame, group_map: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Violations with their group; a key in two groups goes to both.

    With ``how="left"`` NULL keys match each other and rows without a group stay. No broadcast is
    forced: Spark broadcasts the map when its size allows, else shuffles both sides and splits
    skewed sectors.
    """
    columns = [F.col(f"v.`{c}`") for c in violations.columns]
    extra = [F.col(f"g.`{c}`") for c in group_map.columns if c not in on]
    left, right = violations.alias("v"), group_map.alias("g")

    def equal(c: str):
        a, b = F.col(f"v.`{c}`"), F.col(f"g.`{c}`")
        return a.eqNullSafe(b) if how == "left" else a == b

    condition = reduce(lambda a, b: a & b, [equal(c) for c in on])
    return left.join(right, condition, how).select(*columns, *extra)


def deliverable_groups(grouped: DataFrame, group: str = "GRUPO") -> DataFrame:
    """Groups with more than one violation; the others are not sent."""
    return (
        households_once(grouped, group).filter(F.col(f"`{group}`").isNotNull())
        .groupBy(F.col(f"`{group}`")).agg(F.count("*").alias("n")).filter("n > 1")
    )
