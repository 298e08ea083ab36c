"""Snapshots: one Parquet directory per commission, round and table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyqa import fixed_values as fv
from surveyqa.functions.columns import drop_index, nan_to_null, upper_columns
from surveyqa.operators.assemble import SurveyTables
from surveyqa.session import shuffles_removed


def table_path(root: str, table: str, survey_round: str, commission: int | None = None) -> str:
    base = root if commission is None else f"{root}/commission={commission}"
    return f"{base}/round={survey_round}/{table}"


#: Folder column of a table written in parts.
PART = "_part"


def part_of(parts: int) -> Column:
    """The part a row's household belongs to."""
    return F.pmod(F.xxhash64(F.col(f"`{fv.HOUSEHOLD_KEY}`")), F.lit(parts)).cast("int")


def write_table(
    df: DataFrame, root: str, table: str, survey_round: str, commission: int | None = None, parts: int | None = None
) -> str:
    """Write one table of a snapshot: upper-case names, no row-number column, NULL for NaN.

    With ``parts`` households are dealt to so many folders, which corrections can rewrite one by one; the
    number is kept beside the table.
    """
    path = table_path(root, table, survey_round, commission)
    clean = nan_to_null(drop_index(upper_columns(df)))
    if parts is None:
        clean.write.mode("overwrite").parquet(path)
    else:
        dealt = clean.withColumn(PART, part_of(parts))
        with shuffles_removed(df.sparkSession):
            dealt.hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(path)
        df.sparkSession.createDataFrame([(str(parts),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}_parts")
    return path


def read_table(
    spark: SparkSession, root: str, table: str, survey_round: str, commission: int | None = None
) -> DataFrame:
    return upper_columns(spark.read.parquet(table_path(root, table, survey_round, commission)).drop(PART))


def load_snapshot(
    spark: SparkSession, root: str, tables: Iterable[tuple[str, str]], commission: int | None = None,
    precedence: Sequence[str] = (),
) -> SurveyTables:
    """The listed (table, round) pairs of a snapshot; only schemas are read here."""
    frames = {
        (table, survey_round): read_table(spark, root, table, survey_round, commission)
        for table, survey_round in tables
    }
    return SurveyTables(frames, precedence)


def control_tables(rounds: Sequence[str] = fv.ROUNDS) -> list[tuple[str, str]]:
    """The tables every base of these rounds needs."""
    names = (fv.HOUSEHOLD_TABLE, fv.CASES_TABLE)
    return [
        (table, r) for r in rounds for table in (*names, fv.TIME_TABLE[r], fv.STATE_TABLE[r])
    ]
