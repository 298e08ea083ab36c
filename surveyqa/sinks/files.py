"""File outputs. Each is one job; none loops over groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyqa.operators.reports import report_order


#: Texts are written as they are: quotes doubled, blanks and line breaks at their ends kept.
CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_consolidated(df: DataFrame, path: str) -> None:
    """One CSV table with a header, for BI tools and reports."""
    df.write.mode("overwrite").options(**CSV).csv(path)


def write_by(df: DataFrame, path: str, columns: Sequence[str], file_format: str = "csv") -> None:
    """One directory per value of the columns; values without rows get none.

    The rebalance hint brings a value's rows together, and adaptive execution cuts a value that
    holds much of the data over several tasks.
    """
    writer = df.hint("rebalance", *[F.col(f"`{c}`") for c in columns]).write.mode("overwrite")
    if file_format == "csv":
        writer = writer.options(**CSV)
    writer.partitionBy(*columns).format(file_format).save(path)


def write_sorted_report(df: DataFrame, path: str, group: str = "GRUPO") -> None:
    """One directory per group, rows in report order: files in name order, then lines."""
    ordered = report_order(df, group)
    ordered.write.mode("overwrite").options(**CSV).partitionBy(group).csv(path)


def write_statements(statements: DataFrame, path: str, append: bool = True) -> None:
    """One statement per line, in order of ``seq``; new runs add files."""
    lines = statements.orderBy("seq").select(F.col("sentencia").alias("value"))
    lines.write.mode("append" if append else "overwrite").text(path)
