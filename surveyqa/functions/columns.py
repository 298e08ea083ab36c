"""Column shaping that needs no knowledge of the rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.upper() for name in df.columns])


def drop_index(df: DataFrame) -> DataFrame:
    """Without the row-number column that snapshots made elsewhere may carry."""
    return df.drop("INDEX", "index")


def with_default(df: DataFrame, column: str, value: object) -> DataFrame:
    """The column as it is, or a constant where the table has none."""
    return df if column in df.columns else df.withColumn(column, F.lit(value))


def strip_round_suffix(df: DataFrame) -> DataFrame:
    """Drop ``_y`` duplicates and the ``_x``, ``_SR``, ``_PR`` endings of column names.

    A name stays as it is when its short form is taken, so that no two columns share a name.
    """
    kept = [name for name in df.columns if not name.endswith("_y")]
    taken = set(kept)
    renames = {}
    for name in kept:
        for suffix in ("_x", "_SR", "_PR"):
            short = name.removesuffix(suffix)
            if short != name and short not in taken:
                renames[name] = short
                taken.add(short)
                break
    return df.select(*[F.col(f"`{name}`") for name in kept]).withColumnsRenamed(renames)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is a value to Spark (equal to itself, larger than all others); the rules know only NULL."""
    floats = {
        f.name: F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    }
    return df.withColumns(floats) if floats else df


def split_list(text: Column) -> Column:
    """A comma list as an array, items trimmed, empty ones dropped."""
    items = F.transform(F.split(text, ","), lambda item: F.trim(item))
    return F.filter(items, lambda item: item != "")


def fill_cast_int(df: DataFrame, integral: Sequence[str] | None = None, fill: int = -1) -> DataFrame:
    """Fill NULL in floating-point columns with ``fill`` and make whole-number columns ``long``.

    ``integral`` names the columns known to hold whole numbers only. Without it one aggregate over
    the table finds them.
    """
    floats = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    ]
    if not floats:
        return df
    filled = nan_to_null(df).na.fill(fill, floats)
    if integral is None:
        whole = filled.agg(
            *[F.bool_and(F.col(f"`{c}`") == F.rint(F.col(f"`{c}`"))).alias(c) for c in floats]
        ).first()
        integral = [c for c in floats if whole[c]]
    return filled.withColumns({c: F.col(f"`{c}`").try_cast("long") for c in integral})
