"""Snapshots whose tables lie in the same buckets by household, so that bases join without a shuffle.

Every table that has the household key is written in ``buckets`` buckets of it, sorted, one file a bucket;
the household tables carry the mark of their case, so that no join leaves the household key. A join of
buckets can't be split, so households with more rows in a table than a bucket's even share are kept apart:
there are fewer of them than buckets in each table. Their rows are plain tables, whose joins are shuffles
that adaptive execution splits. Each household is in one of the two surveys, so results over both are the
union of the results over each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyqa import fixed_values as fv
from surveyqa.functions.columns import upper_columns
from surveyqa.operators.assemble import CASE_MARK, SurveyTables, TableKey
from surveyqa.session import staged
from surveyqa.sources.snapshots import table_path


class Halves(NamedTuple):
    """A survey by households: those in buckets, and those too large for one."""

    bucketed: SurveyTables
    large: SurveyTables


def with_marks(tables: SurveyTables, key: TableKey) -> DataFrame:
    """A table as it is stored; households with the mark of their case, NULL where they have none."""
    df = tables.tables[key]
    if key[0] != fv.HOUSEHOLD_TABLE or CASE_MARK in df.columns:
        return df
    cases = tables.tables[(fv.CASES_TABLE, key[1])].selectExpr(f"{fv.CASE_TABLE_KEY} AS `{fv.CASE_KEY}`", f"{fv.DELETED} AS {CASE_MARK}")
    return df.join(cases, fv.CASE_KEY, "left").select(*[F.col(f"`{c}`") for c in df.columns], CASE_MARK)


def large_households(tables: SurveyTables, buckets: int) -> DataFrame:
    """Households with more rows of a table than an even share of a bucket, fewer than ``buckets`` a table."""
    found = []
    for df in tables.tables.values():
        if fv.HOUSEHOLD_KEY in df.columns:
            key = F.col(f"`{fv.HOUSEHOLD_KEY}`")
            share = max(1.0, df.agg(F.count(key)).first()[0] / buckets)
            found.append(df.filter(key.isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > share).select(key))
    return reduce(DataFrame.unionAll, found).distinct()


def catalog_name(root: str, key: TableKey, commission: int | None) -> str:
    path = table_path(root, key[0], key[1], commission)
    letters = "".join(c if c.isalnum() else "_" for c in f"{key[0]}_{key[1]}")
    return f"survey_{zlib.crc32(path.encode()):08x}_{letters}".lower()


def quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def bucketed_table(spark: SparkSession, root: str, key: TableKey, buckets: int, commission: int | None) -> DataFrame:
    """A stored table with its buckets; the session's catalog gets a name for it."""
    path, name = f"{table_path(root, key[0], key[1], commission)}/buckets-{buckets}", catalog_name(root, key, commission)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    by = f"`{fv.HOUSEHOLD_KEY}`"
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files of an external table stay
    spark.sql(
        f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{quoted(path)}'"
    )
    return spark.table(name)


def write_bucketed(tables: SurveyTables, root: str, buckets: int, commission: int | None = None) -> list[TableKey]:
    """Store a survey in buckets; the tables written. ``root`` must be on shared storage.

    Tables without the household key are stored as they are. The two halves' rows come from one list of
    large households, which is written first.
    """
    frames = {key: upper_columns(with_marks(tables, key)) for key in tables.tables}
    spark = next(iter(frames.values())).sparkSession
    large = staged(large_households(tables, buckets), f"{root}/large_households").withColumnRenamed(fv.HOUSEHOLD_KEY, "_large")
    for key, df in frames.items():
        path, name = table_path(root, key[0], key[1], commission), catalog_name(root, key, commission)
        if fv.HOUSEHOLD_KEY not in df.columns:
            df.write.mode("overwrite").parquet(f"{path}/plain")
            continue
        # At most ``buckets`` large households a table.
        hot = F.col(f"`{fv.HOUSEHOLD_KEY}`") == F.col("_large")
        df.join(F.broadcast(large), hot, "left_semi").write.mode("overwrite").parquet(f"{path}/large")
        dealt = df.join(F.broadcast(large), hot, "left_anti").repartition(buckets, F.col(f"`{fv.HOUSEHOLD_KEY}`"))
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, fv.HOUSEHOLD_KEY).sortBy(fv.HOUSEHOLD_KEY).option(
            "path", f"{path}/buckets-{buckets}"
        ).saveAsTable(name)
    return list(frames)


def load_bucketed(
    spark: SparkSession, root: str, keys: Iterable[TableKey], buckets: int, commission: int | None = None,
    precedence: Sequence[str] = (),
) -> Halves:
    """Both halves of a stored survey; only schemas are read here."""
    bucketed, large = {}, {}
    for key in keys:
        path = table_path(root, key[0], key[1], commission)
        if key[0] == fv.CASES_TABLE:
            bucketed[key] = large[key] = spark.read.parquet(f"{path}/plain")
            continue
        bucketed[key] = bucketed_table(spark, root, key, buckets, commission)
        large[key] = spark.read.parquet(f"{path}/large")
    return Halves(SurveyTables(bucketed, precedence, co_located=True), SurveyTables(large, precedence))
