"""Comparing and profiling whole tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def frame_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number of occurrences differs, with ``en_a`` and ``en_b``.

    One shuffle for both directions, and repeated rows shrink to one before it.
    """
    columns = [F.col(f"`{c}`") for c in a.columns]
    tagged = a.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionAll(
        b.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    return (
        tagged.groupBy(*columns).agg(F.sum("_a").alias("en_a"), F.sum("_b").alias("en_b"))
        .filter("en_a <> en_b")
    )


def same_schema(a: DataFrame, b: DataFrame) -> bool:
    return [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema]


def equality_report(target: DataFrame, others: Mapping[str, DataFrame]) -> DataFrame:
    """One row per candidate: does it hold the target's rows, each as often, in the same columns."""
    spark = target.sparkSession
    rows = []
    for name, other in others.items():
        if same_schema(target, other):
            row = frame_difference(target, other).agg(F.count("*").alias("diferencias"))
        else:
            row = spark.range(1).select(F.lit(None).cast("long").alias("diferencias"))
        rows.append(row.select(
            F.lit(name).alias("tabla"),
            F.coalesce(F.col("diferencias") == 0, F.lit(False)).alias("igual"), "diferencias",
        ))
    return reduce(DataFrame.unionAll, rows)


#: Seeds of the two hashes of a row.
SEEDS = (0x51ED270B, 0x2545F491)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row, the same for the same rows in any order: their number and two sums of seeded hashes.

    Every repeated row counts. NULL is told apart from every value, and 0.0 is -0.0, as in a comparison.
    """
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            column = F.when(column == 0, F.lit(0.0).cast(f.dataType)).otherwise(column)
        columns += [column, column.isNull()]
    sums = [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")).alias(f"suma_{n}") for n, seed in enumerate(SEEDS)]
    return df.agg(F.count("*").alias("filas"), *sums)


def equal_frames(target: DataFrame, others: Mapping[str, DataFrame]) -> DataFrame:
    """``tabla`` and ``igual`` per candidate; rows are compared only where fingerprints agree.

    The fingerprints are one job without a shuffle of any row; the driver gets a row per frame.
    """
    spark = target.sparkSession
    alike = {name: df for name, df in others.items() if same_schema(target, df)}
    rows = [fingerprint(df).withColumn("tabla", F.lit(name)) for name, df in alike.items()]
    agreeing: list[str] = []
    if rows:
        own = fingerprint(target).withColumn("tabla", F.lit(None).cast("string"))
        found = {r["tabla"]: (r["filas"], r["suma_0"], r["suma_1"]) for r in reduce(DataFrame.unionAll, [own, *rows]).collect()}
        agreeing = [name for name in alike if found[name] == found[None]]
    settled = spark.createDataFrame([(name, False) for name in others if name not in agreeing], "tabla string, igual boolean")
    parts = [
        frame_difference(target, others[name]).agg((F.count("*") == 0).alias("igual")).select(F.lit(name).alias("tabla"), "igual")
        for name in agreeing
    ]
    return reduce(DataFrame.unionAll, [settled, *parts])


def equals_any(target: DataFrame, others: Mapping[str, DataFrame]) -> bool:
    """Whether the list holds the frame."""
    return bool(equal_frames(target, others).agg(F.coalesce(F.bool_or("igual"), F.lit(False)).alias("igual")).first()["igual"])


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    parts = [
        df.agg(F.count("*").alias("filas")).select(
            F.lit(name).alias("tabla"), "filas", F.lit(len(df.columns)).alias("columnas")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def outer_join(tables: list[DataFrame], key: str) -> DataFrame:
    """Full outer join of all tables on one key; columns other than the key must differ.

    One table of keys says which tables have each. Every table gets a row of NULLs for the keys it lacks,
    and the joins are inner ones: Spark splits a hot key of those, but not of a full outer join, and the plan
    grows by one join a table. A NULL key matches nothing, so NULL keys are told apart by their table.
    """
    if len(tables) > 62:
        raise ValueError("at most 62 tables: each has a bit of a word")
    tag, mask = "_table", "_tables"
    names = [key, tag]

    def tagged(n: int) -> DataFrame:
        return tables[n].withColumn(tag, F.when(F.col(f"`{key}`").isNull(), n + 1).otherwise(0))

    keys = reduce(DataFrame.unionAll, [
        tagged(n).select(F.col(f"`{key}`"), tag, F.lit(1 << n).cast("long").alias(mask)) for n in range(len(tables))
    ]).groupBy(F.col(f"`{key}`"), tag).agg(F.bit_or(mask).alias(mask))
    joined = None
    for n in range(len(tables)):
        lacking = keys.filter(F.col(mask).bitwiseAND(F.lit(1 << n)) == 0).select(F.col(f"`{key}`"), tag)
        whole = tagged(n).unionByName(lacking, allowMissingColumns=True)
        if joined is None:
            joined = whole
            continue
        other = whole.withColumnsRenamed({name: f"_other_{name}" for name in names})
        same = F.col(f"`{key}`").eqNullSafe(F.col(f"`_other_{key}`")) & (F.col(tag) == F.col(f"_other_{tag}"))
        joined = joined.join(other, same).drop(*[f"_other_{name}" for name in names])
    return joined.select(F.col(f"`{key}`"), *[F.col(f"`{c}`") for df in tables for c in df.columns if c != key])
