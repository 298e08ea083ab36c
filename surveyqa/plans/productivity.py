"""Analysts' running totals of statement lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyqa.operators.compare import SEEDS
from surveyqa.session import has_files
from surveyqa.sources.files import count_lines


def add_counts(totals: DataFrame, new: DataFrame) -> DataFrame:
    """Totals plus new counts per analyst; an analyst not seen before is added."""
    return (
        totals.unionByName(new).filter(F.col("analista").isNotNull())
        .groupBy("analista").agg(F.sum("conteo").alias("conteo"))
    )


def lines_by_analyst(line_counts: DataFrame) -> DataFrame:
    """Line counts of files named after the analyst, as new counts."""
    analyst = F.regexp_replace("archivo", r"\.[^.]*$", "")
    return line_counts.select(analyst.alias("analista"), F.col("lineas").alias("conteo"))


def analysts(totals: DataFrame) -> DataFrame:
    return totals.select("analista").distinct()


def file_counts(spark: SparkSession, pattern: str) -> DataFrame:
    """Lines per file with a fingerprint of its content: ``ruta, archivo, lineas, huella``.

    The fingerprint does not depend on how the file is split between tasks; an empty file has one as well.
    """
    name = F.col("_metadata.file_path").alias("ruta")
    hashed = [F.sum(F.xxhash64(F.lit(seed), "value").cast("decimal(38,0)")).cast("string").alias(f"h{n}") for n, seed in enumerate(SEEDS)]
    content = spark.read.text(pattern).select(name, "value").groupBy("ruta").agg(F.count("*").alias("n"), *hashed)
    print_of = F.concat_ws(":", F.col("n").cast("string"), "h0", "h1")
    return count_lines(spark, pattern).join(content, "ruta", "left").select(
        "ruta", "archivo", "lineas", F.when(F.col("n").isNull(), "0").otherwise(print_of).alias("huella")
    )


def new_entries(ledger: DataFrame, counted: DataFrame) -> DataFrame:
    """Entries (``analista, archivo, huella, conteo``) that the ledger does not hold yet, each once.

    A file is known by analyst, name and content, so that a run repeated after a failure adds nothing, and a
    file of the same name with other lines is new.
    """
    keys = ["analista", "archivo", "huella"]
    fresh = counted.filter(F.col("analista").isNotNull()).groupBy(*keys).agg(F.max("conteo").alias("conteo"))
    return fresh.join(ledger.select(*keys), keys, "left_anti")


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """Totals per analyst."""
    return ledger.groupBy("analista").agg(F.sum("conteo").alias("conteo"))


def add_batch(spark: SparkSession, path: str, counted: DataFrame) -> DataFrame:
    """Append a batch's new entries to the ledger kept at ``path`` and return the totals after it."""
    schema = "analista string, archivo string, huella string, conteo long"
    entries = counted.select("analista", "archivo", "huella", F.col("conteo").cast("long"))
    if has_files(spark, path):
        entries = new_entries(spark.read.schema(schema).parquet(path), entries)
    else:
        entries = new_entries(spark.createDataFrame([], schema), entries)
    entries.write.mode("append").parquet(path)
    return ledger_totals(spark.read.schema(schema).parquet(path))
