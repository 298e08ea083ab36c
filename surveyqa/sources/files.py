"""Control sheets, violation files and statement files. Spreadsheets are exported to CSV upstream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyqa.functions.text import group_number
from surveyqa.sources.records import read_delimited


def read_sheet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A rule, cleaning, group or correction sheet with a header line and known columns."""
    return (
        spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", True).option("enforceSchema", False).csv(path)
    )


def header_columns(spark: SparkSession, path: str, sep: str) -> T.StructType:
    """The columns that the first line of the files names, as text."""
    names = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').csv(path).columns
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_violation_file(spark: SparkSession, path: str) -> DataFrame:
    """A violation export: ``;`` between fields, quotes doubled inside quoted text, which may hold line breaks."""
    return read_delimited(spark, path, header_columns(spark, path, ";"), ";")


def read_group_files(
    spark: SparkSession, pattern: str, schema: T.StructType, sep: str = ","
) -> DataFrame:
    """All report files a pattern names, with the group number cut from the name of file or folder.

    Quoted text may hold line breaks; a large file is read by several tasks all the same.
    """
    rows = read_delimited(spark, pattern, schema, sep, F.col("file"))
    return rows.withColumn("GRUPO", group_number(F.upper(F.col("_file")))).drop("_file")


def count_lines(spark: SparkSession, pattern: str) -> DataFrame:
    """Lines per text file, each file by its path; Spark's readers leave out empty files."""
    files = spark.read.format("binaryFile").load(pattern).select(
        F.col("_metadata.file_path").alias("ruta"), F.col("_metadata.file_name").alias("archivo")
    )
    lines = spark.read.text(pattern).groupBy(F.col("_metadata.file_path").alias("ruta")).agg(F.count("*").alias("lineas"))
    return files.join(lines, "ruta", "left").select("ruta", "archivo", F.coalesce("lineas", F.lit(0)).alias("lineas"))
