"""Session settings this package's plans count on, and where lineage may be cut."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes partitions, splits skewed join partitions and picks broadcast joins from
# measured sizes. A base joins several tables on the household key in one stage; without the force
# setting one join of a stage that cannot be split keeps all others from it.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


#: Whether an execution removes its shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session; all of them can change at run time."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_folder(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for cut lineage, if it names one."""
    return spark.conf.get("spark.checkpoint.dir", None)


def shared_place(spark: SparkSession) -> str:
    """A folder that all hosts see: the one the cluster names, else one below the warehouse.

    A warehouse on a machine's own disk will do for a local session only.
    """
    named = checkpoint_folder(spark)
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"spark.checkpoint.dir names no shared folder, and {warehouse} is on one machine")
    return f"{warehouse}/staged"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an execution go when it ends.

    Else they stay until the driver happens to collect its garbage, those of one table beside those of the next.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: a result used by several jobs is computed once.

    ``path`` must be on storage that outlives executors.
    """
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever storage the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def is_whole(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end: Spark's mark of success is there."""
    return has_files(spark, f"{path}/_SUCCESS")


def file_states(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """Path, length and time of change of files."""
    found = []
    for path in sorted(paths):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
        found.append((path, status.getLen(), status.getModificationTime()))
    return found


def staged_once(df: DataFrame, path: str) -> DataFrame:
    """``staged``, but a table that is already there whole is read: a repeated run goes on after it."""
    if is_whole(df.sparkSession, path):
        return df.sparkSession.read.schema(df.schema).parquet(path)
    return staged(df, path)
