"""Extraction from relational databases over JDBC. Connection options are always the caller's."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from decimal import Decimal

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from surveyqa import fixed_values as fv
from surveyqa.sources.snapshots import write_table


@dataclass(frozen=True)
class Partitioning:
    """Ranges of a numeric or date column that tasks read side by side."""

    column: str
    lower: str
    upper: str
    partitions: int


def jdbc_options(
    connection: Mapping[str, str], table: str | None = None, query: str | None = None,
    partitioning: Partitioning | None = None, fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a whole table or for a query the database runs."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    options = {**connection, "fetchsize": str(fetch_size), "pushDownAggregate": "true"}
    if query is not None:
        if partitioning is not None:
            # Spark takes partition bounds with dbtable only.
            options["dbtable"] = f"({query}) q"
        else:
            options["query"] = query
    else:
        options["dbtable"] = table
    if partitioning is not None:
        options |= {
            "partitionColumn": partitioning.column, "lowerBound": partitioning.lower,
            "upperBound": partitioning.upper, "numPartitions": str(partitioning.partitions),
        }
    return options


def read_jdbc_table(
    spark: SparkSession, connection: Mapping[str, str], table: str,
    partitioning: Partitioning | None = None,
) -> DataFrame:
    options = jdbc_options(connection, table=table, partitioning=partitioning)
    return spark.read.format("jdbc").options(**options).load()


def bounds_query(table: str, column: str) -> str:
    """One row: the least and largest value of a key, from an index where the database has one."""
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}"


def found_partitioning(
    spark: SparkSession, connection: Mapping[str, str], table: str, column: str, partitions: int
) -> Partitioning | None:
    """Ranges of a numeric key over the values it has; None for an empty table or another kind of key."""
    row = read_jdbc_query(spark, connection, bounds_query(table, column)).first()
    if row is None or not isinstance(row["low"], (int, float, Decimal)) or row["low"] == row["high"]:
        return None
    return Partitioning(column, str(row["low"]), str(row["high"]), partitions)


def read_jdbc_query(
    spark: SparkSession, connection: Mapping[str, str], query: str,
    partitioning: Partitioning | None = None,
) -> DataFrame:
    options = jdbc_options(connection, query=query, partitioning=partitioning)
    return spark.read.format("jdbc").options(**options).load()


def list_tables(spark: SparkSession, connection: Mapping[str, str]) -> list[str]:
    """Names of the tables in the connection's database, from its information schema."""
    query = (
        "SELECT table_name AS name FROM information_schema.tables "
        "WHERE table_schema = DATABASE() AND table_type = 'BASE TABLE'"
    )
    return [row["name"] for row in read_jdbc_query(spark, connection, query).toLocalIterator()]


@dataclass(frozen=True)
class Extracted:
    """What became of one table: the path written, or the error."""

    table: str
    path: str | None
    error: str | None


def ranges_of(
    spark: SparkSession, connection: Mapping[str, str], table: str, column: str, partitions: int
) -> Partitioning | None:
    """Ranges of a table's key; None where it has no such column."""
    try:
        return found_partitioning(spark, connection, table, f"`{column}`", partitions)
    except (PySparkException, Py4JError):
        return None


def extract_database(
    spark: SparkSession, connection: Mapping[str, str], root: str, survey_round: str,
    tables: Iterable[str] | None = None, commission: int | None = None,
    partitioning: Mapping[str, Partitioning] | None = None, keys: Mapping[str, str] | None = None,
    partitions: int = 64,
) -> list[Extracted]:
    """Copy one round's database to the snapshot, all tables or those listed.

    Tables are read in ranges of the household key, or of their key in ``keys``, between its least and
    largest value; ``partitioning`` overrides that. One task reads a table without such a key. A table
    that fails is reported and the others are still copied.
    """
    partitioning, keys = partitioning or {}, keys or {}
    names = list_tables(spark, connection) if tables is None else tables
    done = []
    for table in names:
        try:
            ranges = partitioning.get(table)
            if ranges is None:
                ranges = ranges_of(spark, connection, table, keys.get(table, fv.HOUSEHOLD_KEY.lower()), partitions)
            df = read_jdbc_table(spark, connection, table, ranges)
            path = write_table(df, root, table, survey_round, commission)
            done.append(Extracted(table, path, None))
        except (PySparkException, Py4JError) as error:
            done.append(Extracted(table, None, str(error).splitlines()[0]))
    return done
