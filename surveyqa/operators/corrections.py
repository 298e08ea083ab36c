"""Analysts' corrections: cleaned, written as statements, applied to a table, logged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyqa import fixed_values as fv
from surveyqa.operators.keys import FILTER_WORDS, marked

_PLACE = tuple(c.lower() for c in fv.CARTOGRAPHY)
_NUMBER = r"^[+-]?\d+(\.\d+)?$"


def clean_corrections(corrections: DataFrame) -> DataFrame:
    """Corrections with a variable and a new value, the variable split in table and column."""
    pieces = F.split("variable", r"\.", 2)
    return (
        corrections.na.drop(subset=["variable", fv.NEW_VALUE])
        .filter(F.col("variable").contains("."))
        .withColumn("tabla", pieces[0])
        .withColumn("columna", F.upper(pieces[1]))
    )


def correction_conflicts(cleaned: DataFrame) -> DataFrame:
    """Cells that were given more than one value."""
    return (
        cleaned.withColumn("cp", F.coalesce("cp", F.lit(0)))  # both stand for the whole household
        .groupBy(*_PLACE, "cp", "tabla", "columna")
        .agg(F.min(fv.NEW_VALUE).alias("menor"), F.max(fv.NEW_VALUE).alias("mayor"),
             F.count("*").alias("n"))
        .filter("menor <> mayor")
    )


def sql_value(value: Column, text: Column) -> Column:
    """Numbers as they are; texts, and what isn't a number, quoted and escaped."""
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))
    return F.when(value.rlike(_NUMBER) & ~text, value).otherwise(F.concat(F.lit("'"), escaped, F.lit("'")))


def corrections_sql(
    cleaned: DataFrame, databases: Mapping[str, str], person_tables: Sequence[str]
) -> DataFrame:
    """One statement per correction, in the order column ``seq``.

    ``cleaned`` carries the round of each correction in ``round``, and may carry the type of its column
    in ``dtype``: values of a text column are quoted, also if they look like numbers. The person number
    is part of the condition for person tables only, and only when it is given. A correction whose
    round has no database gives no statement.
    """
    cleaned = cleaned.filter(F.col("round").isin(*databases))
    text = F.coalesce(F.col("dtype") == "string", F.lit(False)) if "dtype" in cleaned.columns else F.lit(False)
    database = F.lit(None).cast("string")
    for survey_round, name in databases.items():
        database = F.when(F.col("round") == survey_round, F.lit(name)).otherwise(database)
    place = F.concat_ws(" and ", *[
        F.format_string(f"`level-1`.`{c}` = %s", F.col(c).cast("string")) for c in _PLACE
    ])
    with_person = F.col("tabla").isin(*person_tables) & (F.coalesce("cp", F.lit(0)) != 0)
    where = F.when(with_person, F.concat(
        place, F.format_string(" and `%s`.`cp` = %s", F.col("tabla"), F.col("cp").cast("string"))
    )).otherwise(place)
    table, column = F.col("tabla"), F.lower("columna")
    statement = F.format_string(
        fv.UPDATE_LINE, database, table, table, table, table, column, sql_value(F.col(fv.NEW_VALUE), text),
        where,
    )
    return cleaned.select("seq", statement.alias("sentencia"))


def latest_values(located: DataFrame, keys: Sequence[str], columns: Sequence[str], prefix: str) -> DataFrame:
    """One row per key; per column the last (seq, value) given, NULL when none was."""
    last = F.struct("seq", F.col(fv.NEW_VALUE).alias("value"))
    return located.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*[
        F.max(F.when(F.col("columna") == c, last)).alias(f"{prefix}{c}") for c in columns
    ])


def with_newest(table: DataFrame, located: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """Rows with the values given to them, and per column the last (seq, value) of a row.

    Values of a person meet their row on household and person, those of person 0 all rows of the
    household, so that no cell grows with a household.
    """
    has_person = fv.PERSON in table.columns
    whole = located.filter(F.col(fv.PERSON) == 0) if has_person else located
    joined = table.join(latest_values(whole, [fv.HOUSEHOLD_KEY], columns, "_new_"), fv.HOUSEHOLD_KEY, "left")
    if not has_person:
        return joined, {c: F.col(f"_new_{c}") for c in columns}
    person = F.col(fv.PERSON).cast("long").alias("_person")
    single = latest_values(
        located.filter(F.col(fv.PERSON) != 0).withColumn("_person", person), [fv.HOUSEHOLD_KEY, "_person"], columns, "_own_"
    )
    joined = joined.withColumn("_person", person).join(single, [fv.HOUSEHOLD_KEY, "_person"], "left")
    return joined, {c: F.greatest(F.col(f"_new_{c}"), F.col(f"_own_{c}")) for c in columns}


def located_corrections(cleaned: DataFrame, households: DataFrame, table_name: str, columns: Sequence[str]) -> DataFrame:
    """A table's corrections with the key of their household; person 0 stands for all of its rows."""
    own = cleaned.filter((F.lower("tabla") == table_name.lower()) & F.col("columna").isin(*columns))
    place = households.select(
        F.col(f"`{fv.HOUSEHOLD_KEY}`"), *[F.col(c).alias(c.lower()) for c in fv.CARTOGRAPHY]
    )
    return own.join(place, list(_PLACE)).select(
        F.col(f"`{fv.HOUSEHOLD_KEY}`"), F.coalesce("cp", F.lit(0)).alias(fv.PERSON), "columna",
        F.col(f"`{fv.NEW_VALUE}`"), "seq",
    )


def apply_corrections(
    table: DataFrame, households: DataFrame, cleaned: DataFrame, table_name: str,
    columns: Sequence[str], record_keys: Sequence[str], logged_at: Column | None = None,
    filter_words: int = FILTER_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """The corrected table and the log of what changed, stamped ``logged_at`` if given.

    ``columns`` are the columns that may be corrected, ``households`` maps the cartographic key to
    the household key. A correction without a person number holds for all rows of the household; of
    several values for a cell the one with the highest ``seq`` wins. Only rows of households that may
    have a correction are shuffled; the others pass through, and the log never reads them.
    """
    located = located_corrections(cleaned, households, table_name, columns)
    return apply_located(table, located, table_name, columns, record_keys, logged_at, filter_words)


def apply_located(
    table: DataFrame, located: DataFrame, table_name: str, columns: Sequence[str], record_keys: Sequence[str],
    logged_at: Column | None = None, filter_words: int = FILTER_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """``apply_corrections`` with the table's corrections as ``located_corrections`` gives them."""
    rows = marked(table, located, fv.HOUSEHOLD_KEY, filter_words)
    names = [F.col(f"`{c}`") for c in table.columns]
    joined, newest = with_newest(rows.filter("_may").select(*names), located, columns)
    types = {f.name: f.dataType for f in table.schema.fields}
    new_values = {c: newest[c]["value"].try_cast(types[c]) for c in columns}
    corrected = joined.select(*[
        F.coalesce(new_values[c], F.col(f"`{c}`")).alias(c) if c in new_values else F.col(f"`{c}`")
        for c in table.columns
    ]).unionAll(rows.filter("NOT _may").select(*names))
    entries = F.array_compact(F.array(*[
        F.when(newest[c].isNotNull(), F.struct(
            F.lit(c).alias("variable"),
            F.col(f"`{c}`").cast("string").alias("valor_anterior"),
            newest[c]["value"].alias("valor_nuevo"),
            newest[c]["seq"].alias("seq"),
            new_values[c].isNotNull().alias("aplicado"),
        ))
        for c in columns
    ]))
    audit = joined.select(*[F.col(f"`{k}`") for k in record_keys], F.explode(entries).alias("_entry")).select(
        F.lit(table_name).alias("tabla"), *[F.col(f"`{k}`") for k in record_keys], "_entry.*"
    )
    if logged_at is not None:
        audit = audit.withColumn("fecha_creacion", logged_at)
    return corrected, audit
