"""The cleaning loop: rows for analysts to correct, and their corrections put to use."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyqa import fixed_values as fv
from surveyqa import schemas
from surveyqa.operators.assemble import SurveyTables, TableKey, locate
from surveyqa.operators.conditions import ConditionError
from surveyqa.operators.corrections import apply_corrections, apply_located, clean_corrections, corrections_sql, located_corrections
from surveyqa.operators.keys import marked
from surveyqa.plans.validate import RoutedRule, filter_rule, route_all, rule_hits, rule_rows
from surveyqa.session import shared_place, shuffles_removed, staged, staged_once
from surveyqa.sources.snapshots import PART, part_of, table_path

PLACE = (*fv.CARTOGRAPHY, fv.PERSON)


class CleaningResult(NamedTuple):
    extract: DataFrame
    rejected: DataFrame


def variable_list(text: str | None) -> list[str]:
    """The variables of one criterion; the sheet cell is a comma list."""
    return [item.strip().upper() for item in (text or "").split(",") if item.strip()]


def export_name(tables: SurveyTables, variable: str, needed: frozenset[TableKey]) -> str:
    """``table.column`` in lower case, from the needed table that holds the variable."""
    holders = tables.holders(variable)
    table = next((key for key in holders if key in needed), holders[0])[0]
    return f"{table}.{variable}".lower()


def cleaning_query(
    tables: SurveyTables, condition: str, variables: str, start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """One criterion: place, person, the exported variables, and two empty columns to fill in."""
    names = variable_list(variables)
    rows = filter_rule(tables, condition, [*PLACE, *names], start, end)
    needed = locate(tables, [n for n in names if n != fv.PERSON])
    return rows.select(
        *[F.col(c).alias(c.lower()) for c in PLACE],
        *[F.col(f"`{n}`").alias(export_name(tables, n, needed)) for n in names if n not in PLACE],
        F.lit(None).cast("string").alias("variable"),
        F.lit(None).cast("string").alias(fv.NEW_VALUE),
    )


def cleaning_extract(
    tables: SurveyTables, criteria: DataFrame, start: str | None = None, end: str | None = None
) -> CleaningResult:
    """All criteria: rows with ``nombre``, place, person, exported variables and the empty columns.

    A row fills the variables its criterion exports; the other variables are NULL in it. Criteria
    that need the same tables are evaluated in one pass. A criterion without rows has no rows here,
    so writing by ``nombre`` gives it no file.
    """
    spark = criteria.sparkSession
    rows = rule_rows(criteria)

    def exports(row: Row) -> list[str]:
        return [v for v in variable_list(row[fv.CLEANING_VARIABLES]) if v not in PLACE]

    def exported_by(rule: RoutedRule) -> list[str]:
        return exports(rule.row)

    by_tables, failed = route_all(
        tables, rows, lambda row: row[fv.CLEANING_CONDITION], exports
    )
    extract = None
    for hits, accepted, column in rule_hits(tables, by_tables, PLACE, start, end, failed, exported_by):
        exported: dict[tuple[str, str], list[int]] = {}
        for rule in accepted:
            for variable in exported_by(rule):
                name = export_name(tables, variable, rule.needed)
                exported.setdefault((name, column[rule.rule_id, variable]), []).append(rule.rule_id)
        names = spark.createDataFrame(
            [(r.rule_id, r.row[fv.CLEANING_NAME]) for r in accepted], "rule_id int, nombre string"
        )
        filled: dict[str, list[Column]] = {}
        for (name, source), ids in exported.items():
            filled.setdefault(name, []).append(F.when(F.col("rule_id").isin(*ids), F.col(f"`{source}`")))
        part = hits.join(names, "rule_id").select(
            "nombre",
            *[F.col(c).alias(c.lower()) for c in PLACE],
            *[F.coalesce(*values).alias(name) for name, values in filled.items()],
            F.lit(None).cast("string").alias("variable"),
            F.lit(None).cast("string").alias(fv.NEW_VALUE),
        )
        extract = part if extract is None else extract.unionByName(part, allowMissingColumns=True)
    if extract is None:
        columns = ", ".join(f"{c.lower()} long" for c in PLACE)
        extract = spark.createDataFrame(
            [], f"nombre string, {columns}, variable string, `{fv.NEW_VALUE}` string"
        )
    rejected = spark.createDataFrame(
        [(r[fv.CLEANING_NAME], r[fv.CLEANING_CONDITION], None, e) for r, e in failed],
        schemas.REJECTED,
    )
    return CleaningResult(extract, rejected)


UNUSED_REASONS = (
    "sin variable o valor", "variable desconocida", "ronda ambigua", "hogar desconocido", "valor no convertible",
    "persona desconocida", "reemplazada",
)


def with_rounds(cleaned: DataFrame, catalog: DataFrame) -> DataFrame:
    """Each correction with the round and type of the table and column it names.

    The sheet's ``round`` says which round is meant; where it has none, the only round that holds the
    column. A column held in both rounds is ambiguous then, and its corrections have a NULL round, as those
    of unknown columns. The catalog has a row per column and round and goes to every task; else all corrections
    would be dealt by the few columns they name.
    """
    held = catalog.groupBy(F.lower("table").alias("tabla"), F.upper("variable").alias("columna")).agg(
        F.map_from_entries(F.collect_set(F.struct("round", "dtype"))).alias("_held")  # an entry per round
    )
    said = F.col("round") if "round" in cleaned.columns else F.lit(None).cast("string")
    only = F.when(F.size("_held") == 1, F.map_keys("_held")[0])
    return (
        cleaned.withColumn("tabla", F.lower("tabla")).join(F.broadcast(held), ["tabla", "columna"], "left")
        .withColumn("round", F.coalesce(said, only))
        .withColumn("dtype", F.try_element_at("_held", F.col("round")))
        .withColumns({"round": F.when(F.col("dtype").isNotNull(), F.col("round")), "_rounds": F.size("_held")})
        .drop("_held")
    )


def with_latest(placed: DataFrame) -> DataFrame:
    """Corrections with ``_late``: a later value was given for the same cell; ``_cp`` 0 is the whole household's.

    Corrections that were joined by round and place lie together already, and are not dealt once more.
    """
    cell = ["round", *[c.lower() for c in fv.CARTOGRAPHY], "_cp", "tabla", "columna"]
    given = F.struct("seq", F.col(f"`{fv.NEW_VALUE}`"))
    return placed.withColumn("_late", given < F.max(given).over(Window.partitionBy(*cell)))


def unknown_persons(tables: SurveyTables, placed: DataFrame) -> DataFrame:
    """``placed`` (with the household's key) with ``_nobody``: its person is in no row of its person table.

    Whole households are unknown in a person table that has no row of theirs.
    """
    found, names = None, []
    for (name, survey_round), df in tables.tables.items():
        if fv.PERSON in df.columns and fv.HOUSEHOLD_KEY in df.columns and name != fv.HOUSEHOLD_TABLE:
            names.append(name.lower())
            wanted = placed.filter((F.col("tabla") == name.lower()) & (F.col("round") == survey_round)).select(fv.HOUSEHOLD_KEY, "_cp")
            rows = marked(df, wanted, fv.HOUSEHOLD_KEY).filter("_may").select(
                F.lit(name.lower()).alias("tabla"), F.lit(survey_round).alias("round"), F.col(f"`{fv.HOUSEHOLD_KEY}`"),
                F.explode(F.array(F.coalesce(F.col(fv.PERSON).cast("long"), F.lit(0)), F.lit(0))).alias("_cp"),
            ).distinct()
            found = rows if found is None else found.unionAll(rows)
    if found is None:
        return placed.withColumn("_nobody", F.lit(False))
    joined = placed.join(found.withColumn("_somebody", F.lit(True)), ["tabla", "round", fv.HOUSEHOLD_KEY, "_cp"], "left")
    return joined.withColumn("_nobody", F.col("tabla").isin(*names) & F.col("_somebody").isNull())


def unused_corrections(tables: SurveyTables, corrections: DataFrame) -> DataFrame:
    """Corrections that change nothing, with the reason: ``seq``, ``variable``, value, ``motivo``.

    A value is superseded if a later one was given for the same cell, or for a household as a whole. What
    was said of a whole household is listed as superseded by a later value for it, not by persons' own.
    The steps are staged in the shared place, so that the shuffle of one is gone before that of the next.
    """
    spark = corrections.sparkSession
    folder = f"{shared_place(spark)}/unused-{uuid.uuid4().hex}"
    place = [c.lower() for c in fv.CARTOGRAPHY]
    said_round = ["round"] if "round" in corrections.columns else []
    needed = ["seq", "variable", fv.NEW_VALUE, *place, "cp", *said_round]
    corrections = staged(corrections.select(*[F.col(f"`{c}`") for c in needed]), f"{folder}/sheet")
    kept = ["seq", "variable", fv.NEW_VALUE]
    usable = F.col("variable").contains(".") & F.col(f"`{fv.NEW_VALUE}`").isNotNull()
    missing = corrections.filter(~F.coalesce(usable, F.lit(False))).select(
        *[F.col(f"`{c}`") for c in kept], F.lit(UNUSED_REASONS[0]).alias("motivo")
    )
    placed = with_rounds(clean_corrections(corrections), tables.catalog(spark))
    places = None
    for survey_round in sorted({r for name, r in tables.tables if name == fv.HOUSEHOLD_TABLE}):
        own = tables.tables[(fv.HOUSEHOLD_TABLE, survey_round)].select(
            F.lit(survey_round).alias("round"), *[F.col(c).alias(c.lower()) for c in fv.CARTOGRAPHY], F.col(f"`{fv.HOUSEHOLD_KEY}`")
        )
        places = own if places is None else places.unionByName(own)
    # A place held twice is two households; the correction is listed only if it changes neither.
    person_tables = [name.lower() for (name, _), df in tables.tables.items() if fv.PERSON in df.columns and name != fv.HOUSEHOLD_TABLE]
    said = F.when(F.col("tabla").isin(*person_tables), F.coalesce(F.col("cp").cast("long"), F.lit(0))).otherwise(0)
    placed = placed.withColumn("_id", F.monotonically_increasing_id()).withColumn("_cp", said)
    value = F.col(f"`{fv.NEW_VALUE}`")
    types = {f.dataType.simpleString(): f.dataType for df in tables.tables.values() for f in df.schema.fields}
    unfit = F.lit(False)
    for name, data_type in types.items():
        if not isinstance(data_type, (T.StringType, T.ArrayType, T.StructType, T.MapType)):
            unfit = unfit | ((F.col("dtype") == name) & value.try_cast(data_type).isNull())
    met = placed.withColumn("_unfit", unfit).drop("cp", "dtype").join(places, ["round", *place], "left")
    found = staged(with_latest(met).drop(*place, "columna"), f"{folder}/found")
    located = staged(unknown_persons(tables, found), f"{folder}/located")
    reason = (
        F.when(F.col("_rounds").isNull(), 1).when(F.col("round").isNull(), 2).when(F.col(f"`{fv.HOUSEHOLD_KEY}`").isNull(), 3)
        .when(F.col("_unfit"), 4).when(F.col("_nobody"), 5).when(F.col("_late"), 6).otherwise(0)
    )
    reasons = F.array(*[F.lit(r) for r in UNUSED_REASONS])
    rest = located.withColumn("_reason", reason).groupBy("_id", *[F.col(f"`{c}`") for c in kept]).agg(F.min("_reason").alias("_reason"))
    listed = rest.filter("_reason > 0").withColumn("motivo", reasons[F.col("_reason")])
    return missing.unionByName(listed.select(*[F.col(f"`{c}`") for c in kept], "motivo"))


def correction_script(
    corrections: DataFrame, catalog: DataFrame, databases: Mapping[str, str],
    person_tables: Sequence[str],
) -> DataFrame:
    """Statements for a corrections sheet, to be written with ``write_statements``."""
    located = with_rounds(clean_corrections(corrections), catalog)
    return corrections_sql(located, databases, person_tables)


def correct_table(
    tables: SurveyTables, key: TableKey, corrections: DataFrame, columns: Sequence[str],
    logged_at: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One table with its corrections applied, and the log of old and new values."""
    households = tables.tables[(fv.HOUSEHOLD_TABLE, key[1])]
    table = tables.tables[key]
    keys = [c for c in (fv.HOUSEHOLD_KEY, fv.PERSON) if c in table.columns]
    unknown = [c for c in columns if c not in table.columns]
    if unknown:
        raise ConditionError(f"{key[0]} has no column {', '.join(unknown)}")
    return apply_corrections(table, households, of_round(tables, key, corrections), key[0], columns, keys, logged_at)


def of_round(tables: SurveyTables, key: TableKey, corrections: DataFrame) -> DataFrame:
    """The usable corrections meant for a table's round."""
    placed = with_rounds(clean_corrections(corrections), tables.catalog(corrections.sparkSession))
    return placed.filter(F.col("round") == key[1])


def correct_snapshot(
    tables: SurveyTables, root: str, key: TableKey, corrections: DataFrame, columns: Sequence[str], work_dir: str,
    logged_at: Column | None = None, commission: int | None = None,
) -> DataFrame:
    """Correct a stored table that was written in parts, and return the log.

    Only parts that hold a corrected household are read and written again; files of the others stay as they
    are. The new rows and the log are staged under ``work_dir`` first: a run that fails after that goes on
    from there when it is repeated with the same folder, and its log still has the old values.
    """
    spark = corrections.sparkSession
    path = table_path(root, key[0], key[1], commission)
    households = tables.tables[(fv.HOUSEHOLD_TABLE, key[1])]
    stored = spark.read.parquet(path)
    count = int(spark.read.text(f"{path}_parts").first()[0])
    names = [c for c in stored.columns if c != PART]
    own = of_round(tables, key, corrections)
    located = staged(located_corrections(own, households, key[0], columns), f"{work_dir}/located")
    with shuffles_removed(spark):
        parts = [r[0] for r in located.select(part_of(count).alias(PART)).distinct().collect()]  # at most as many as parts
    touched = stored.filter(F.col(PART).isin(parts))
    record_keys = [c for c in (fv.HOUSEHOLD_KEY, fv.PERSON) if c in names]
    corrected, audit = apply_located(touched.select(*[F.col(f"`{c}`") for c in names]), located, key[0], columns, record_keys, logged_at)
    log = staged_once(audit, f"{work_dir}/log")
    rows = staged_once(corrected.withColumn(PART, part_of(count)), f"{work_dir}/rows")
    if parts:
        with shuffles_removed(spark):
            rows.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    return log
