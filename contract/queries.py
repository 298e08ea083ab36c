"""One function per registered query: ``(spark, sf_dir) -> DataFrame``, whole tables throughout."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contract.tables import NAMES, RULES, given, personas, survey_tables
from surveyqa import fixed_values as fv
from surveyqa import schemas
from surveyqa.functions import (
    collapse_whitespace,
    fill_cast_int,
    split_list,
    strip_accents,
    strip_round_suffix,
    upper_columns,
)
from surveyqa.operators import checks, compare, groups, reports, triage
from surveyqa.operators.assemble import FINISHED, SurveyTables, assemble, household_base
from surveyqa.operators.conditions import compile_condition
from surveyqa.operators.corrections import clean_corrections, correction_conflicts, corrections_sql
from surveyqa.operators.violations import Predicate, evaluate
from surveyqa.plans import cleaning, productivity
from surveyqa.functions.dates import date_label
from surveyqa.plans.full_run import run_section
from surveyqa.plans.validate import IDENTITY, cross_module_check, filter_rule, open_text_check, validate
from surveyqa.session import shared_place, tune
from surveyqa.sinks import write_by
from surveyqa.sources.bucketed import load_bucketed, write_bucketed
from surveyqa.sources.files import count_lines, read_group_files
from surveyqa.sources.snapshots import read_table, write_table
from surveyqa.streaming import stream_mismatch, validate_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

START, END = "1996-01-01", "1999-12-31"


def query(name: str) -> Callable[[Query], Query]:
    """Register a query; dates become text and names lose their dots, for comparison."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = function(tune(spark), sf_dir)
            return df.selectExpr(*[
                (f"date_format(`{f.name}`, 'yyyy-MM-dd')" if isinstance(f.dataType, T.DateType)
                 else f"`{f.name}`") + f" AS `{f.name.replace('.', '_')}`"
                for f in df.schema.fields
            ])

        QUERIES[name] = run
        return function

    return register


def rule_sheet(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, schemas.RULES)


def part_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule sheet as large as the part table."""
    return given(spark, sf_dir, "part").select(
        F.concat(
            F.lit("V"), "p_size", F.lit("X >= "), F.col("p_partkey") % 9, F.lit(" y (V"),
            F.col("p_partkey") % 25, F.lit("X NO ES (VACIO) o CP = "), "p_size", F.lit(")"),
        ).alias(fv.RULE_CONDITION),
        F.col("p_size").alias(fv.RULE_CHAPTER), F.col("p_type").alias(fv.RULE_SECTION),
        F.concat(F.lit("R"), "p_partkey").alias(fv.RULE_CODE), F.col("p_brand").alias(fv.RULE_ANALYST),
    )


def nullable_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS ORDEN", "l_linenumber AS CP", "nullif(CAST(l_quantity AS INT), 10) AS CANTIDAD",
        "l_suppkey % 9 AS PROVEEDOR", "nullif(l_discount, 0.0D) AS DESCUENTO",
        "CASE l_returnflag WHEN 'N' THEN NULL WHEN 'A' THEN '' ELSE l_returnflag END AS MARCA",
    )


def where(df: DataFrame, condition: str) -> DataFrame:
    compiled = compile_condition(condition, {f.name: f.dataType for f in df.schema.fields})
    return df.filter(F.expr(compiled.sql))


# -- sources, projections ----------------------------------------------------------------------


@query("scan_snapshot")
def scan_snapshot(spark, sf_dir):
    return given(spark, sf_dir, "customer")


@query("upper_columns")
def upper_columns_query(spark, sf_dir):
    return upper_columns(given(spark, sf_dir, "part"))


@query("strip_suffixes")
def strip_suffixes(spark, sf_dir):
    named = given(spark, sf_dir, "supplier").toDF("ID_x", "ESTADO_PR", "ZONA_SR", "ID_y")
    return strip_round_suffix(named)


@query("table_profile")
def table_profile(spark, sf_dir):
    return compare.table_profile({name: given(spark, sf_dir, name) for name in NAMES})


@query("filter_project")
def filter_project(spark, sf_dir):
    return filter_rule(
        survey_tables(spark, sf_dir), "PPA03 >= 40 & P10A01 no es vacío", ["DEPTO", "HOGAR", "CP", "PPA03"]
    )


# -- predicates --------------------------------------------------------------------------------


@query("pred_compare")
def pred_compare(spark, sf_dir):
    return where(nullable_lines(spark, sf_dir), "CANTIDAD > 40 y CP <= PROVEEDOR y DESCUENTO = 0.05")


@query("pred_and_or")
def pred_and_or(spark, sf_dir):
    return where(
        nullable_lines(spark, sf_dir), "CANTIDAD = 49 o CP = 7 & (PROVEEDOR = 1 | PROVEEDOR >= 7)"
    )


@query("pred_in")
def pred_in(spark, sf_dir):
    return where(nullable_lines(spark, sf_dir), "CANTIDAD está en (5, 6, 7) y MARCA está en ('R', '')")


@query("pred_not_equal_null")
def pred_not_equal_null(spark, sf_dir):
    return where(nullable_lines(spark, sf_dir), "MARCA <> 'R' y CANTIDAD <> 20")


@query("pred_not_in_null")
def pred_not_in_null(spark, sf_dir):
    return where(nullable_lines(spark, sf_dir), "CANTIDAD no está en (1, 2, 3, 4, 5)")


@query("pred_empty_numeric")
def pred_empty_numeric(spark, sf_dir):
    return where(nullable_lines(spark, sf_dir), "CANTIDAD es vacio y DESCUENTO no es vacio")


@query("pred_empty_text")
def pred_empty_text(spark, sf_dir):
    return where(nullable_lines(spark, sf_dir), "MARCA es (vacio) y CP = 3 o MARCA no es vacío y CP = 5")


@query("pred_arithmetic")
def pred_arithmetic(spark, sf_dir):
    return where(nullable_lines(spark, sf_dir), "CANTIDAD - CP * 2 > 40 y ~(10 / PROVEEDOR < 4)")


@query("pred_exact_integers")
def pred_exact_integers(spark, sf_dir):
    """Whole numbers of 16 to 19 digits, which doubles would run together."""
    lines = given(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS ORDEN", "l_linenumber AS CP", "9007199254740992 + l_linenumber AS GRANDE",
        "9223372036854775800 + l_linenumber AS MAYOR", "if(l_linenumber = 2, -2147483648, l_linenumber) AS ENTERO",
    )
    return where(lines, "GRANDE - 9007199254740992 = 3 o MAYOR = 9223372036854775807 o -ENTERO > 2147483647")


# -- base assembly -----------------------------------------------------------------------------


@query("base_assembly")
def base_assembly(spark, sf_dir):
    return assemble(
        survey_tables(spark, sf_dir), {("personas", "PR"), ("vivienda", "PR")},
        ["PPA03", "P01H09", "P01H10"],
    )


@query("finished_only")
def finished_only(spark, sf_dir):
    return assemble(survey_tables(spark, sf_dir), {("vivienda", "PR")}, ["P01H09"])


@query("date_window")
def date_window(spark, sf_dir):
    return assemble(
        survey_tables(spark, sf_dir), {("vivienda", "PR")}, ["P01H10"], "1997-03-10", "1997-09-20"
    ).select("LEVEL-1-ID", "FECHA", "P01H10")


@query("date_window_open")
def date_window_open(spark, sf_dir):
    """Windows with one end only."""
    tables, columns = survey_tables(spark, sf_dir), ["LEVEL-1-ID", "FECHA"]
    parts = [
        assemble(tables, {("vivienda", "PR")}, [], start, end).select(*columns, F.lit(name).alias("ventana"))
        for name, start, end in (("desde", "1997-03-10", None), ("hasta", None, "1997-03-10"))
    ]
    return parts[0].unionAll(parts[1])


@query("household_default_cp")
def household_default_cp(spark, sf_dir):
    return filter_rule(
        survey_tables(spark, sf_dir), "P01H10 es vacio", ["LEVEL-1-ID", "CP", "SECTOR"]
    )


@query("cross_round")
def cross_round(spark, sf_dir):
    return assemble(
        survey_tables(spark, sf_dir), {("personas", "PR"), ("capxiii", "SR")},
        ["PPA03", "P13A04A"], START, END,
    )


# -- rules and checks --------------------------------------------------------------------------


@query("rule_violations")
def rule_violations(spark, sf_dir):
    return validate(survey_tables(spark, sf_dir), rule_sheet(spark), START, END).violations


@query("many_rules")
def many_rules(spark, sf_dir):
    """A hundred rules in one pass over the person table, counted per rule."""
    lines = nullable_lines(spark, sf_dir)
    predicates = []
    for n in range(100):
        text = f"CANTIDAD > {n % 50} y PROVEEDOR = {n % 9} o DESCUENTO <> 0.0{n % 10} y CP = {n % 7}"
        compiled = compile_condition(text, {f.name: f.dataType for f in lines.schema.fields})
        predicates.append(Predicate.of(n, compiled))
    hits = evaluate(lines, predicates, ["CP"])
    return hits.groupBy("rule_id").agg(F.count("*").alias("n"))


@query("bijection_check")
def bijection_check(spark, sf_dir):
    return cross_module_check(survey_tables(spark, sf_dir), START, END)


@query("collect_distinct")
def collect_distinct(spark, sf_dir):
    lines = given(spark, sf_dir, "lineitem").withColumn("FECHA", F.to_date("l_shipdate"))
    lists = checks.member_lists(lines, ["l_orderkey"], "l_linenumber", ["FECHA"])
    return lists.withColumn("miembros", F.array_join("miembros", ","))


@query("distinct_members")
def distinct_members(spark, sf_dir):
    return checks.distinct_members(
        given(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey", ["l_linestatus"]
    )


DOCUMENT_CHECKS = (
    checks.TextCheck("text", 2, 60, ("NO", "NA"), "D0001", "Texto corto"),
    checks.TextCheck("lang", 3, 1, ("EN", "ES"), "D0002", "Idioma"),
    checks.TextCheck("source", 4, 0, ("WEB", "FORUM", "NEWS"), "D0003", "Fuente"),
)


@query("text_quality")
def text_quality(spark, sf_dir):
    return checks.text_quality(
        given(spark, sf_dir, "documents"), DOCUMENT_CHECKS, ["doc_id"], 10, "C"
    )


@query("recent_visit")
def recent_visit(spark, sf_dir):
    visits = survey_tables(spark, sf_dir).tables[(fv.VISITS_TABLE, "PR")]
    last = checks.last_visit(visits, fv.HOUSEHOLD_KEY, fv.VISIT_DATE)
    recent = checks.recently_visited(
        visits, fv.HOUSEHOLD_KEY, fv.VISIT_DATE, F.lit("2024-02-02").cast("date"), 4
    )
    return last.join(recent, fv.HOUSEHOLD_KEY, "left_semi")


@query("open_text")
def open_text(spark, sf_dir):
    return open_text_check(survey_tables(spark, sf_dir), "2024-02-02")


# -- groups and reports ------------------------------------------------------------------------


def violations(spark, sf_dir):
    return validate(survey_tables(spark, sf_dir), rule_sheet(spark), START, END).violations


def sector_groups(spark, sf_dir):
    return given(spark, sf_dir, "nation").selectExpr(
        "n_regionkey AS GRUPO", "n_nationkey AS SECTOR"
    )


def grouped(spark, sf_dir):
    return groups.assign_groups(violations(spark, sf_dir), sector_groups(spark, sf_dir), ["SECTOR"])


@query("group_sector_map")
def group_sector_map(spark, sf_dir):
    code = "concat('U', lpad(CAST(c_custkey AS STRING), 6, '0'), CAST({} AS STRING), 'XX')"
    units = given(spark, sf_dir, "customer").selectExpr(
        "c_nationkey AS GRUPO", code.format("c_custkey") + " AS UPM",
        "CASE WHEN c_acctbal < 0 THEN " + code.format("c_custkey + 100000") + " END AS `SUSTITUTO UPM`",
    )
    return groups.group_sector_map(units)


@query("group_distribution")
def group_distribution(spark, sf_dir):
    return grouped(spark, sf_dir).select("GRUPO", "SECTOR", "DEPTO", "HOGAR", "CP", fv.CODE)


@query("left_group_join")
def left_group_join(spark, sf_dir):
    lines = given(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "nullif(c_nationkey + 3, 7) AS SECTOR", "c_nationkey AS DEPTO"
    )
    places = given(spark, sf_dir, "nation").selectExpr(
        "nullif(n_nationkey, 7) AS SECTOR", "if(n_nationkey = 7, 4, n_nationkey - 3) AS DEPTO",
        "n_regionkey AS GRUPO"
    )
    return groups.assign_groups(lines, places, ["DEPTO", "SECTOR"], "left")


@query("deliverable_groups")
def deliverable_groups(spark, sf_dir):
    return groups.deliverable_groups(grouped(spark, sf_dir))


@query("violations_rollup")
def violations_rollup(spark, sf_dir):
    return reports.violations_rollup(grouped(spark, sf_dir))


@query("freq_by_code")
def freq_by_code(spark, sf_dir):
    return reports.frequency_by_code(violations(spark, sf_dir))


@query("freq_with_cross_check")
def freq_with_cross_check(spark, sf_dir):
    """Rules and the chapter comparison together; a household counts once for the comparison."""
    tables = survey_tables(spark, sf_dir)
    rows = violations(spark, sf_dir).unionByName(cross_module_check(tables, START, END))
    return reports.frequency_by_code(rows)


@query("freq_by_interviewer")
def freq_by_interviewer(spark, sf_dir):
    return reports.frequency_by_interviewer(violations(spark, sf_dir))


@query("sorted_report")
def sorted_report(spark, sf_dir):
    return reports.report_order(grouped(spark, sf_dir), "GRUPO")


@query("merge_reports")
def merge_reports(spark, sf_dir):
    orders = given(spark, sf_dir, "orders")
    one = orders.filter("o_orderstatus = 'F'").selectExpr(
        "o_custkey % 25 AS GRUPO", "o_orderkey AS HOGAR", "'regla' AS ORIGEN"
    )
    two = orders.filter("o_orderstatus <> 'F'").selectExpr(
        "o_orderkey AS HOGAR", "'texto' AS ORIGEN", "o_custkey % 30 AS GRUPO"
    )
    return reports.merge_reports(one, two)


@query("merge_reports_left")
def merge_reports_left(spark, sf_dir):
    """Groups that only the right report has are left out."""
    orders = given(spark, sf_dir, "orders")
    one = orders.filter("o_orderstatus = 'F'").selectExpr("o_custkey % 25 AS GRUPO", "o_orderkey AS HOGAR", "'regla' AS ORIGEN")
    two = orders.filter("o_orderstatus <> 'F'").selectExpr("o_orderkey AS HOGAR", "'texto' AS ORIGEN", "o_custkey % 30 AS GRUPO")
    return reports.merge_reports(one, two, left_groups_only=True)


@query("line_counts")
def line_counts(spark, sf_dir):
    """Lines per file of text that Spark wrote."""
    root = f"{shared_place(spark)}/lines-{uuid.uuid4().hex}"
    given(spark, sf_dir, "orders").selectExpr("o_orderstatus AS estado", "CAST(o_orderkey AS STRING) AS linea").repartition(
        "estado"
    ).write.partitionBy("estado").text(root)
    counted = count_lines(spark, f"{root}/*/*.txt")
    state = F.regexp_extract("ruta", "estado=([^/]*)/", 1).alias("estado")
    return counted.select(state, "lineas").groupBy("estado").agg(F.sum("lineas").alias("lineas"))


@query("group_files_roundtrip")
def group_files_roundtrip(spark, sf_dir):
    """Grouped violations written by group and read back, the group from the folder's name."""
    root = f"{shared_place(spark)}/groups-{uuid.uuid4().hex}"
    rows = grouped(spark, sf_dir).select("GRUPO", "SECTOR", "DEPTO", "HOGAR", "CP", fv.CODE)
    write_by(rows, root, ["GRUPO"])
    schema = T.StructType([f for f in rows.schema.fields if f.name != "GRUPO"])
    return read_group_files(spark, f"{root}/*/*.csv", schema)


@query("group_files_whole")
def group_files_whole(spark, sf_dir):
    """All columns of grouped violations by way of files, definitions with line breaks and quotes among them."""
    root = f"{shared_place(spark)}/groups-{uuid.uuid4().hex}"
    rows = grouped(spark, sf_dir).withColumn(
        fv.DEFINITION, F.concat(F.col(f"`{fv.DEFINITION}`"), F.lit('\n"línea" '), F.col("CP"), F.lit("\n\n, fin"))
    )
    write_by(rows, root, ["GRUPO"])
    schema = T.StructType([f for f in rows.schema.fields if f.name != "GRUPO"])
    return read_group_files(spark, f"{root}/*/*.csv", schema)


@query("outer_join_four")
def outer_join_four(spark, sf_dir):
    """Four tables, keys missing and NULL in each."""
    orders, lines = given(spark, sf_dir, "orders"), given(spark, sf_dir, "lineitem")
    return compare.outer_join([
        orders.selectExpr("nullif(o_orderkey, 7) AS `LEVEL-1-ID`", "o_custkey AS P16A01"),
        lines.selectExpr("nullif(l_orderkey + 3, 10) AS `LEVEL-1-ID`", "l_linenumber AS P17A06B"),
        given(spark, sf_dir, "customer").selectExpr("nullif(c_custkey * 4, 8) AS `LEVEL-1-ID`", "c_nationkey AS P01A01"),
        given(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("P02A01")).selectExpr("nullif(user_id * 2, 6) AS `LEVEL-1-ID`", "P02A01"),
    ], fv.HOUSEHOLD_KEY)


@query("frame_in_list")
def frame_in_list(spark, sf_dir):
    """Which candidates equal a table, by fingerprints first."""
    lines = given(spark, sf_dir, "lineitem")
    return compare.equal_frames(lines, {
        "misma": lines.orderBy("l_partkey"),
        "otra": lines.withColumn("l_tax", F.when(F.col("l_linenumber") == 7, 0.09).otherwise(F.col("l_tax"))),
        "repetida": lines.unionAll(lines.filter("l_linenumber = 7")),
        "columnas": lines.drop("l_tax"),
    })


@query("outer_join")
def outer_join(spark, sf_dir):
    orders, lines = given(spark, sf_dir, "orders"), given(spark, sf_dir, "lineitem")
    return compare.outer_join([
        orders.selectExpr("o_orderkey AS `LEVEL-1-ID`", "o_custkey AS P16A01"),
        lines.selectExpr("l_orderkey + 3 AS `LEVEL-1-ID`", "l_linenumber AS P17A06B"),
    ], fv.HOUSEHOLD_KEY)


@query("frame_equality")
def frame_equality(spark, sf_dir):
    part = given(spark, sf_dir, "part")
    return compare.equality_report(part, {
        "misma": part.orderBy("p_name"),
        "otra": part.withColumn("p_size", F.when(F.col("p_size") == 5, 6).otherwise(F.col("p_size"))),
        "columnas": part.drop("p_size"),
    })


# -- rule sheets -------------------------------------------------------------------------------


@query("rule_select")
def rule_select(spark, sf_dir):
    chosen = triage.select_rules(part_rules(spark, sf_dir), "Brand#2", section="ECONOMY")
    return chosen.select(F.col(fv.RULE_CODE).alias("codigo"), F.col(fv.RULE_CHAPTER).alias("capitulo"))


@query("rule_variables")
def rule_variables(spark, sf_dir):
    found = triage.rule_variables(part_rules(spark, sf_dir))
    return found.select(
        F.col(fv.RULE_CODE).alias("codigo"), F.array_join("variables", ",").alias("variables"), "primera"
    )


@query("rule_routing")
def rule_routing(spark, sf_dir):
    catalog = given(spark, sf_dir, "nation").selectExpr(
        "'V' || n_nationkey || 'X' AS variable", "'T' || n_regionkey AS table",
        "CASE WHEN n_nationkey < 13 THEN 'PR' ELSE 'SR' END AS round",
    )
    rules = part_rules(spark, sf_dir).withColumnRenamed(fv.RULE_CODE, "codigo")
    return triage.route(rules, catalog, "codigo")


@query("rules_approved")
def rules_approved(spark, sf_dir):
    codes = given(spark, sf_dir, "supplier").select(F.concat(F.lit("R"), "s_suppkey").alias(fv.RULE_CODE))
    approved = triage.approved(part_rules(spark, sf_dir), codes)
    return approved.select(F.col(fv.RULE_CODE).alias("codigo"), F.col(fv.RULE_ANALYST).alias("analista"))


@query("codes_unreviewed")
def codes_unreviewed(spark, sf_dir):
    emitted = given(spark, sf_dir, "lineitem").select(F.concat(F.lit("R"), "l_partkey").alias("codigo"))
    reviewed = given(spark, sf_dir, "supplier").select(F.concat(F.lit("R"), "s_suppkey").alias("codigo"))
    return triage.unreviewed(emitted, reviewed, "codigo")


@query("section_run")
def section_run(spark, sf_dir):
    """One analyst's rules for one section of a chapter."""
    return run_section(survey_tables(spark, sf_dir), rule_sheet(spark), "Luis", 10, "C", START, END).violations


@query("batch_label")
def batch_label(spark, sf_dir):
    return given(spark, sf_dir, "events").groupBy(date_label(F.col("ts")).alias("etiqueta")).agg(F.count("*").alias("n"))


@query("distinct_sections")
def distinct_sections(spark, sf_dir):
    pairs = triage.sections(part_rules(spark, sf_dir))
    return pairs.toDF("capitulo", "seccion")


# -- cleaning ----------------------------------------------------------------------------------

CRITERIA = [
    ("edades", "PPA03 es vacio", "PPA03, P10C21"),
    ("ocupacion", "P10C21 está en (5,6) y P10D07 = 5", " P10D07 ,"),
    ("hogares", "P01H09 = 1 y P01H10 es vacio", "P01H09,P01H11"),
]


@query("cleaning_extract")
def cleaning_extract(spark, sf_dir):
    criteria = spark.createDataFrame(CRITERIA, schemas.CLEANING)
    return cleaning.cleaning_extract(survey_tables(spark, sf_dir), criteria, START, END).extract


@query("cleaning_query")
def cleaning_query(spark, sf_dir):
    return cleaning.cleaning_query(
        survey_tables(spark, sf_dir), "PPA03 es vacio y P10A01 no es vacio", "PPA03, P10C47", START, END
    )


@query("split_list")
def split_list_query(spark, sf_dir):
    text = F.concat(
        F.lit(" "), "p_brand", F.lit(" ,"), "p_type", F.lit(", ,"), "p_name", F.lit(",,")
    )
    return given(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(split_list(text), "|").alias("lista")
    )


CORRECTION = (
    "l_orderkey % 22 + 1 AS depto", "l_orderkey % 17 + 1 AS mupio",
    "l_orderkey div 1000 AS estructura", "l_orderkey % 1000 AS vivienda",
    "l_orderkey % 3 + 1 AS hogar",
    "CASE WHEN l_quantity = 49 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS cp",
    "CASE WHEN l_returnflag = 'A' THEN 'personas.ppa03' WHEN l_returnflag = 'R'"
    " THEN 'personas.p10a01' WHEN l_linestatus = 'F' THEN 'vivienda.p01h10' END AS variable",
    "CASE WHEN l_linenumber = 6 THEN NULL WHEN l_returnflag = 'R' THEN 'O''Neil ' || l_suppkey"
    " ELSE CAST(l_suppkey % 90 AS STRING) END AS `valor nuevo`",
    "l_partkey * 100 + l_suppkey % 100 AS seq",
)


def corrections(spark, sf_dir):
    """A correction for each line; some for a whole household, some unusable."""
    return given(spark, sf_dir, "lineitem").selectExpr(*CORRECTION, "l_orderkey AS household")


def placed_corrections(spark, sf_dir):
    """Corrections with their sector; lines meet their orders as they are, shorter than the corrections made of them."""
    sector = given(spark, sf_dir, "orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey % 28 AS sector")
    return given(spark, sf_dir, "lineitem").join(sector, "l_orderkey").selectExpr(*CORRECTION, "sector")


@query("corrections_clean")
def corrections_clean(spark, sf_dir):
    return clean_corrections(corrections(spark, sf_dir)).select(
        "household", "cp", "tabla", "columna", fv.NEW_VALUE, "seq"
    )


@query("corrections_sql")
def corrections_sql_query(spark, sf_dir):
    cleaned = clean_corrections(placed_corrections(spark, sf_dir)).withColumn(
        "round", F.when(F.col("tabla") == "vivienda", "SR").otherwise("PR")
    )
    return corrections_sql(cleaned, {"PR": "base_pr", "SR": "base_sr"}, ["personas"])


@query("corrections_conflicts")
def corrections_conflicts(spark, sf_dir):
    return correction_conflicts(clean_corrections(placed_corrections(spark, sf_dir)))


@query("corrections_unused")
def corrections_unused(spark, sf_dir):
    """Corrections whose variable, round, household or value is at fault."""
    sheet = placed_corrections(spark, sf_dir).withColumns({
        "variable": F.expr("CASE WHEN seq % 7 = 0 THEN 'personas.p99x01' WHEN seq % 11 = 0 THEN 'sin punto' ELSE variable END"),
        "sector": F.expr("if(seq % 5 = 0, 99, sector)"),
        fv.NEW_VALUE: F.expr("if(seq % 13 = 0, 'x', `valor nuevo`)"),
    })
    found = cleaning.unused_corrections(survey_tables(spark, sf_dir), sheet)
    return found.filter(F.col("motivo").isin(*cleaning.UNUSED_REASONS[:5]))


@query("corrections_apply")
def corrections_apply(spark, sf_dir):
    corrected, _ = cleaning.correct_table(
        survey_tables(spark, sf_dir), ("personas", "PR"), placed_corrections(spark, sf_dir),
        ["PPA03", "P10A01"],
    )
    return corrected.select(fv.HOUSEHOLD_KEY, "CP", "PPA03", "P10A01", "P10C21")


@query("corrections_audit")
def corrections_audit(spark, sf_dir):
    _, audit = cleaning.correct_table(
        survey_tables(spark, sf_dir), ("vivienda", "PR"), placed_corrections(spark, sf_dir), ["P01H10"]
    )
    return audit


def two_rounds(spark, sf_dir):
    """The survey with its person table in both rounds."""
    tables = survey_tables(spark, sf_dir)
    second = given(spark, sf_dir, "lineitem").filter("l_linenumber <> 3").join(
        given(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").selectExpr("o_orderkey AS l_orderkey"), "l_orderkey", "left_semi"
    )
    return SurveyTables(dict(tables.tables) | {("personas", "SR"): personas(second)})


def round_corrections(spark, sf_dir):
    """Corrections that say their round; some say none, or one that does not hold the column."""
    return placed_corrections(spark, sf_dir).withColumn(
        "round", F.expr("CASE seq % 10 WHEN 0 THEN NULL WHEN 1 THEN 'XX' ELSE if(seq % 3 = 0, 'SR', 'PR') END")
    )


@query("corrections_apply_rounds")
def corrections_apply_rounds(spark, sf_dir):
    """Each correction in the person table of its round."""
    tables, sheet = two_rounds(spark, sf_dir), round_corrections(spark, sf_dir)
    parts = [
        cleaning.correct_table(tables, ("personas", r), sheet, ["PPA03", "P10A01"])[0].select(
            F.lit(r).alias("ronda"), fv.HOUSEHOLD_KEY, "CP", "PPA03", "P10A01", "P10C21"
        )
        for r in fv.ROUNDS
    ]
    return parts[0].unionAll(parts[1])


@query("corrections_audit_rounds")
def corrections_audit_rounds(spark, sf_dir):
    """The log of both rounds' person tables."""
    tables, sheet = two_rounds(spark, sf_dir), round_corrections(spark, sf_dir)
    parts = [
        cleaning.correct_table(tables, ("personas", r), sheet, ["PPA03", "P10A01"])[1].withColumn("ronda", F.lit(r)) for r in fv.ROUNDS
    ]
    return parts[0].unionAll(parts[1])


@query("corrections_unused_all")
def corrections_unused_all(spark, sf_dir):
    """Unknown persons, superseded values and ambiguous rounds as well."""
    sheet = round_corrections(spark, sf_dir).withColumn("cp", F.expr("if(seq % 17 = 0, 99, cp)"))
    return cleaning.unused_corrections(two_rounds(spark, sf_dir), sheet)


@query("corrections_snapshot")
def corrections_snapshot(spark, sf_dir):
    """A stored person table of which only the parts with corrections are written again."""
    root = f"{shared_place(spark)}/stored-{uuid.uuid4().hex}"
    tables = survey_tables(spark, sf_dir)
    write_table(tables.tables[("personas", "PR")], root, "personas", "PR", parts=16)
    cleaning.correct_snapshot(tables, root, ("personas", "PR"), placed_corrections(spark, sf_dir), ["PPA03", "P10A01"], f"{root}/work")
    return read_table(spark, root, "personas", "PR").select(fv.HOUSEHOLD_KEY, "CP", "PPA03", "P10A01", "P10C21")


@query("bucketed_violations")
def bucketed_violations(spark, sf_dir):
    """The rules over a snapshot in buckets by household."""
    root = f"{shared_place(spark)}/buckets-{uuid.uuid4().hex}"
    keys = write_bucketed(survey_tables(spark, sf_dir), root, 8)
    halves = load_bucketed(spark, root, keys, 8)
    found = [validate(tables, rule_sheet(spark), START, END).violations for tables in halves]
    return found[0].unionByName(found[1])


@query("rules_from_parts")
def rules_from_parts(spark, sf_dir):
    """A sheet with a rule for every kind of part over the line items, in one scan; lines per rule."""
    sheet = given(spark, sf_dir, "part").selectExpr("p_size AS a", "p_partkey % 9 AS b", "p_partkey % 7 + 1 AS c").distinct().selectExpr(
        "a * 1000 + b * 10 + c AS id", "'CANTIDAD > ' || a || ' y PROVEEDOR = ' || b || ' o ~(MARCA <> \"R\") y CP = ' || c AS texto"
    )
    lines = nullable_lines(spark, sf_dir)
    types = {f.name: f.dataType for f in lines.schema.fields}
    predicates = [Predicate.of(r["id"], compile_condition(r["texto"], types)) for r in sheet.toLocalIterator()]
    return evaluate(lines, predicates, ["CP"]).groupBy("rule_id").agg(F.count("*").alias("n"))


# -- productivity, batches, text ---------------------------------------------------------------


@query("productivity_totals")
def productivity_totals(spark, sf_dir):
    events = given(spark, sf_dir, "events").select(
        F.concat(F.lit("A"), "user_id").alias("analista"), "event_type"
    )
    totals = events.filter("event_type = 'click'").groupBy("analista").agg(F.count("*").alias("conteo"))
    new = events.filter("event_type <> 'click'").groupBy("analista").agg(
        F.count("*").alias("conteo")
    )
    return productivity.add_counts(totals, new)


@query("productivity_ledger")
def productivity_ledger(spark, sf_dir):
    """The same batch of files counted twice adds up once."""
    path = f"{shared_place(spark)}/ledger-{uuid.uuid4().hex}"
    files = given(spark, sf_dir, "events").groupBy(
        F.concat(F.lit("A"), "user_id").alias("analista"), F.concat("event_type", F.lit(".txt")).alias("archivo")
    ).agg(F.count("*").alias("conteo"), F.sum(F.xxhash64("event_id").cast("decimal(38,0)")).cast("string").alias("huella"))
    productivity.add_batch(spark, path, files.filter("archivo < 'd'"))
    productivity.add_batch(spark, path, files)
    return productivity.add_batch(spark, path, files)


@query("analyst_list")
def analyst_list(spark, sf_dir):
    totals = given(spark, sf_dir, "events").select(
        F.concat(F.lit("A"), "user_id").alias("analista"), F.lit(1).alias("conteo")
    )
    return productivity.analysts(totals)


@query("latest_batch")
def latest_batch(spark, sf_dir):
    names = given(spark, sf_dir, "events").select(F.concat(
        F.when(F.col("event_type") == "error", "Otra_").otherwise("Inconsistencias_"),
        F.date_format("ts", "dd-MM-HH-mm"),
    ).alias("lote"))
    return reports.latest_batch(names, "lote").select(
        "lote", F.date_format("fecha", "MM-dd HH:mm").alias("fecha")
    )


@query("strip_accents")
def strip_accents_query(spark, sf_dir):
    return given(spark, sf_dir, "documents").select("doc_id", F.md5(strip_accents(F.col("text"))).alias("sin"))


@query("collapse_ws")
def collapse_ws(spark, sf_dir):
    return given(spark, sf_dir, "documents").select(
        "doc_id", F.md5(collapse_whitespace(F.col("text"))).alias("limpio")
    )


@query("fill_cast_int")
def fill_cast_int_query(spark, sf_dir):
    lines = given(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "nullif(l_quantity, 7.0D) AS cantidad",
        "nullif(l_discount, 0.05D) AS descuento",
    )
    return fill_cast_int(lines)


# -- streaming ---------------------------------------------------------------------------------


@query("stream_rules")
def stream_rules(spark, sf_dir):
    """Rules over the line items as a stream, written to files and read back when it has caught up."""
    root = f"{shared_place(spark)}/stream-{uuid.uuid4().hex}"
    schema = given(spark, sf_dir, "lineitem").schema
    # A stream's path must be a folder or a pattern; this pattern names one path only.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/lineitem.parque[t]")
    answers = stream.selectExpr(
        "CAST(l_shipdate AS DATE) AS FECHA", "l_suppkey % 20 AS ENCUESTADOR",
        "l_orderkey % 22 + 1 AS DEPTO", "l_orderkey % 17 + 1 AS MUPIO", "l_suppkey % 25 AS SECTOR",
        "l_orderkey AS ESTRUCTURA", "l_orderkey % 1000 AS VIVIENDA", "l_orderkey % 3 + 1 AS HOGAR",
        "l_linenumber AS CP", "nullif(CAST(l_quantity AS INT), 50) AS PPA03", "l_suppkey % 9 AS P10C21",
        "CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linenumber = 2 THEN '' ELSE l_returnflag END AS P10A01",
        "l_partkey % 9 AS P10D07", "nullif(l_tax, 0.0D) AS P10C47", "l_linenumber AS P01H09",
        "nullif(l_orderkey % 10, 3) AS P01H10", "nullif(l_orderkey % 7, 2) AS P01H11", "l_extendedprice AS P01A05",
        "l_orderkey % 40 AS P13A04A", "l_orderkey % 3 AS P13A07A", "l_suppkey % 3 AS P13A07E",
    )
    found, _ = validate_stream(answers, rule_sheet(spark))
    started = (
        found.writeStream.format("parquet").option("path", f"{root}/rows")
        .option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    )
    started.awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{root}/rows")


@query("stream_cross_check")
def stream_cross_check(spark, sf_dir):
    """The chapter comparison as a stream that is read to its end; a last row closes all households."""
    root = f"{shared_place(spark)}/cross-{uuid.uuid4().hex}"
    tables = survey_tables(spark, sf_dir)
    base = household_base(tables, ("PR",), START, END)
    begun, carry = "COMIENZO", [c for c in IDENTITY if c not in (fv.PERSON, fv.DATE)]
    schema = given(spark, sf_dir, "lineitem").schema
    lines = spark.readStream.schema(schema).parquet(f"{sf_dir}/lineitem.parque[t]")
    farm_table = lines.selectExpr(
        "l_orderkey AS `LEVEL-1-ID`", "nullif(l_linenumber, 7) AS P14A04",
        "CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE l_returnflag END AS P14A03A",
    )

    def side(answers, condition, member, state):
        met = where(answers, condition).join(base, fv.HOUSEHOLD_KEY).filter(state)
        return met.select(F.col(f"`{fv.HOUSEHOLD_KEY}`"), member, F.col(fv.DATE).cast("timestamp").alias(begun), *carry)

    left = side(personas(lines), fv.CROSS_LEFT_CONDITION, fv.PERSON, "PPA10 = 1")
    right = side(farm_table, fv.CROSS_RIGHT_CONDITION, fv.CROSS_RIGHT_PERSON, FINISHED)
    empty = spark.createDataFrame([()], T.StructType()).select(*[
        (F.to_timestamp(F.lit("9999-01-01")) if f.name == begun else F.lit(0)).cast(f.dataType).alias(f.name) for f in left.schema.fields
    ])
    empty.write.parquet(f"{root}/close/last")
    closing = spark.readStream.schema(left.schema).parquet(f"{root}/close/*")
    found = stream_mismatch(
        left.unionByName(closing), right, fv.HOUSEHOLD_KEY, fv.PERSON, fv.CROSS_RIGHT_PERSON, begun, "30 days", carry
    )
    started = (
        found.writeStream.format("parquet").option("path", f"{root}/rows").option("checkpointLocation", f"{root}/state")
        .trigger(availableNow=True).start()
    )
    started.awaitTermination()
    rows = spark.read.schema(found.schema).parquet(f"{root}/rows")
    return rows.select(
        F.col(begun).cast("date").alias(fv.DATE), *carry, F.col("member").cast("long").alias(fv.PERSON),
        F.lit(fv.CROSS_CODE).alias(fv.CODE),
    )
