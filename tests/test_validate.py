"""Base assembly, rules, cross-module and open-text checks on the small survey."""

from functools import reduce

import pytest
from survey_helpers import rows, rule, rule_sheet
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyqa import ConditionError, SurveyTables, assemble, filter_rule, locate, validate
from surveyqa.operators.assemble import bad_dates
from surveyqa.operators.checks import last_visit, member_lists, recently_visited, set_mismatch
from surveyqa.plans.full_run import write_by_section
from surveyqa.plans.validate import cross_module_check, open_text_check, route_rule
from surveyqa.operators.triage import select_rules
from surveyqa.streaming import resent_once, validate_stream

WINDOW = ("2023-09-01", "2023-09-30")


def test_locate(tables):
    assert locate(tables, ["PPA03", "CP"]) == {("personas", "PR")}
    assert locate(tables, ["PPA03", "P01H09"]) == {("personas", "PR"), ("vivienda", "PR")}
    assert locate(tables, ["DEPTO"]) == frozenset()
    with pytest.raises(ConditionError, match="unknown"):
        locate(tables, ["P99"])


def test_locate_needs_precedence(spark, tables):
    twice = SurveyTables({**tables.tables, ("otra", "PR"): tables.tables[("personas", "PR")]})
    with pytest.raises(ConditionError, match="ambiguous"):
        locate(twice, ["PPA03"])
    ordered = SurveyTables(twice.tables, precedence=["otra", "personas"])
    assert locate(ordered, ["PPA03"]) == {("otra", "PR")}


def test_finished_deleted_and_dates(tables):
    base = assemble(tables, {("personas", "PR")}, ["PPA03"], *WINDOW)
    # 2 is outside the window, 3 has no readable date, 5 is deleted; person status decides, not the cover
    assert rows(base, "LEVEL-1-ID", "CP", "PPA03") == [
        (1, 1, 40), (1, 2, None), (1, 3, 12), (4, 1, 30), (6, 1, 33)
    ]
    households = assemble(tables, {("vivienda", "PR")}, ["P01H10"], *WINDOW)
    assert rows(households, "LEVEL-1-ID", "CP", "P01H10") == [(1, 0, None), (4, 0, 4)]
    assert rows(assemble(tables, {("vivienda", "PR")}, []), "LEVEL-1-ID") == [(1,), (2,), (3,), (4,)]
    assert rows(bad_dates(tables, "PR")) == [("31/02/23", 1)]


def test_window_ends_belong_to_it(tables):
    base = assemble(tables, {("vivienda", "PR")}, [], "2023-09-23", "2023-09-25")
    assert [str(r[0]) for r in rows(base, "FECHA")] == ["2023-09-23", "2023-09-25"]


def test_both_rounds(tables):
    needed = {("personas", "PR"), ("capxiii", "SR")}
    base = assemble(tables, needed, ["P13A04A"], *WINDOW)
    assert rows(base, "LEVEL-1-ID", "CP", "P13A04A") == [(4, 1, 7)]
    assert str(base.first()["FECHA"]) == "2023-09-24"


def test_second_round_only(tables):
    base = assemble(tables, {("capxiii", "SR")}, ["P13A04A"])
    assert rows(base, "LEVEL-1-ID", "CP") == [(4, 0)]


def test_person_tables_pair_within_household(spark, tables):
    other = spark.createDataFrame([(1, 1, 9), (1, 2, 8)], "`LEVEL-1-ID` long, CP int, Q1 int")
    both = SurveyTables({**tables.tables, ("otra", "PR"): other})
    needed = {("personas", "PR"), ("otra", "PR")}
    assert assemble(both, needed, ["PPA03", "Q1"], *WINDOW).count() == 6
    matched = assemble(both, needed, ["PPA03", "Q1"], *WINDOW, person_keys=("LEVEL-1-ID", "CP"))
    assert rows(matched, "CP", "Q1") == [(1, 9), (2, 8)]


RULES = [
    rule("PPA03 es vacio", "P1"),
    rule("PPA03 <> 40 y P10C21 = 5", "P2", "Luis", 3, "B"),
    rule("P01H10 es vacio", "H1"),
    rule("P01H09 = 1 y PPA03 > 30", "HP"),
    rule("DEPTO = 1 y HOGAR = 1", "L1"),
    rule("P13A04A = 7 y P01H09 = 0", "RR"),
    rule("P13A04A = 7", "R2"),
    rule("P99 = 1", "X1", "Eva"),
    rule("PPA03 >", "X2", "Eva"),
    rule("P10C02 > 3", "X3", "Eva"),
    rule("P10C02 = 3", "W1"),
]


@pytest.fixture(scope="module")
def outcome(spark, tables):
    return validate(tables, rule_sheet(spark, *RULES), *WINDOW)


def test_violations(outcome):
    assert rows(outcome.violations, "CODIGO ERROR", "VIVIENDA", "CP") == [
        ("H1", 1, 0), ("HP", 1, 1), ("L1", 1, 0), ("L1", 4, 0), ("P1", 1, 2), ("P2", 1, 3),
        ("P2", 6, 1), ("R2", 4, 0), ("RR", 4, 0),
    ]
    row = outcome.violations.filter("`CODIGO ERROR` = 'P2' AND VIVIENDA = 1").first()
    assert (row.CAPITULO, row.SECCION, row.PREGUNTA, row.ENCUESTADOR, row.COMENTARIOS) == (
        3, "B", 1, 3001, None
    )
    assert str(row.FECHA) == "2023-09-23"


def test_rejected_rules_name_their_analyst(outcome):
    assert rows(outcome.rejected, "codigo", "analista") == [("X1", "Eva"), ("X2", "Eva"), ("X3", "Eva")]
    assert rows(outcome.warnings, "codigo") == [("W1",)]


def test_one_run_equals_one_filter_per_rule(tables, outcome):
    kept = {"H1", "HP", "L1", "P1", "P2", "R2", "RR"}
    expected = reduce(DataFrame.unionAll, [
        filter_rule(tables, condition, ["VIVIENDA", "CP", "FECHA"], *WINDOW).select(
            "*", F.lit(code).alias("code")
        )
        for condition, *_, code, _ in RULES if code in kept
    ])
    assert rows(outcome.violations, "VIVIENDA", "CP", "FECHA", "CODIGO ERROR") == rows(expected)


def test_single_table_rules_are_filtered_before_the_shuffle(spark, tables):
    found = validate(tables, rule_sheet(spark, rule("PPA03 es vacio"))).violations
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Printed from the root down: the flags are tested below the joins, on the person table.
    assert plan.rindex("_w0") > plan.index("Join Inner, (LEVEL-1-ID")


def test_rules_on_household_columns_share_a_staged_base(spark, tables, tmp_path):
    many = [rule(f"DEPTO = 1 y PPA03 <> {n}", f"M{n}") for n in range(250)]
    sheet = rule_sheet(spark, *many)
    staged = validate(tables, sheet, *WINDOW, work_dir=str(tmp_path)).violations
    plain = validate(tables, sheet, *WINDOW).violations
    assert (tmp_path / "personas_PR").exists()
    assert rows(staged, "CODIGO ERROR", "CP") == rows(plain, "CODIGO ERROR", "CP")
    assert staged.count() == 5 * 250 - 4


def test_rules_of_one_analyst(spark, tables, tmp_path):
    chosen = select_rules(rule_sheet(spark, *RULES), analyst="Luis", chapter=3, section="B")
    found = validate(tables, chosen, *WINDOW).violations
    assert rows(found.select("CODIGO ERROR").distinct()) == [("P2",)]
    write_by_section(found, str(tmp_path / "out"))
    assert (tmp_path / "out" / "CAPITULO=3" / "SECCION=B").exists()


def test_date_is_a_variable(spark, tables):
    found = validate(tables, rule_sheet(spark, rule("P01H10 > 0 y FECHA >= '2023-09-24'"))).violations
    assert rows(found, "VIVIENDA") == [(2,), (4,)]


def test_control_tables_hold_variables_too(spark, tables):
    sheet = rule_sheet(
        spark, rule("FECHA_INICIO_CAP_1 >= '2023-09-25'", "D"), rule("ESTADO_PR = 1 y PPA03 = 33", "E"),
        rule("ESTADO_PR = 2 y PPA03 = 33", "F"), rule("ESTADO_PR = 1 y HOGAR = 1", "G"),
    )
    found = validate(tables, sheet)
    assert found.rejected.count() == 0
    assert rows(found.violations, "CODIGO ERROR", "VIVIENDA") == [
        ("D", 2), ("D", 4), ("F", 6), ("G", 1), ("G", 2), ("G", 3), ("G", 4)
    ]


def test_text_codes_stay_text(spark, tables):
    level = tables.tables[("level-1", "PR")].withColumn("SECTOR", F.concat(F.lit("S"), "SECTOR"))
    coded = SurveyTables({**tables.tables, ("level-1", "PR"): level})
    found = validate(coded, rule_sheet(spark, rule("PPA03 es vacio"), rule("P01H10 es vacio"))).violations
    assert rows(found, "SECTOR") == [("S101",), ("S101",)]


# -- set mismatch ------------------------------------------------------------------------------


def test_cross_module(tables):
    found = cross_module_check(tables, *WINDOW)
    # Household 1 has person 1 against 1 and 2; household 4 has person 1 on both sides.
    assert rows(found, "VIVIENDA", "CP") == [(1, 2)]
    assert {r["CODIGO ERROR"] for r in found.collect()} == {"ACECO14"}


def test_set_mismatch_against_brute_force(spark):
    left = [(h, m, 100 + h) for h in range(12) for m in range(h % 5) if (h * m) % 3 != 1] * 2
    right = [(h, float(m)) for h in range(3, 14) for m in range(6) if (h + m) % 4]
    left.append((3, None, 103))
    found = set_mismatch(
        spark.createDataFrame(left, "h long, m int, c int"),
        spark.createDataFrame(right, "h long, m double"), "h", "m", "m", ["c"],
    )
    expected = []
    for h in {r[0] for r in left}:
        a = {m for k, m, _ in left if k == h and m is not None}
        b = {int(m) for k, m in right if k == h}
        if a and b:
            expected += [(h, 100 + h, m, m in a) for m in a ^ b]
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_hot_household_is_spread(spark):
    """A household with a third of all rows: right, and its pairs lie in many partitions."""
    hot = spark.range(6000).selectExpr("0L AS h", "CAST(id AS INT) AS m", "1 AS c")
    rest = spark.range(12000).selectExpr("1 + id % 3000 AS h", "CAST(id AS INT) AS m", "1 AS c")
    left = hot.unionAll(rest)
    right = left.filter("m % 2 = 0").select("h", "m")
    found = set_mismatch(left, right, "h", "m", "m", ["c"])
    assert found.filter("h = 0").count() == 3000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = found.select("h", F.spark_partition_id().alias("p")).filter("h = 0").distinct()
        assert tasks.count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_member_lists(spark):
    frame = spark.createDataFrame([(1, 2), (1, 1), (1, 2), (1, 1500), (2, 3)], "h int, m int")
    assert rows(member_lists(frame, ["h"], "m")) == [(1, 0, [1, 2]), (1, 1, [1500]), (2, 0, [3])]


# -- open text ---------------------------------------------------------------------------------


def test_open_text(tables):
    found = open_text_check(tables, "2023-10-04")
    # 3 bytes in "ñu", "na" is a stop word and short, "Nada" a stop word; 5 is deleted, 6 has P10C01 = 0
    assert rows(found, "VIVIENDA", "CP", "CODIGO ERROR", "VALOR") == [
        (1, 1, "10C00251", "Nada"), (1, 3, "10C00251", None), (2, 1, "10C00251", "na"),
        (4, 2, "10C00251", "no"),
    ]
    assert open_text_check(tables, "2023-12-31").count() == 0


def test_visits_by_date_and_by_text(spark, tables):
    visits = tables.tables[("registro_de_visitas_pr", "PR")]
    last = {r[0]: str(r[1]) for r in rows(last_visit(visits, "LEVEL-1-ID", "R1_FECHA_INICIAL"))}
    assert last[1] == "2023-10-02"
    text = {r[0]: str(r[1]) for r in rows(
        last_visit(visits, "LEVEL-1-ID", "R1_FECHA_INICIAL", text_max=True))}
    assert text[1] == "2023-09-20"
    day = F.lit("2023-10-04").cast("date")
    recent = recently_visited(visits, "LEVEL-1-ID", "R1_FECHA_INICIAL", day, 4).distinct()
    assert rows(recent) == [(1,), (2,), (4,)]
    by_text = recently_visited(visits, "LEVEL-1-ID", "R1_FECHA_INICIAL", day, 4, text_max=True)
    assert rows(by_text) == [(2,), (4,)]


# -- streaming ---------------------------------------------------------------------------------


def test_stream_equals_batch(spark, tables, tmp_path):
    base = assemble(tables, {("personas", "PR")}, ["PPA03", "P10C21"])
    base.write.parquet(str(tmp_path / "in"))
    sheet = rule_sheet(spark, *RULES[:2], rule("P99 = 1", "X1"))
    batch, failed = validate_stream(spark.read.parquet(str(tmp_path / "in")), sheet)
    stream = spark.readStream.schema(base.schema).parquet(str(tmp_path / "in"))
    found, _ = validate_stream(stream, sheet)
    query = (
        found.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(batch) and batch.count() > 0
    assert [code for code, _ in failed] == ["X1"]


def test_resent_questionnaires_count_once(spark, tmp_path):
    sent = spark.createDataFrame(
        [(1, 1, "2023-09-01 10:00:00"), (1, 1, "2023-09-01 10:05:00"), (1, 2, "2023-09-01 10:00:00")],
        "h int, CP int, t string",
    ).withColumn("t", F.to_timestamp("t"))
    sent.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(sent.schema).parquet(str(tmp_path / "in"))
    query = (
        resent_once(stream, ["h", "CP"], "t", "1 hour").writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "h", "CP") == [(1, 1), (1, 2)]


def test_routing_reports_types(tables):
    routed = route_rule(tables, 0, None, "P10C02 no es vacio y CP > 1")
    assert routed.needed == {("personas", "PR")}
    assert "IS NOT NULL" in routed.predicate.sql
