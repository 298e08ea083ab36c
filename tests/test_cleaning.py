"""Cleaning extracts, corrections and productivity."""

import pytest
from survey_helpers import rows

from surveyqa import ConditionError, cleaning_extract, cleaning_query, correct_table, correction_script
from surveyqa import schemas
from surveyqa.operators.corrections import clean_corrections, correction_conflicts
from surveyqa.plans.cleaning import variable_list
from surveyqa.plans.productivity import add_counts, analysts, lines_by_analyst
from surveyqa.sinks import write_by, write_statements
from surveyqa.sources import count_lines

WINDOW = ("2023-09-01", "2023-09-30")


def test_variable_list():
    assert variable_list(" P1 ,p2,, P3 , ") == ["P1", "P2", "P3"] and variable_list(None) == []


def test_one_criterion(tables):
    found = cleaning_query(tables, "PPA03 es vacio", "PPA03, P01H10", *WINDOW)
    assert found.columns == [
        "depto", "mupio", "sector", "estructura", "vivienda", "hogar", "cp", "personas.ppa03",
        "vivienda.p01h10", "variable", "valor nuevo",
    ]
    assert rows(found, "vivienda", "cp", "personas.ppa03", "vivienda.p01h10", "variable") == [
        (1, 2, None, None, None)
    ]


def test_first_round_rules_honour_the_dates(tables):
    """Unlike the older behaviour of ignoring them, household 2 (December) stays out."""
    assert rows(cleaning_query(tables, "P01H09 = 0", "P01H09", *WINDOW), "vivienda") == [(4,)]
    assert rows(cleaning_query(tables, "P01H09 = 0", "P01H09"), "vivienda") == [(2,), (4,)]


def test_all_criteria(spark, tables, tmp_path):
    criteria = spark.createDataFrame([
        ("edad", "PPA03 es vacio", "PPA03, P10C21"), ("codigo", "P10C21 = 2", "P10C21"),
        ("nada", "P10C21 = 77", "P10C21"), ("hogar", "P01H10 es vacio", "P01H09"),
        ("malo", "PPA03 =", "PPA03"), ("ajeno", "PPA03 = 30", "P99"),
    ], schemas.CLEANING)
    extract, rejected = cleaning_extract(tables, criteria, *WINDOW)
    columns = ("nombre", "vivienda", "cp", "personas.ppa03", "personas.p10c21", "vivienda.p01h09")
    assert rows(extract, *columns) == [
        ("codigo", 4, 1, None, 2, None), ("edad", 1, 2, None, 1, None), ("hogar", 1, 0, None, None, 1)
    ]
    assert rows(rejected, "codigo") == [("ajeno",), ("malo",)]
    write_by(extract, str(tmp_path / "out"), ["nombre"])
    names = sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert names == ["nombre=codigo", "nombre=edad", "nombre=hogar"]


def corrections(spark, *entries):
    place = (1, 2, 101, 1, 1, 1)
    return spark.createDataFrame([(*place, *e) for e in entries], schemas.CORRECTIONS)


def test_statements(spark, tables, tmp_path):
    sheet = corrections(
        spark, (2, "personas.ppa03", "41", 1), (0, "vivienda.p01h10", "3", 2),
        (2, "personas.p10c02", "O'Higgins \\ x", 3), (None, "personas.ppa03", "5", 4),
        (2, None, "1", 5), (2, "personas.ppa03", None, 6), (2, "ppa03", "1", 7),
        (9, "capxiii.p13a04a", "8", 8),
    )
    script = correction_script(
        sheet, tables.catalog(spark), {"PR": "uno", "SR": "dos"}, ["personas"]
    )
    lines = [r[1] for r in sorted(script.collect())]
    place = (
        "`level-1`.`depto` = 1 and `level-1`.`mupio` = 2 and `level-1`.`sector` = 101 and "
        "`level-1`.`estructura` = 1 and `level-1`.`vivienda` = 1 and `level-1`.`hogar` = 1"
    )
    join = "JOIN `level-1` ON {0}.`level-1-id` = `level-1`.`level-1-id` SET {0}.{1} = {2} WHERE "
    assert lines[0] == "UPDATE uno.personas AS personas " + join.format(
        "personas", "ppa03", "41") + place + " and `personas`.`cp` = 2; "
    assert lines[1] == "UPDATE uno.vivienda AS vivienda " + join.format(
        "vivienda", "p01h10", "3") + place + "; "
    assert "SET personas.p10c02 = 'O''Higgins \\\\ x' WHERE" in lines[2]
    assert lines[3].endswith(place + "; ")
    assert lines[4].startswith("UPDATE dos.capxiii AS capxiii ") and lines[4].endswith(place + "; ")
    assert len(lines) == 5
    write_statements(script, str(tmp_path / "sql"))
    write_statements(script, str(tmp_path / "sql"))
    assert spark.read.text(str(tmp_path / "sql")).count() == 10


def test_apply_latest_wins(spark, tables):
    sheet = corrections(
        spark, (2, "personas.ppa03", "41", 1), (2, "personas.ppa03", "42", 3),
        (None, "personas.ppa03", "7", 2), (1, "personas.p10c21", "mal", 4),
        (0, "personas.p10c21", "9", 5), (3, "personas.ppa03", "x", 9),
    )
    new, audit = correct_table(tables, ("personas", "PR"), sheet, ["PPA03", "P10C21"])
    assert new.columns == tables.tables[("personas", "PR")].columns and new.count() == 9
    changed = new.filter("`LEVEL-1-ID` = 1")
    # person 3's last correction is no number: the value stays, and the log says so
    assert rows(changed, "CP", "PPA03", "P10C21") == [(1, 7, 9), (2, 42, 9), (3, 12, 9)]
    log = rows(audit, "CP", "variable", "valor_anterior", "valor_nuevo", "aplicado")
    assert log == [
        (1, "P10C21", "5", "9", True), (1, "PPA03", "40", "7", True), (2, "P10C21", "1", "9", True),
        (2, "PPA03", None, "42", True), (3, "P10C21", "5", "9", True), (3, "PPA03", "12", "x", False),
    ]
    conflicts = correction_conflicts(clean_corrections(sheet))
    assert rows(conflicts, "cp", "columna", "n") == [(2, "PPA03", 2)]


def test_apply_to_household_table(spark, tables):
    sheet = corrections(spark, (None, "vivienda.p01h10", "3", 1))
    new, audit = correct_table(tables, ("vivienda", "PR"), sheet, ["P01H10"])
    assert rows(new.filter("`LEVEL-1-ID` < 3"), "LEVEL-1-ID", "P01H10") == [(1, 3), (2, 2)]
    assert rows(audit) == [("vivienda", 1, "P01H10", None, "3", 1, True)]
    with pytest.raises(ConditionError):
        correct_table(tables, ("vivienda", "PR"), sheet, ["P77"])


def test_productivity(spark, tmp_path):
    (tmp_path / "ana.txt").write_text("a\nb\nc")
    (tmp_path / "luis.txt").write_text("a\n")
    (tmp_path / "eva.txt").write_text("")
    new = lines_by_analyst(count_lines(spark, str(tmp_path / "*.txt")))
    before = spark.createDataFrame([("ana", 10), ("rosa", 1)], schemas.PRODUCTIVITY)
    totals = add_counts(before, new)
    assert rows(totals) == [("ana", 13), ("luis", 1), ("rosa", 1)]
    assert rows(analysts(totals)) == [("ana",), ("luis",), ("rosa",)]
