"""Sources, sinks and the full run."""

import pytest
from survey_helpers import rows, rule, rule_sheet

from surveyqa import run, schemas, validate
from surveyqa.session import checkpoint_folder, staged, tune
from surveyqa.sinks import write_consolidated, write_sorted_report
from surveyqa.sources import (
    jdbc_options,
    load_snapshot,
    read_group_files,
    read_sheet,
    read_violation_file,
    write_table,
)
from surveyqa.sources import databases
from surveyqa.sources.databases import Partitioning
from surveyqa.sources.snapshots import control_tables

WINDOW = ("2023-09-01", "2023-09-30")


def test_jdbc_options():
    connection = {"url": "jdbc:mysql://db/x", "user": "u", "password": "p"}
    plain = jdbc_options(connection, table="personas")
    assert plain["dbtable"] == "personas" and plain["user"] == "u" and "numPartitions" not in plain
    ranges = Partitioning("level-1-id", "0", "1000000", 64)
    split = jdbc_options(connection, table="personas", partitioning=ranges)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "level-1-id", "0", "1000000", "64"
    )
    assert jdbc_options(connection, query="SELECT 1")["query"] == "SELECT 1"
    assert jdbc_options(connection, query="SELECT 1", partitioning=ranges)["dbtable"] == "(SELECT 1) q"
    with pytest.raises(ValueError):
        jdbc_options(connection)
    with pytest.raises(ValueError):
        jdbc_options(connection, table="a", query="b")


def test_ranges_of_a_key(spark, monkeypatch):
    """No database may run here: the one query that asks for the bounds is answered by Spark."""
    asked = []

    def read(session, connection, query, partitioning=None):
        asked.append(query)
        return session.sql("SELECT 3L AS low, 900L AS high" if "personas" in query else "SELECT NULL AS low, NULL AS high")

    monkeypatch.setattr(databases, "read_jdbc_query", read)
    found = databases.found_partitioning(spark, {}, "personas", "`level-1-id`", 16)
    assert found == Partitioning("`level-1-id`", "3", "900", 16) and asked == ["SELECT MIN(`level-1-id`) AS low, MAX(`level-1-id`) AS high FROM personas"]
    assert databases.found_partitioning(spark, {}, "vacia", "id", 16) is None


def test_extraction_goes_on_after_a_bad_table(spark, tmp_path, monkeypatch):
    """No database may run here, so the reader is replaced; the copying around it is real."""
    def read(session, connection, table, partitioning=None):
        return session.sql("SELECT * FROM no_such_table" if table == "rota" else "SELECT 1 AS ppa03")

    monkeypatch.setattr(databases, "read_jdbc_table", read)
    monkeypatch.setattr(databases, "list_tables", lambda session, connection: ["personas", "rota", "cases"])
    done = databases.extract_database(spark, {"url": "jdbc:x"}, str(tmp_path), "SR", commission=2)
    assert [(d.table, d.error is None) for d in done] == [("personas", True), ("rota", False), ("cases", True)]
    assert spark.read.parquet(str(tmp_path / "commission=2/round=SR/personas")).columns == ["PPA03"]


def test_snapshot(spark, tables, tmp_path):
    root = str(tmp_path)
    for (name, survey_round), df in tables.tables.items():
        write_table(df.toDF(*[c.lower() for c in df.columns]), root, name, survey_round, commission=3)
    assert (tmp_path / "commission=3" / "round=PR" / "personas").exists()
    assert ("level-1", "SR") in control_tables() and ("tiempo_control", "PR") in control_tables(["PR"])
    loaded = load_snapshot(spark, root, tables.tables, commission=3)
    sheet = rule_sheet(spark, rule("PPA03 es vacio", "P1"), rule("P13A04A = 7", "R2"))
    assert rows(validate(loaded, sheet, *WINDOW).violations) == rows(
        validate(tables, sheet, *WINDOW).violations
    )
    assert rows(loaded.catalog(spark).filter("variable IN ('INDEX', 'LEVEL-1-ID')")) == []


def test_nan_is_null_in_a_snapshot(spark, tmp_path):
    frame = spark.createDataFrame([(1.0, 0), (float("nan"), 1)], "x double, index int")
    path = write_table(frame, str(tmp_path), "t", "PR")
    assert rows(spark.read.parquet(path)) == [(1.0,), (None,)]


def test_sheets(spark, tmp_path):
    path = tmp_path / "rules.csv"
    path.write_text(
        "Condición o Criterio,Capítulo,Sección,Pregunta,Definición de la Validación,Código de Error,Analista\n"
        '"A está en (1,2)",1,A,3,"dice ""sí"", y\nsigue",01A,Ana\n', encoding="utf-8",
    )
    found = read_sheet(spark, str(path), schemas.RULES).collect()
    assert len(found) == 1 and found[0][0] == "A está en (1,2)"
    assert found[0][4] == 'dice "sí", y\nsigue' and found[0][3] == 3


def test_violation_file(spark, tmp_path):
    path = tmp_path / "salida.csv"
    path.write_text(
        'ENCUESTADOR;CP;DEFINICIÓN;CÓDIGO\n3006.0;0.0;"Rango (3:7,98) ""de agua"" ; 12";01A\n', encoding="utf-8"
    )
    assert rows(read_violation_file(spark, str(path))) == [
        ("3006.0", "0.0", 'Rango (3:7,98) "de agua" ; 12', "01A")
    ]


def test_group_files(spark, tmp_path):
    for group, code in ((1, "a"), (12, "b")):
        (tmp_path / f"InconsistenciasGRUPO{group}_5-11.csv").write_text(f"DEPTO,CODIGO\n3,{code}\n")
    (tmp_path / "otra.csv").write_text("DEPTO,CODIGO\n9,z\n")
    schema = spark.createDataFrame([], "DEPTO int, CODIGO string").schema
    found = read_group_files(spark, str(tmp_path / "InconsistenciasGRUPO*.csv"), schema)
    assert rows(found) == [(3, "a", 1), (3, "b", 12)]


def test_consolidated_csv_keeps_text(spark, tmp_path):
    frame = spark.createDataFrame([('dice "sí", ok', 1)], "t string, n int")
    write_consolidated(frame, str(tmp_path / "out"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert rows(back) == [('dice "sí", ok', "1")]


def test_sorted_report(spark, tmp_path):
    frame = spark.createDataFrame(
        [(g, d, c) for g in (1, 2) for d in (3, 1, 2) for c in ("b", "a")],
        "GRUPO int, DEPTO int, `CODIGO ERROR` string",
    )
    write_sorted_report(frame.repartition(3), str(tmp_path / "out"))
    for group in (1, 2):
        files = sorted((tmp_path / "out" / f"GRUPO={group}").glob("part-*.csv"))
        lines = [line for f in files for line in f.read_text().splitlines()[1:]]
        assert lines == ["1,a", "1,b", "2,a", "2,b", "3,a", "3,b"]


def test_staged_and_session(spark, tmp_path):
    frame = staged(spark.range(5).toDF("n"), str(tmp_path / "t"))
    assert frame.count() == 5 and frame.inputFiles()
    assert tune(spark) is spark
    assert checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir", None)


def test_full_run(spark, tables, tmp_path):
    sheet = rule_sheet(
        spark, rule("PPA03 es vacio", "P1"), rule("P01H10 > 0", "H2"), rule("P01H10 es vacio", "H1"),
        rule("P99 = 1", "X1"),
    )
    sectors = spark.createDataFrame([(1, 101), (2, 100), (3, 999)], "GRUPO int, SECTOR int")
    places = spark.createDataFrame([(1, 2, 101, 1)], schemas.GROUPS_BY_GEOGRAPHY)
    out = str(tmp_path / "run")
    result = run(tables, sheet, sectors, places, *WINDOW, out, as_of="2023-10-04")
    assert rows(result.violations, "CODIGO ERROR", "VIVIENDA", "CP") == [
        ("ACECO14", 1, 2), ("H1", 1, 0), ("H2", 4, 0), ("P1", 1, 2)
    ]
    # open-text rows without a group stay in the total, not in the group report
    assert rows(result.open_text, "VIVIENDA", "CP", "GRUPO") == [
        (1, 1, 1), (1, 3, 1), (2, 1, None), (4, 2, None)
    ]
    assert rows(result.report, "GRUPO", "CODIGO ERROR", "CP") == [
        (1, "10C00251", 1), (1, "10C00251", 3), (1, "ACECO14", 2), (1, "H1", 0), (1, "P1", 2), (2, "H2", 0)
    ]
    assert "VALOR" not in result.report.columns
    assert rows(result.deliverable) == [(1, 5)]
    assert rows(result.rejected, "codigo") == [("X1",)]
    read = spark.read.option("header", True).csv
    assert rows(read(f"{out}/by_code"), "CODIGO ERROR", "FRECUENCIA") == [
        ("ACECO14", "1"), ("H1", "1"), ("H2", "1"), ("P1", "1")
    ]
    assert rows(read(f"{out}/by_interviewer")) == [("3001", "3"), ("3004", "1")]
    assert read(f"{out}/final").count() == 6 and read(f"{out}/violations_csv").count() == 4
    assert sorted(p.name for p in (tmp_path / "run" / "rules_by_group").glob("GRUPO=*")) == ["GRUPO=1", "GRUPO=2"]


def test_run_without_the_farm_chapter(spark, tables, tmp_path):
    """A survey without the cross-checked tables: the check is reported as rejected, the rest runs."""
    from surveyqa import SurveyTables

    fewer = SurveyTables({k: v for k, v in tables.tables.items() if k[0] != "agricola"})
    sectors = spark.createDataFrame([(1, 101)], "GRUPO int, SECTOR int")
    places = spark.createDataFrame([(1, 2, 101, 1)], schemas.GROUPS_BY_GEOGRAPHY)
    result = run(
        fewer, rule_sheet(spark, rule("PPA03 es vacio", "P1")), sectors, places, *WINDOW,
        str(tmp_path / "run"), as_of="2023-10-04",
    )
    assert rows(result.rejected, "codigo") == [("ACECO14",)]
    assert rows(result.violations, "CODIGO ERROR") == [("P1",)]
