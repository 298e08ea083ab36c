"""One local session and small hand-made survey tables."""

from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from surveyqa import SurveyTables  # noqa: E402
from surveyqa.session import SETTINGS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


PLACE = "DEPTO long, MUPIO long, SECTOR long, ESTRUCTURA long, VIVIENDA long, HOGAR long"


@pytest.fixture(scope="session")
def tables(spark):
    """Six households: 1-4 live and finished, 5 deleted, 6 unfinished; 3 has an unreadable date.

    Household 2 lies outside the date window used by the tests (September 2023), household 4 is in
    both rounds.
    """
    level = spark.createDataFrame(
        [(h, f"c{h}", 1, 2, 100 + h % 2, 1, h, 1, 3000 + h) for h in range(1, 7)],
        f"`LEVEL-1-ID` long, `CASE-ID` string, {PLACE}, ENCUESTADOR long",
    )
    cases = spark.createDataFrame(
        [(f"c{h}", 1 if h == 5 else 0) for h in range(1, 7)], "ID string, DELETED int"
    )
    persons = spark.createDataFrame(
        [
            (1, 1, 40, 1, 5, None, None, "Nada", 1),
            (1, 2, None, 1, 1, 6, None, "agricultor", 1),
            (1, 3, 12, 1, 5, 5, 10.0, None, 1),
            (2, 1, 50, 1, 5, None, None, "na", 1),
            (3, 1, 60, 1, 5, None, None, "ñu", 1),
            (4, 1, 30, 1, 2, 2, 3.5, "maestra", 1),
            (4, 2, 31, 2, 5, 5, 0.0, "no", 1),
            (5, 1, 32, 1, 5, 5, 0.0, "no", 1),
            (6, 1, 33, 1, 5, 5, 0.0, "", 0),
        ],
        "`LEVEL-1-ID` long, CP int, PPA03 int, PPA10 int, P10C21 int, P10D07 int, P10C47 double,"
        " P10C02 string, P10C01 int",
    ).withColumns({c: F.lit("respuesta") for c in ("P10C03", "P10C04", "P10C07")})
    farm = spark.createDataFrame(
        [(1, 1, "x"), (1, 2, "x"), (1, 2, "x"), (1, 3, ""), (4, 1, "y"), (4, None, "y"), (3, 9, "x")],
        "`LEVEL-1-ID` long, P14A04 int, P14A03A string",
    )
    house = spark.createDataFrame(
        [(h, h % 2, None if h == 1 else h) for h in range(1, 7)],
        "`LEVEL-1-ID` long, P01H09 int, P01H10 int",
    )
    cover = spark.createDataFrame(
        [(h, 2 if h == 6 else 1) for h in range(1, 7)], "`LEVEL-1-ID` long, ESTADO_PR int"
    )
    dates = {1: "23/09/23", 2: "01/12/23", 3: "31/02/23", 4: "25/09/23", 5: "24/09/23", 6: "24/09/23"}
    time = spark.createDataFrame(
        list(dates.items()), "`LEVEL-1-ID` long, FECHA_INICIO_CAP_1 string"
    )
    visits = spark.createDataFrame(
        [(1, "20/09/23"), (1, "02/10/23"), (2, "30/09/23"), (3, "28/09/23"), (4, "01/10/23"), (4, None)],
        "`LEVEL-1-ID` long, R1_FECHA_INICIAL string",
    )
    second_house = spark.createDataFrame(
        [(4, 7), (2, 7)], "`LEVEL-1-ID` long, P13A04A int"
    )
    second_state = spark.createDataFrame([(4, 1), (2, 2)], "`LEVEL-1-ID` long, ESTADO_SR int")
    second_time = spark.createDataFrame(
        [(4, "24/09/23"), (2, "24/09/23")], "`LEVEL-1-ID` long, FECHA_INICIO_CAPXIIIA string"
    )
    return SurveyTables({
        ("level-1", "PR"): level, ("cases", "PR"): cases, ("personas", "PR"): persons,
        ("agricola", "PR"): farm, ("vivienda", "PR"): house, ("caratula", "PR"): cover,
        ("tiempo_control", "PR"): time, ("registro_de_visitas_pr", "PR"): visits,
        ("level-1", "SR"): level, ("cases", "SR"): cases, ("capxiii", "SR"): second_house,
        ("estado_de_boleta", "SR"): second_state, ("control_tiempo", "SR"): second_time,
    })
