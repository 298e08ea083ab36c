"""Survey tables as views of the given tables.

Orders stand for questionnaires, line items for persons, customers for cases, events for visits,
nations for sectors and regions for field groups. Some values are turned into NULL or ``""``, since
the given tables hold none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from surveyqa import SurveyTables
from surveyqa import fixed_values as fv

NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The same expressions serve Spark and the SQL check only in their arithmetic; dates and casts are
# written out on each side.
PLACE = (
    "o_orderkey % 22 + 1 AS DEPTO", "o_orderkey % 17 + 1 AS MUPIO", "o_custkey % 28 AS SECTOR",
    "o_orderkey div 1000 AS ESTRUCTURA", "o_orderkey % 1000 AS VIVIENDA", "o_orderkey % 3 + 1 AS HOGAR",
)


def level_1(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS `LEVEL-1-ID`", "o_custkey AS `CASE-ID`", *PLACE, "o_custkey % 20 AS ENCUESTADOR"
    )


def personas(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "l_orderkey AS `LEVEL-1-ID`", "l_linenumber AS CP",
        "nullif(CAST(l_quantity AS INT), 50) AS PPA03",
        "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS PPA10",
        "CAST(round(l_discount * 100) AS INT) AS P10C01",
        "l_suppkey % 9 AS P10C21", "l_partkey % 9 AS P10D07", "nullif(l_tax, 0.0D) AS P10C47",
        "CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linenumber = 2 THEN '' ELSE l_returnflag END"
        " AS P10A01",
        "CASE l_linenumber WHEN 1 THEN 'Nada' WHEN 2 THEN 'ñu' WHEN 3 THEN NULL"
        " ELSE 'sembrar maíz ' || l_returnflag END AS P10C02",
        "CASE l_linenumber WHEN 4 THEN 'ninguna' WHEN 5 THEN '' ELSE 'venta de ropa' END AS P10C03",
        "CASE l_linenumber WHEN 6 THEN 'por' ELSE 'cooperativa ' || l_linestatus END AS P10C04",
        "CASE l_linenumber WHEN 7 THEN l_returnflag ELSE 'frijol' END AS P10C07",
    )


def survey_tables(spark: SparkSession, sf_dir: str) -> SurveyTables:
    """Both rounds; the second holds the questionnaires that are not pending."""
    orders = given(spark, sf_dir, "orders")
    second = orders.filter("o_orderstatus <> 'P'")
    lineitem = given(spark, sf_dir, "lineitem")
    cases = given(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS ID", "CASE WHEN c_nationkey = 0 THEN 1 ELSE 0 END AS DELETED"
    )
    tables = {
        (fv.HOUSEHOLD_TABLE, "PR"): level_1(orders),
        (fv.CASES_TABLE, "PR"): cases,
        ("personas", "PR"): personas(lineitem),
        ("agricola", "PR"): lineitem.selectExpr(
            "l_orderkey AS `LEVEL-1-ID`", "nullif(l_linenumber, 7) AS P14A04",
            "CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE l_returnflag END AS P14A03A",
        ),
        ("vivienda", "PR"): orders.selectExpr(
            "o_orderkey AS `LEVEL-1-ID`", "CAST(substring(o_orderpriority, 1, 1) AS INT) AS P01H09",
            "nullif(o_custkey % 10, 3) AS P01H10", "nullif(o_orderkey % 7, 2) AS P01H11",
            "o_totalprice AS P01A05",
        ),
        (fv.STATE_TABLE["PR"], "PR"): orders.selectExpr(
            "o_orderkey AS `LEVEL-1-ID`", "CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS ESTADO_PR"
        ),
        (fv.TIME_TABLE["PR"], "PR"): orders.selectExpr(
            "o_orderkey AS `LEVEL-1-ID`",
            "date_format(o_orderdate, 'dd/MM/yy') AS FECHA_INICIO_CAP_1",
        ),
        (fv.VISITS_TABLE, "PR"): given(spark, sf_dir, "events").selectExpr(
            "user_id AS `LEVEL-1-ID`", "date_format(ts, 'dd/MM/yy') AS R1_FECHA_INICIAL"
        ),
        (fv.HOUSEHOLD_TABLE, "SR"): level_1(second),
        (fv.CASES_TABLE, "SR"): cases,
        ("capxiii", "SR"): second.selectExpr(
            "o_orderkey AS `LEVEL-1-ID`", "o_custkey % 40 AS P13A04A", "o_custkey % 3 AS P13A07A",
            "o_orderkey % 31 AS P13A07C", "o_orderkey % 3 AS P13A07E",
        ),
        (fv.STATE_TABLE["SR"], "SR"): second.selectExpr(
            "o_orderkey AS `LEVEL-1-ID`",
            "CASE WHEN o_orderpriority = '5-LOW' THEN 2 ELSE 1 END AS ESTADO_SR",
        ),
        (fv.TIME_TABLE["SR"], "SR"): second.selectExpr(
            "o_orderkey AS `LEVEL-1-ID`",
            "date_format(date_add(CAST(o_orderdate AS DATE), 30), 'dd/MM/yy') AS FECHA_INICIO_CAPXIIIA",
        ),
    }
    return SurveyTables(tables)


# (condition, chapter, section, question, definition, code, analyst)
RULES = [
    ("PPA03 >= 48 & CP no es vacio", 3, "A", 3, "Edad alta", "03A00301", "Ana"),
    ("PPA03 es vacio", 3, "A", 3, "Edad sin dato", "03A00302", "Ana"),
    ("P10A01 es vacío y PPA03 < 3", 10, "A", 1, "Respuesta sin dato en menores", "10A00101", "Luis"),
    ("P10C21 está en (5,6) & P10D07 no está en (0,1,2,3,4,5,6)", 10, "C", 21, "Ocupación", "10C02101", "Luis"),
    ("P10C47 <> 0.08 & PPA03 = 10", 10, "C", 47, "Horas distintas", "10C04701", "Luis"),
    ("P01H09 = 1 y (P01H10 = (VACIO) o P01H11 = (VACIO))", 1, "H", 9, "Hogar sin dato", "01H00901", "Eva"),
    ("P01A05 > 480000 | P01A05 < 1500", 1, "A", 5, "Gasto fuera de rango", "01A00501", "Eva"),
    ("P01H09 = 5 & PPA03 = 7", 1, "H", 10, "Hogar y persona", "01H01001", "Eva"),
    ("P13A04A está en (27,29,30,31,32,33) & P13A07A = P13A07E", 13, "A", 4, "Segunda ronda", "13A00401", "Eva"),
    ("P99X01 = 1", 99, "X", 1, "Variable desconocida", "99X00101", "Eva"),
]
