"""ANSI SQL for the registered queries, written independently of the library."""

from __future__ import annotations

_CROSS_DEFINITION = (
    "No está registrando los mismos CPs en actividad agrícola en el capítulo 10 y el 14. "
    "No es coincidente la información de los CPs registrados. Verifique sección C o D capítulo 10, "
    "persona ingresada como actividad económica no agrícola y no está siendo registrada en el capítulo 14 "
    "o bien, está registrando información en el capítulo 14 de una persona pero no la categorizó como "
    "actividad económica no agrícola en el capítulo 10."
)
_OPEN_TEXT = (
    ("P10C02", 2, 3, ("NO", "NA", "N/A", "NADA", "ESTUDIA", "ESTUDIAR", "NINGUNO"),
     "10C00251", "P10C02 Ocupación principal falta o insuficientemente descrita"),
    ("P10C03", 3, 3, ("NO", "NA", "N/A", "NADA", "ESTUDIA", "ESTUDIAR", "NINGUNA", "NINGUNO"),
     "10C00351", "P10C03 Actividad principal falta o insuficientemente descrita"),
    ("P10C04", 4, 2, ("NO", "NA", "N/A", "POR", "NADA", "ESTUDIA", "ESTUDIAR"),
     "10C00451", "P10C04 Empresa falta o insuficientemente descrita"),
    ("P10C07", 7, 2, ("NO", "NA", "N/A", "POR", "NADA", "ESTUDIA", "ESTUDIAR"),
     "10C00751", "P10C07 Productos falta o insuficientemente descrita"),
)

# The survey tables over the given ones, as common table expressions.
_LEVEL = """
level1 AS (
  SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
         CAST(o_orderdate AS DATE) AS fecha, o_custkey % 20 AS encuestador,
         o_orderkey % 22 + 1 AS depto, o_orderkey % 17 + 1 AS mupio, o_custkey % 28 AS sector,
         o_orderkey // 1000 AS estructura, o_orderkey % 1000 AS vivienda, o_orderkey % 3 + 1 AS hogar,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS p01h09,
         CASE WHEN o_custkey % 10 = 3 THEN NULL ELSE o_custkey % 10 END AS p01h10,
         CASE WHEN o_orderkey % 7 = 2 THEN NULL ELSE o_orderkey % 7 END AS p01h11
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE c_nationkey <> 0
),
inwin AS (
  SELECT * FROM level1 WHERE fecha BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
),
persona AS (
  SELECT l_orderkey AS id, l_linenumber AS cp,
         CASE WHEN CAST(l_quantity AS INTEGER) = 50 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS ppa03,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS ppa10,
         CAST(round(l_discount * 100) AS INTEGER) AS p10c01,
         l_suppkey % 9 AS p10c21, l_partkey % 9 AS p10d07,
         CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS p10c47,
         CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linenumber = 2 THEN '' ELSE l_returnflag END AS p10a01,
         CASE l_linenumber WHEN 1 THEN 'Nada' WHEN 2 THEN 'ñu' WHEN 3 THEN NULL
              ELSE 'sembrar maíz ' || l_returnflag END AS p10c02,
         CASE l_linenumber WHEN 4 THEN 'ninguna' WHEN 5 THEN '' ELSE 'venta de ropa' END AS p10c03,
         CASE l_linenumber WHEN 6 THEN 'por' ELSE 'cooperativa ' || l_linestatus END AS p10c04,
         CASE l_linenumber WHEN 7 THEN l_returnflag ELSE 'frijol' END AS p10c07,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS p14a04,
         CASE l_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE l_returnflag END AS p14a03a
  FROM lineitem
)"""

_PLACE = "depto AS DEPTO, mupio AS MUPIO, sector AS SECTOR, estructura AS ESTRUCTURA, vivienda AS VIVIENDA, hogar AS HOGAR"
_FECHA = "strftime(fecha, '%Y-%m-%d') AS FECHA"


def _violation(base: str, cp: str, where: str, rule: tuple, fecha: str = "fecha") -> str:
    chapter, section, question, definition, code = rule
    return (
        f"SELECT strftime({fecha}, '%Y-%m-%d') AS FECHA, encuestador AS ENCUESTADOR, {_PLACE}, "
        f"CAST({cp} AS BIGINT) AS CP, CAST({chapter} AS INTEGER) AS CAPITULO, '{section}' AS SECCION, "
        f"CAST({question} AS INTEGER) AS PREGUNTA, '{definition}' AS \"DEFINICION DE INCONSISTENCIA\", "
        f"'{code}' AS \"CODIGO ERROR\", CAST(NULL AS VARCHAR) AS COMENTARIOS FROM {base} WHERE {where}"
    )


_PERSON = "inwin JOIN persona USING (id)"
_VIOLATIONS = " UNION ALL ".join([
    _violation(_PERSON, "cp", "ppa10 = 1 AND ppa03 >= 48 AND cp IS NOT NULL",
               (3, "A", 3, "Edad alta", "03A00301")),
    _violation(_PERSON, "cp", "ppa10 = 1 AND ppa03 IS NULL", (3, "A", 3, "Edad sin dato", "03A00302")),
    _violation(_PERSON, "cp", "ppa10 = 1 AND (p10a01 IS NULL OR p10a01 = '') AND ppa03 < 3",
               (10, "A", 1, "Respuesta sin dato en menores", "10A00101")),
    _violation(_PERSON, "cp", "ppa10 = 1 AND p10c21 IN (5, 6) AND p10d07 NOT IN (0, 1, 2, 3, 4, 5, 6)",
               (10, "C", 21, "Ocupación", "10C02101")),
    _violation(_PERSON, "cp", "ppa10 = 1 AND (p10c47 IS NULL OR p10c47 <> 0.08) AND ppa03 = 10",
               (10, "C", 47, "Horas distintas", "10C04701")),
    _violation("inwin", "0", "o_orderstatus <> 'O' AND p01h09 = 1 AND (p01h10 IS NULL OR p01h11 IS NULL)",
               (1, "H", 9, "Hogar sin dato", "01H00901")),
    _violation("inwin", "0", "o_orderstatus <> 'O' AND (o_totalprice > 480000 OR o_totalprice < 1500)",
               (1, "A", 5, "Gasto fuera de rango", "01A00501")),
    _violation(_PERSON, "cp", "ppa10 = 1 AND p01h09 = 5 AND ppa03 = 7",
               (1, "H", 10, "Hogar y persona", "01H01001")),
    _violation("level1", "0",
               "o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' "
               "AND fecha + 30 BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' "
               "AND o_custkey % 40 IN (27, 29, 30, 31, 32, 33) AND o_custkey % 3 = id % 3",
               (13, "A", 4, "Segunda ronda", "13A00401"), "fecha + 30"),
])
_WITH = f"WITH {_LEVEL.strip()}"
_VIOL = f"{_WITH}, viol AS ({_VIOLATIONS})"
_GROUPED = (
    f"{_VIOL}, grouped AS (SELECT viol.*, n_regionkey AS GRUPO FROM viol "
    "JOIN nation ON viol.SECTOR = n_nationkey)"
)

_BIJECTION = f"""
l AS (SELECT DISTINCT id, cp FROM {_PERSON} WHERE ppa10 = 1 AND ppa03 >= 18
      AND (p10c21 IN (5, 6) OR p10d07 IN (5, 6) OR p10c47 > 0)),
r AS (SELECT DISTINCT id, p14a04 AS cp FROM {_PERSON}
      WHERE o_orderstatus <> 'O' AND p14a04 IS NOT NULL AND coalesce(p14a03a, '') <> ''),
d AS (SELECT id, coalesce(l.cp, r.cp) AS cp FROM l FULL JOIN r USING (id, cp)
      WHERE l.cp IS NULL OR r.cp IS NULL)"""
_BOTH = "id IN (SELECT id FROM l) AND id IN (SELECT id FROM r)"

_NULLABLE = """WITH n AS (
  SELECT l_orderkey AS ORDEN, l_linenumber AS CP,
         CASE WHEN CAST(l_quantity AS INTEGER) = 10 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS CANTIDAD,
         l_suppkey % 9 AS PROVEEDOR, CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS DESCUENTO,
         CASE l_returnflag WHEN 'N' THEN NULL WHEN 'A' THEN '' ELSE l_returnflag END AS MARCA
  FROM lineitem
) SELECT * FROM n WHERE """

_PART_RULES = """WITH rules AS (
  SELECT 'R' || p_partkey AS codigo, p_brand, p_size, p_type,
         'V' || p_size || 'X' AS v1, 'V' || (p_partkey % 25) || 'X' AS v2
  FROM part
)"""

_CORRECTIONS = """WITH raw AS (
  SELECT l_orderkey AS household, l_orderkey % 22 + 1 AS depto, l_orderkey % 17 + 1 AS mupio,
         l_orderkey // 1000 AS estructura, l_orderkey % 1000 AS vivienda, l_orderkey % 3 + 1 AS hogar,
         CASE WHEN l_quantity = 49 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS cp,
         CASE WHEN l_returnflag = 'A' THEN 'personas.ppa03' WHEN l_returnflag = 'R' THEN 'personas.p10a01'
              WHEN l_linestatus = 'F' THEN 'vivienda.p01h10' END AS variable,
         CASE WHEN l_linenumber = 6 THEN NULL WHEN l_returnflag = 'R' THEN 'O''Neil ' || l_suppkey
              ELSE CAST(l_suppkey % 90 AS VARCHAR) END AS nuevo,
         l_partkey * 100 + l_suppkey % 100 AS seq
  FROM lineitem
),
clean AS (
  SELECT *, split_part(variable, '.', 1) AS tabla, upper(split_part(variable, '.', 2)) AS columna
  FROM raw WHERE variable IS NOT NULL AND nuevo IS NOT NULL
),
placed AS (SELECT clean.*, o_custkey % 28 AS sector FROM clean JOIN orders ON household = o_orderkey)"""


# Person tables of both rounds, and corrections that say their round.
_PEOPLE = """people AS (
  SELECT *, CASE WHEN CAST(l_quantity AS INTEGER) <> 50 THEN CAST(l_quantity AS INTEGER) END AS ppa03,
         CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linenumber = 2 THEN '' ELSE l_returnflag END AS p10a01
  FROM (SELECT 'PR' AS ronda, * FROM lineitem UNION ALL SELECT 'SR', lineitem.* FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE o_orderstatus <> 'P' AND l_linenumber <> 3)
)"""
_SAID = "CASE WHEN seq % 10 = 0 THEN NULL WHEN seq % 10 = 1 THEN 'XX' WHEN seq % 3 = 0 THEN 'SR' ELSE 'PR' END"
_ROUND_CELLS = f"""{_CORRECTIONS}, {_PEOPLE},
cell AS (
  SELECT l.ronda, l.l_orderkey, l.l_linenumber, columna, nuevo, seq,
         row_number() OVER (PARTITION BY l.ronda, l.l_orderkey, l.l_linenumber, columna ORDER BY seq DESC, nuevo DESC) AS k
  FROM (SELECT DISTINCT ronda, l_orderkey, l_linenumber FROM people) l
  JOIN (SELECT *, {_SAID} AS said FROM placed) p
    ON l.l_orderkey = p.household AND said = l.ronda AND (p.cp IS NULL OR p.cp = l.l_linenumber)
  WHERE tabla = 'personas'
)"""


def _many_rules() -> str:
    """A hundred rules as a hundred counts."""
    flags = ", ".join(
        f"CAST(count(*) FILTER (WHERE (CANTIDAD > {n % 50} AND PROVEEDOR = {n % 9}) OR "
        f"((DESCUENTO IS NULL OR DESCUENTO <> 0.0{n % 10}) AND CP = {n % 7})) AS BIGINT)"
        for n in range(100)
    )
    return (
        _NULLABLE.replace("SELECT * FROM n WHERE ", "")
        + f", counts AS (SELECT [{flags}] AS c FROM n), r AS (SELECT unnest(range(100)) AS i) "
        "SELECT CAST(i AS INTEGER) AS rule_id, c[i + 1] AS n FROM counts, r WHERE c[i + 1] > 0"
    )


def _open_text() -> str:
    parts = [
        f"SELECT encuestador AS ENCUESTADOR, {_PLACE}, cp AS CP, 10 AS CAPITULO, 'C' AS SECCION, "
        f"{question} AS PREGUNTA, '{label}' AS \"DEFINICION DE INCONSISTENCIA\", "
        f"'{code}' AS \"CODIGO ERROR\", '' AS COMENTARIOS, {column.lower()} AS VALOR "
        "FROM level1 JOIN persona USING (id) "
        "WHERE p10c01 >= 1 AND o_orderstatus <> 'O' "
        f"AND (strlen(coalesce({column.lower()}, '')) <= {size} OR upper(coalesce({column.lower()}, '')) IN "
        f"({', '.join(repr(w) for w in words)})) "
        "AND (SELECT date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-02') FROM events "
        "WHERE user_id = id) <= 4"
        for column, question, size, words, code, label in _OPEN_TEXT
    ]
    return f"{_WITH} " + " UNION ".join(parts)


ORACLE_SQL: dict[str, str] = {
    "scan_snapshot": "SELECT * FROM customer",
    "upper_columns": "SELECT p_partkey AS P_PARTKEY, p_name AS P_NAME, p_brand AS P_BRAND, "
    "p_type AS P_TYPE, p_size AS P_SIZE, p_retailprice AS P_RETAILPRICE FROM part",
    "strip_suffixes": 'SELECT s_suppkey AS "ID", s_name AS "ESTADO", s_nationkey AS "ZONA" FROM supplier',
    "table_profile": " UNION ALL ".join(
        f"SELECT '{name}' AS tabla, count(*) AS filas, {columns} AS columnas FROM {name}"
        for name, columns in (
            ("region", 2), ("nation", 3), ("customer", 5), ("supplier", 4), ("part", 6), ("orders", 6),
            ("lineitem", 11), ("events", 6), ("documents", 5), ("embeddings", 3), ("pages", 3),
            ("benchmark", 2), ("labels", 3), ("conversations", 4),
        )
    ),
    "filter_project": f"{_WITH} SELECT depto AS DEPTO, hogar AS HOGAR, cp AS CP, ppa03 AS PPA03 "
    "FROM level1 JOIN persona USING (id) WHERE ppa10 = 1 AND ppa03 >= 40 AND p10a01 <> ''",
    "pred_compare": _NULLABLE + "CANTIDAD > 40 AND CP <= PROVEEDOR AND DESCUENTO = 0.05",
    "pred_and_or": _NULLABLE + "CANTIDAD = 49 OR (CP = 7 AND (PROVEEDOR = 1 OR PROVEEDOR >= 7))",
    "pred_in": _NULLABLE + "CANTIDAD IN (5, 6, 7) AND MARCA IN ('R', '')",
    "pred_not_equal_null": _NULLABLE + "coalesce(MARCA <> 'R', TRUE) AND coalesce(CANTIDAD <> 20, TRUE)",
    "pred_not_in_null": _NULLABLE + "coalesce(CANTIDAD NOT IN (1, 2, 3, 4, 5), TRUE)",
    "pred_empty_numeric": _NULLABLE + "CANTIDAD IS NULL AND DESCUENTO IS NOT NULL",
    "pred_empty_text": _NULLABLE + "(coalesce(MARCA, '') = '' AND CP = 3) OR (coalesce(MARCA, '') <> '' AND CP = 5)",
    "pred_arithmetic": _NULLABLE + "CANTIDAD - CP * 2 > 40 AND PROVEEDOR <= 2",
    "base_assembly": f'{_WITH} SELECT id AS "LEVEL-1-ID", {_FECHA}, encuestador AS ENCUESTADOR, {_PLACE}, '
    "cp AS CP, ppa03 AS PPA03, p01h09 AS P01H09, p01h10 AS P01H10 FROM level1 JOIN persona USING (id) WHERE ppa10 = 1",
    "finished_only": f'{_WITH} SELECT id AS "LEVEL-1-ID", {_FECHA}, encuestador AS ENCUESTADOR, {_PLACE}, '
    "0 AS CP, p01h09 AS P01H09 FROM level1 WHERE o_orderstatus <> 'O'",
    "date_window": f'{_WITH} SELECT id AS "LEVEL-1-ID", {_FECHA}, p01h10 AS P01H10 FROM level1 '
    "WHERE o_orderstatus <> 'O' AND fecha >= DATE '1997-03-10' AND fecha <= DATE '1997-09-20'",
    "household_default_cp": f'{_WITH} SELECT id AS "LEVEL-1-ID", 0 AS CP, sector AS SECTOR FROM level1 '
    "WHERE o_orderstatus <> 'O' AND p01h10 IS NULL",
    "cross_round": f'{_WITH} SELECT id AS "LEVEL-1-ID", strftime(fecha + 30, \'%Y-%m-%d\') AS FECHA, '
    f"encuestador AS ENCUESTADOR, {_PLACE}, cp AS CP, ppa03 AS PPA03, o_custkey % 40 AS P13A04A "
    f"FROM {_PERSON} WHERE ppa10 = 1 AND o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' "
    "AND fecha + 30 BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'",
    "rule_violations": f"{_VIOL} SELECT * FROM viol",
    "many_rules": _many_rules(),
    "bijection_check": f"""{_WITH}, {_BIJECTION}
SELECT {_FECHA}, encuestador AS ENCUESTADOR, {_PLACE}, CAST(cp AS BIGINT) AS CP,
       14 AS CAPITULO, 'A' AS SECCION, 3 AS PREGUNTA,
       '{_CROSS_DEFINITION}' AS "DEFINICION DE INCONSISTENCIA", 'ACECO14' AS "CODIGO ERROR",
       CAST(NULL AS VARCHAR) AS COMENTARIOS
FROM d JOIN inwin USING (id) WHERE {_BOTH}""",
    "collect_distinct": "SELECT l_orderkey, CAST(0 AS BIGINT) AS parte, "
    "string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)) AS miembros, "
    "strftime(min(CAST(l_shipdate AS DATE)), '%Y-%m-%d') AS FECHA FROM lineitem GROUP BY l_orderkey",
    "distinct_members": "SELECT l_orderkey, l_suppkey, min(l_linestatus) AS l_linestatus FROM lineitem GROUP BY 1, 2",
    "text_quality": " UNION ".join(
        f"SELECT doc_id, 10 AS CAPITULO, 'C' AS SECCION, {question} AS PREGUNTA, "
        f"'{label}' AS \"DEFINICION DE INCONSISTENCIA\", '{code}' AS \"CODIGO ERROR\", '' AS COMENTARIOS, "
        f"{column} AS VALOR FROM documents WHERE strlen(coalesce({column}, '')) <= {size} "
        f"OR upper(coalesce({column}, '')) IN {words}"
        for column, question, size, words, code, label in (
            ("text", 2, 60, "('NO', 'NA')", "D0001", "Texto corto"),
            ("lang", 3, 1, "('EN', 'ES')", "D0002", "Idioma"),
            ("source", 4, 0, "('WEB', 'FORUM', 'NEWS')", "D0003", "Fuente"),
        )
    ),
    "recent_visit": "SELECT user_id AS \"LEVEL-1-ID\", strftime(max(ts), '%Y-%m-%d') AS ultima_visita FROM events "
    "GROUP BY user_id HAVING date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-02') <= 4",
    "open_text": _open_text(),
    "group_sector_map": "SELECT c_nationkey AS GRUPO, CAST(substr(u, 8, length(u) - 9) AS INTEGER) AS SECTOR FROM ("
    "SELECT c_nationkey, 'U' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || "
    "CAST(CASE WHEN c_acctbal < 0 THEN c_custkey + 100000 ELSE c_custkey END AS VARCHAR) || 'XX' AS u FROM customer)",
    "group_distribution": f'{_GROUPED} SELECT GRUPO, SECTOR, DEPTO, HOGAR, CP, "CODIGO ERROR" FROM grouped',
    "left_group_join": "SELECT c_custkey, CASE WHEN c_nationkey = 4 THEN NULL ELSE c_nationkey + 3 END AS SECTOR, "
    "c_nationkey AS DEPTO, n_regionkey AS GRUPO FROM customer LEFT JOIN nation "
    "ON c_nationkey + 3 = n_nationkey",
    "deliverable_groups": f"{_GROUPED} SELECT GRUPO, count(*) AS n FROM grouped GROUP BY GRUPO HAVING count(*) > 1",
    "violations_rollup": f"{_GROUPED} SELECT GRUPO, CAST(grouping(GRUPO) AS INTEGER) AS es_total, count(*) AS n "
    "FROM grouped GROUP BY ROLLUP (GRUPO)",
    "freq_by_code": f'{_VIOL} SELECT "CODIGO ERROR", "DEFINICION DE INCONSISTENCIA", count(*) AS FRECUENCIA '
    "FROM viol GROUP BY 1, 2 ORDER BY 1, 2",
    "freq_by_interviewer": f"{_VIOL} SELECT ENCUESTADOR, count(*) AS FRECUENCIA FROM viol GROUP BY 1",
    "sorted_report": f'{_GROUPED} SELECT * FROM grouped ORDER BY GRUPO, DEPTO, "CODIGO ERROR"',
    "merge_reports": "SELECT o_custkey % 25 AS GRUPO, o_orderkey AS HOGAR, 'regla' AS ORIGEN FROM orders "
    "WHERE o_orderstatus = 'F' UNION ALL SELECT o_custkey % 30, o_orderkey, 'texto' FROM orders "
    "WHERE o_orderstatus <> 'F'",
    "outer_join": 'SELECT coalesce(o_orderkey, l_orderkey + 3) AS "LEVEL-1-ID", o_custkey AS P16A01, '
    "l_linenumber AS P17A06B FROM orders FULL JOIN lineitem ON o_orderkey = l_orderkey + 3",
    "frame_equality": "SELECT 'misma' AS tabla, TRUE AS igual, CAST(0 AS BIGINT) AS diferencias UNION ALL "
    "SELECT 'otra', count(*) = 0, CAST(2 * count(*) AS BIGINT) FROM part WHERE p_size = 5 UNION ALL "
    "SELECT 'columnas', FALSE, NULL",
    "rule_select": f"{_PART_RULES} SELECT codigo, p_size AS capitulo FROM rules "
    "WHERE p_brand = 'Brand#2' AND p_type = 'ECONOMY'",
    "rule_variables": f"{_PART_RULES} SELECT codigo, v1 || ',' || v2 || ',CP' AS variables, v1 AS primera FROM rules",
    "rule_routing": f"{_PART_RULES}, v AS (SELECT codigo, v1 AS v FROM rules UNION SELECT codigo, v2 FROM rules) "
    "SELECT DISTINCT codigo, 'T' || n_regionkey AS \"table\", CASE WHEN n_nationkey < 13 THEN 'PR' ELSE 'SR' END AS round "
    "FROM v JOIN nation ON v = 'V' || n_nationkey || 'X'",
    "rules_approved": f"{_PART_RULES} SELECT codigo, p_brand AS analista FROM rules "
    "WHERE codigo IN (SELECT 'R' || s_suppkey FROM supplier)",
    "codes_unreviewed": "SELECT 'R' || l_partkey AS codigo FROM lineitem WHERE NOT EXISTS "
    "(SELECT 1 FROM supplier WHERE s_suppkey = l_partkey)",
    "distinct_sections": "SELECT DISTINCT p_size AS capitulo, p_type AS seccion FROM part",
    "cleaning_extract": f"""{_WITH}
SELECT 'edades' AS nombre, {_PLACE.lower()}, cp AS cp, ppa03 AS personas_ppa03, p10c21 AS personas_p10c21,
       CAST(NULL AS BIGINT) AS personas_p10d07, CAST(NULL AS INTEGER) AS vivienda_p01h09,
       CAST(NULL AS BIGINT) AS vivienda_p01h11, CAST(NULL AS VARCHAR) AS variable,
       CAST(NULL AS VARCHAR) AS "valor nuevo"
FROM {_PERSON} WHERE ppa10 = 1 AND ppa03 IS NULL
UNION ALL
SELECT 'ocupacion', depto, mupio, sector, estructura, vivienda, hogar, cp, NULL, NULL, p10d07, NULL, NULL, NULL, NULL
FROM {_PERSON} WHERE ppa10 = 1 AND p10c21 IN (5, 6) AND p10d07 = 5
UNION ALL
SELECT 'hogares', depto, mupio, sector, estructura, vivienda, hogar, 0, NULL, NULL, NULL, p01h09, p01h11, NULL, NULL
FROM inwin WHERE o_orderstatus <> 'O' AND p01h09 = 1 AND p01h10 IS NULL""",
    "cleaning_query": f"""{_WITH}
SELECT {_PLACE.lower()}, cp AS cp, ppa03 AS personas_ppa03, p10c47 AS personas_p10c47,
       CAST(NULL AS VARCHAR) AS variable, CAST(NULL AS VARCHAR) AS "valor nuevo"
FROM {_PERSON} WHERE ppa10 = 1 AND ppa03 IS NULL AND p10a01 <> ''""",
    "split_list": "SELECT p_partkey, p_brand || '|' || p_type || '|' || p_name AS lista FROM part",
    "corrections_clean": f'{_CORRECTIONS} SELECT household, cp, tabla, columna, nuevo AS "valor nuevo", seq FROM clean',
    "corrections_sql": f"""{_CORRECTIONS}
SELECT seq, 'UPDATE ' || CASE WHEN tabla = 'vivienda' THEN 'base_sr' ELSE 'base_pr' END || '.' || tabla || ' AS '
  || tabla || ' JOIN `level-1` ON ' || tabla || '.`level-1-id` = `level-1`.`level-1-id` SET ' || tabla || '.'
  || lower(columna) || ' = '
  || CASE WHEN columna = 'P10A01' THEN '''' || replace(nuevo, '''', '''''') || '''' ELSE nuevo END
  || ' WHERE `level-1`.`depto` = ' || depto || ' and `level-1`.`mupio` = ' || mupio
  || ' and `level-1`.`sector` = ' || sector || ' and `level-1`.`estructura` = ' || estructura
  || ' and `level-1`.`vivienda` = ' || vivienda || ' and `level-1`.`hogar` = ' || hogar
  || CASE WHEN tabla = 'personas' AND coalesce(cp, 0) <> 0 THEN ' and `personas`.`cp` = ' || cp ELSE '' END
  || '; ' AS sentencia
FROM placed""",
    "corrections_conflicts": f"{_CORRECTIONS} SELECT depto, mupio, sector, estructura, vivienda, hogar, coalesce(cp, 0) AS cp, tabla, "
    "columna, min(nuevo) AS menor, max(nuevo) AS mayor, count(*) AS n FROM placed "
    "GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9 HAVING min(nuevo) <> max(nuevo)",
    "corrections_apply": f"""{_CORRECTIONS},
cell AS (
  SELECT l.l_orderkey, l.l_linenumber, columna, nuevo,
         row_number() OVER (PARTITION BY l.l_orderkey, l.l_linenumber, columna ORDER BY seq DESC, nuevo DESC) AS k
  FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) l
  JOIN placed p ON l.l_orderkey = p.household AND (p.cp IS NULL OR p.cp = l.l_linenumber)
  WHERE tabla = 'personas'
),
age AS (SELECT * FROM cell WHERE k = 1 AND columna = 'PPA03'),
answer AS (SELECT * FROM cell WHERE k = 1 AND columna = 'P10A01')
SELECT t.l_orderkey AS "LEVEL-1-ID", t.l_linenumber AS CP,
       coalesce(CAST(age.nuevo AS INTEGER), CASE WHEN CAST(l_quantity AS INTEGER) <> 50 THEN CAST(l_quantity AS INTEGER) END) AS PPA03,
       coalesce(answer.nuevo, CASE WHEN l_returnflag = 'N' THEN NULL WHEN t.l_linenumber = 2 THEN '' ELSE l_returnflag END) AS P10A01,
       l_suppkey % 9 AS P10C21
FROM lineitem t
LEFT JOIN age ON t.l_orderkey = age.l_orderkey AND t.l_linenumber = age.l_linenumber
LEFT JOIN answer ON t.l_orderkey = answer.l_orderkey AND t.l_linenumber = answer.l_linenumber""",
    "corrections_audit": f"""{_CORRECTIONS},
last AS (
  SELECT household, nuevo, seq, row_number() OVER (PARTITION BY household ORDER BY seq DESC, nuevo DESC) AS k
  FROM placed WHERE tabla = 'vivienda'
)
SELECT 'vivienda' AS tabla, household AS "LEVEL-1-ID", 'P01H10' AS variable,
       CAST(CASE WHEN o_custkey % 10 = 3 THEN NULL ELSE o_custkey % 10 END AS VARCHAR) AS valor_anterior,
       nuevo AS valor_nuevo, seq, TRUE AS aplicado
FROM last JOIN orders ON household = o_orderkey WHERE k = 1""",
    "productivity_totals": "SELECT 'A' || user_id AS analista, CAST(count(*) AS BIGINT) AS conteo FROM events "
    "GROUP BY user_id",
    "analyst_list": "SELECT DISTINCT 'A' || user_id AS analista FROM events",
    "latest_batch": "SELECT strftime(date_trunc('minute', max(ts)), 'Inconsistencias_%d-%m-%H-%M') AS lote, "
    "strftime(max(ts), '%m-%d %H:%M') AS fecha FROM events WHERE event_type <> 'error'",
    "strip_accents": "SELECT doc_id, md5(strip_accents(text)) AS sin FROM documents",
    "collapse_ws": "SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS limpio FROM documents",
    "fill_cast_int": "SELECT l_orderkey, l_linenumber, "
    "CAST(CASE WHEN l_quantity = 7 THEN -1 ELSE l_quantity END AS BIGINT) AS cantidad, "
    "CASE WHEN l_discount = 0.05 THEN -1.0 ELSE l_discount END AS descuento FROM lineitem",
    "stream_rules": " UNION ALL ".join(
        "SELECT strftime(l_shipdate, '%Y-%m-%d') AS FECHA, l_suppkey % 20 AS ENCUESTADOR, "
        "l_orderkey % 22 + 1 AS DEPTO, l_orderkey % 17 + 1 AS MUPIO, l_suppkey % 25 AS SECTOR, "
        "l_orderkey AS ESTRUCTURA, l_orderkey % 1000 AS VIVIENDA, l_orderkey % 3 + 1 AS HOGAR, "
        f"CAST(l_linenumber AS BIGINT) AS CP, {chapter} AS CAPITULO, '{section}' AS SECCION, {question} AS PREGUNTA, "
        f"'{definition}' AS \"DEFINICION DE INCONSISTENCIA\", '{code}' AS \"CODIGO ERROR\", "
        f"CAST(NULL AS VARCHAR) AS COMENTARIOS FROM lineitem WHERE {where}"
        for chapter, section, question, definition, code, where in (
            (3, "A", 3, "Edad alta", "03A00301", "l_quantity >= 48 AND l_quantity <> 50"),
            (3, "A", 3, "Edad sin dato", "03A00302", "l_quantity = 50"),
            (10, "A", 1, "Respuesta sin dato en menores", "10A00101", "(l_returnflag = 'N' OR l_linenumber = 2) AND l_quantity < 3"),
            (10, "C", 21, "Ocupación", "10C02101", "l_suppkey % 9 IN (5, 6) AND l_partkey % 9 > 6"),
            (10, "C", 47, "Horas distintas", "10C04701", "l_tax <> 0.08 AND l_quantity = 10"),
            (1, "H", 9, "Hogar sin dato", "01H00901", "l_linenumber = 1 AND (l_orderkey % 10 = 3 OR l_orderkey % 7 = 2)"),
            (1, "A", 5, "Gasto fuera de rango", "01A00501", "l_extendedprice > 480000 OR l_extendedprice < 1500"),
            (1, "H", 10, "Hogar y persona", "01H01001", "l_linenumber = 5 AND l_quantity = 7"),
            (13, "A", 4, "Segunda ronda", "13A00401", "l_orderkey % 40 IN (27, 29, 30, 31, 32, 33) AND l_orderkey % 3 = l_suppkey % 3"),
        )
    ),
    "date_window_open": f'{_WITH}, finished AS (SELECT id AS "LEVEL-1-ID", {_FECHA}, fecha AS dia FROM level1 WHERE o_orderstatus <> \'O\') '
    "SELECT \"LEVEL-1-ID\", FECHA, 'desde' AS ventana FROM finished WHERE dia >= DATE '1997-03-10' UNION ALL "
    "SELECT \"LEVEL-1-ID\", FECHA, 'hasta' FROM finished WHERE dia <= DATE '1997-03-10'",
    "pred_exact_integers": "SELECT * FROM (SELECT l_orderkey AS ORDEN, l_linenumber AS CP, 9007199254740992 + l_linenumber AS GRANDE, "
    "9223372036854775800 + l_linenumber AS MAYOR, CASE WHEN l_linenumber = 2 THEN CAST(-2147483648 AS INTEGER) ELSE l_linenumber END AS ENTERO "
    "FROM lineitem) WHERE CP = 3 OR CP = 7 OR CP = 2",
    "section_run": f"""{_VIOL} SELECT * FROM viol WHERE CAPITULO = 10 AND SECCION = 'C'""",
    "batch_label": "SELECT strftime(ts, '%d-%m-%Y%H') AS etiqueta, count(*) AS n FROM events GROUP BY 1",
    "freq_with_cross_check": f"""{_VIOL}, {_BIJECTION}
SELECT "CODIGO ERROR", "DEFINICION DE INCONSISTENCIA", FRECUENCIA FROM (
  SELECT "CODIGO ERROR", "DEFINICION DE INCONSISTENCIA", count(*) AS FRECUENCIA FROM viol GROUP BY 1, 2 UNION ALL
  SELECT 'ACECO14', '{_CROSS_DEFINITION}', count(DISTINCT id) FROM d WHERE {_BOTH} AND id IN (SELECT id FROM inwin))
WHERE FRECUENCIA > 0""",
    "merge_reports_left": "SELECT o_custkey % 25 AS GRUPO, o_orderkey AS HOGAR, 'regla' AS ORIGEN FROM orders "
    "WHERE o_orderstatus = 'F' UNION ALL SELECT o_custkey % 30, o_orderkey, 'texto' FROM orders "
    "WHERE o_orderstatus <> 'F' AND o_custkey % 30 IN (SELECT o_custkey % 25 FROM orders WHERE o_orderstatus = 'F')",
    "line_counts": "SELECT o_orderstatus AS estado, CAST(count(*) AS BIGINT) AS lineas FROM orders GROUP BY 1",
    "group_files_roundtrip": f'{_GROUPED} SELECT GRUPO, SECTOR, DEPTO, HOGAR, CP, "CODIGO ERROR" FROM grouped',
    "corrections_unused": f"""{_CORRECTIONS},
sheet AS (
  SELECT CASE WHEN seq % 7 = 0 THEN 'personas.p99x01' WHEN seq % 11 = 0 THEN 'sin punto' ELSE variable END AS variable,
         CASE WHEN seq % 13 = 0 THEN 'x' ELSE nuevo END AS nuevo, seq, seq % 5 = 0 AS away
  FROM raw JOIN orders ON household = o_orderkey
)
SELECT seq, variable, nuevo AS "valor nuevo", motivo FROM (
  SELECT *, CASE WHEN variable IS NULL OR variable = 'sin punto' OR nuevo IS NULL THEN 'sin variable o valor'
    WHEN variable = 'personas.p99x01' THEN 'variable desconocida' WHEN away THEN 'hogar desconocido'
    WHEN variable <> 'personas.p10a01' AND NOT regexp_full_match(nuevo, '[0-9]+') THEN 'valor no convertible' END AS motivo FROM sheet
) WHERE motivo IS NOT NULL""",
    "group_files_whole": f"""{_GROUPED} SELECT * REPLACE ("DEFINICION DE INCONSISTENCIA" || chr(10) || '"línea" ' || CP || chr(10) || chr(10) || ', fin'
    AS "DEFINICION DE INCONSISTENCIA") FROM grouped""",
    "outer_join_four": """
WITH a AS (SELECT CASE WHEN o_orderkey <> 7 THEN o_orderkey END AS k, o_custkey AS P16A01 FROM orders),
b AS (SELECT CASE WHEN l_orderkey + 3 <> 10 THEN l_orderkey + 3 END AS k, l_linenumber AS P17A06B FROM lineitem),
c AS (SELECT CASE WHEN c_custkey * 4 <> 8 THEN c_custkey * 4 END AS k, c_nationkey AS P01A01 FROM customer),
d AS (SELECT CASE WHEN user_id * 2 <> 6 THEN user_id * 2 END AS k, count(*) AS P02A01 FROM events GROUP BY user_id)
SELECT coalesce(a.k, b.k, c.k, d.k) AS "LEVEL-1-ID", P16A01, P17A06B, P01A01, P02A01 FROM a FULL JOIN b ON a.k = b.k
FULL JOIN c ON coalesce(a.k, b.k) = c.k FULL JOIN d ON coalesce(a.k, b.k, c.k) = d.k""",
    "frame_in_list": "SELECT 'misma' AS tabla, TRUE AS igual UNION ALL "
    "SELECT 'otra', count(*) = 0 FROM lineitem WHERE l_linenumber = 7 AND l_tax <> 0.09 UNION ALL "
    "SELECT 'repetida', count(*) = 0 FROM lineitem WHERE l_linenumber = 7 UNION ALL SELECT 'columnas', FALSE",
    "corrections_apply_rounds": f"""{_ROUND_CELLS},
age AS (SELECT * FROM cell WHERE k = 1 AND columna = 'PPA03'),
answer AS (SELECT * FROM cell WHERE k = 1 AND columna = 'P10A01')
SELECT t.ronda, t.l_orderkey AS "LEVEL-1-ID", t.l_linenumber AS CP, coalesce(CAST(age.nuevo AS INTEGER), t.ppa03) AS PPA03,
       coalesce(answer.nuevo, t.p10a01) AS P10A01, l_suppkey % 9 AS P10C21
FROM people t
LEFT JOIN age ON t.ronda = age.ronda AND t.l_orderkey = age.l_orderkey AND t.l_linenumber = age.l_linenumber
LEFT JOIN answer ON t.ronda = answer.ronda AND t.l_orderkey = answer.l_orderkey AND t.l_linenumber = answer.l_linenumber""",
    "corrections_audit_rounds": f"""{_ROUND_CELLS}
SELECT 'personas' AS tabla, t.l_orderkey AS "LEVEL-1-ID", t.l_linenumber AS CP, columna AS variable,
       CASE WHEN columna = 'PPA03' THEN CAST(t.ppa03 AS VARCHAR) ELSE t.p10a01 END AS valor_anterior,
       nuevo AS valor_nuevo, seq, TRUE AS aplicado, t.ronda
FROM people t JOIN cell ON t.ronda = cell.ronda AND t.l_orderkey = cell.l_orderkey AND t.l_linenumber = cell.l_linenumber
WHERE k = 1""",
    "corrections_unused_all": f"""{_CORRECTIONS}, {_PEOPLE},
sheet AS (
  SELECT household, variable, nuevo, seq, CASE WHEN seq % 17 = 0 THEN 99 ELSE cp END AS cp, {_SAID} AS said, o_orderstatus
  FROM raw JOIN orders ON household = o_orderkey
),
usable AS (
  SELECT *, split_part(variable, '.', 1) AS tabla, split_part(variable, '.', 2) AS columna,
         CASE WHEN variable LIKE 'personas.%' THEN CASE WHEN said IN ('PR', 'SR') THEN said END
              WHEN coalesce(said, 'PR') = 'PR' THEN 'PR' END AS round,
         CASE WHEN variable LIKE 'personas.%' THEN coalesce(cp, 0) ELSE 0 END AS c
  FROM sheet WHERE variable IS NOT NULL AND nuevo IS NOT NULL
),
ranked AS (
  SELECT *, max({{'s': seq, 'v': nuevo}}) OVER (PARTITION BY round, household, c, tabla, columna) AS latest FROM usable
)
SELECT seq, variable, nuevo AS "valor nuevo", motivo FROM (
  SELECT *, CASE WHEN round IS NULL THEN 'ronda ambigua' WHEN round = 'SR' AND o_orderstatus = 'P' THEN 'hogar desconocido'
    WHEN tabla = 'personas' AND (round, household, c) NOT IN (
      SELECT (ronda, l_orderkey, l_linenumber) FROM people UNION SELECT (ronda, l_orderkey, 0) FROM people) THEN 'persona desconocida'
    WHEN {{'s': seq, 'v': nuevo}} < latest THEN 'reemplazada' END AS motivo
  FROM ranked
  UNION ALL SELECT *, NULL, NULL, NULL, NULL, NULL, 'sin variable o valor' FROM sheet WHERE variable IS NULL OR nuevo IS NULL
) WHERE motivo IS NOT NULL""",
    "bucketed_violations": f"{_VIOL} SELECT * FROM viol",
    "rules_from_parts": _NULLABLE.replace("SELECT * FROM n WHERE ", "") + """,
rules AS (SELECT DISTINCT p_size AS a, p_partkey % 9 AS b, p_partkey % 7 + 1 AS c FROM part)
SELECT CAST(a * 1000 + b * 10 + c AS INTEGER) AS rule_id, count(*) AS n FROM rules JOIN n
ON (CANTIDAD > a AND PROVEEDOR = b) OR (MARCA = 'R' AND CP = c) GROUP BY 1""",
    "productivity_ledger": "SELECT 'A' || user_id AS analista, CAST(count(*) AS BIGINT) AS conteo FROM events GROUP BY user_id",
    "stream_cross_check": f"""{_WITH}, {_BIJECTION}
SELECT {_FECHA}, encuestador AS ENCUESTADOR, {_PLACE}, CAST(cp AS BIGINT) AS CP, 'ACECO14' AS "CODIGO ERROR"
FROM d JOIN inwin USING (id) WHERE {_BOTH}""",
}
ORACLE_SQL["corrections_snapshot"] = ORACLE_SQL["corrections_apply"]
