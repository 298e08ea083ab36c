"""Values that results depend on, kept together.

Fixed values: names, word lists, texts and formats of the survey data model.
They must stay exactly as they are for results to match.
"""

# Rounds and keys.
FIRST_ROUND = "PR"
SECOND_ROUND = "SR"
ROUNDS = (FIRST_ROUND, SECOND_ROUND)
HOUSEHOLD_KEY = "LEVEL-1-ID"
CASE_KEY = "CASE-ID"
CASE_TABLE_KEY = "ID"
DELETED = "DELETED"
PERSON = "CP"
PERSON_STATUS = "PPA10"
INTERVIEWER = "ENCUESTADOR"
DATE = "FECHA"
CARTOGRAPHY = ("DEPTO", "MUPIO", "SECTOR", "ESTRUCTURA", "VIVIENDA", "HOGAR")

# Tables that every base needs, by round.
HOUSEHOLD_TABLE = "level-1"
CASES_TABLE = "cases"
TIME_TABLE = {"PR": "tiempo_control", "SR": "control_tiempo"}
START_DATE = {"PR": "FECHA_INICIO_CAP_1", "SR": "FECHA_INICIO_CAPXIIIA"}
STATE_TABLE = {"PR": "caratula", "SR": "estado_de_boleta"}
STATE = {"PR": "ESTADO_PR", "SR": "ESTADO_SR"}
VISITS_TABLE = "registro_de_visitas_pr"
VISIT_DATE = "R1_FECHA_INICIAL"
SURVEY_DATE_FORMAT = "d/M/yy"

# Columns left out of the variable catalog.
NOT_VARIABLES = ("LEVEL-1-ID", "INDEX")

# Words of a condition that are not variables.
CONDITION_WORDS = ("VACIO", "NO", "ES", "ESTA", "ESTÁ")
VARIABLE_PATTERN = r"\b([A-Z][A-Za-z0-9]+)\b"
LEADING_VARIABLE_PATTERN = r"^\s*([A-Za-z_][A-Za-z\d_]*)\s*[<>!=]*"

# Rule sheet columns.
RULE_CONDITION = "Condición o Criterio"
RULE_CHAPTER = "Capítulo"
RULE_SECTION = "Sección"
RULE_QUESTION = "Pregunta"
RULE_DEFINITION = "Definición de la Validación"
RULE_CODE = "Código de Error"
RULE_ANALYST = "Analista"

# Violation columns, in report order.
VIOLATION_COLUMNS = (
    "FECHA", "ENCUESTADOR", "DEPTO", "MUPIO", "SECTOR", "ESTRUCTURA", "VIVIENDA", "HOGAR", "CP",
    "CAPITULO", "SECCION", "PREGUNTA", "DEFINICION DE INCONSISTENCIA", "CODIGO ERROR", "COMENTARIOS",
)
DEFINITION = "DEFINICION DE INCONSISTENCIA"
CODE = "CODIGO ERROR"

# Cleaning sheet columns.
CLEANING_NAME = "NOMBRE ARCHIVO"
CLEANING_CONDITION = "CONDICION O CRITERIO"
CLEANING_VARIABLES = "VARIABLES A EXPORTAR"
NEW_VALUE = "valor nuevo"

# Open-text check: column, question, longest text in bytes still too short, stop words, code, label.
OPEN_TEXT_CHAPTER = 10
OPEN_TEXT_SECTION = "C"
OPEN_TEXT_CHECKS = (
    ("P10C02", 2, 3, ("NO", "NA", "N/A", "NADA", "ESTUDIA", "ESTUDIAR", "NINGUNO"),
     "10C00251", "P10C02 Ocupación principal falta o insuficientemente descrita"),
    ("P10C03", 3, 3, ("NO", "NA", "N/A", "NADA", "ESTUDIA", "ESTUDIAR", "NINGUNA", "NINGUNO"),
     "10C00351", "P10C03 Actividad principal falta o insuficientemente descrita"),
    ("P10C04", 4, 2, ("NO", "NA", "N/A", "POR", "NADA", "ESTUDIA", "ESTUDIAR"),
     "10C00451", "P10C04 Empresa falta o insuficientemente descrita"),
    ("P10C07", 7, 2, ("NO", "NA", "N/A", "POR", "NADA", "ESTUDIA", "ESTUDIAR"),
     "10C00751", "P10C07 Productos falta o insuficientemente descrita"),
)
OPEN_TEXT_ANSWERED = "P10C01"
OPEN_TEXT_MAX_DAYS = 4

# Cross-module check of chapter 10 against chapter 14.
CROSS_LEFT_CONDITION = (
    "PPA03 >= 18 & CP no es vacio & (P10C21 está en (5,6) o P10D07 está en (5,6) o P10C47 > 0)"
)
CROSS_RIGHT_CONDITION = "P14A04 no es vacio y P14A03A no es vacio"
CROSS_RIGHT_PERSON = "P14A04"
CROSS_CHAPTER = 14
CROSS_SECTION = "A"
CROSS_QUESTION = 3
CROSS_CODE = "ACECO14"
CROSS_DEFINITION = (
    "No está registrando los mismos CPs en actividad agrícola en el capítulo 10 y el 14. "
    "No es coincidente la información de los CPs registrados. Verifique sección C o D capítulo 10, "
    "persona ingresada como actividad económica no agrícola y no está siendo registrada en el capítulo 14 "
    "o bien, está registrando información en el capítulo 14 de una persona pero no la categorizó como "
    "actividad económica no agrícola en el capítulo 10."
)

# Batch names and group files.
BATCH_PATTERN = r"^Inconsistencias_(\d{2}-\d{2}-\d{2}-\d{2})"
BATCH_TIME_FORMAT = "dd-MM-HH-mm"
LABEL_FORMAT = "dd-MM-yyyyHH"
GROUP_FILE_PATTERN = r"GRUPO=?(\d+)"

# A unit code holds its sector from the 8th character to the third from the end.
UNIT_SECTOR_START = 8
UNIT_SECTOR_TRIM = 9

# Statement line written for one correction.
UPDATE_LINE = (
    "UPDATE %s.%s AS %s JOIN `level-1` ON %s.`level-1-id` = `level-1`.`level-1-id` "
    "SET %s.%s = %s WHERE %s; "
)
