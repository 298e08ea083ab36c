"""Schemas of the control tables and of the violations."""

from pyspark.sql import types as T

from surveyqa import fixed_values as fv

RULES = T.StructType([
    T.StructField(fv.RULE_CONDITION, T.StringType()),
    T.StructField(fv.RULE_CHAPTER, T.IntegerType()),
    T.StructField(fv.RULE_SECTION, T.StringType()),
    T.StructField(fv.RULE_QUESTION, T.IntegerType()),
    T.StructField(fv.RULE_DEFINITION, T.StringType()),
    T.StructField(fv.RULE_CODE, T.StringType()),
    T.StructField(fv.RULE_ANALYST, T.StringType()),
])

CLEANING = T.StructType([
    T.StructField(fv.CLEANING_NAME, T.StringType()),
    T.StructField(fv.CLEANING_CONDITION, T.StringType()),
    T.StructField(fv.CLEANING_VARIABLES, T.StringType()),
])

GROUPS_BY_UNIT = T.StructType([
    T.StructField("GRUPO", T.IntegerType()),
    T.StructField("UPM", T.StringType()),
    T.StructField("SUSTITUTO UPM", T.StringType()),
])

GROUPS_BY_GEOGRAPHY = T.StructType([
    T.StructField("DEPTO", T.LongType()),
    T.StructField("MUPIO", T.LongType()),
    T.StructField("SECTOR", T.LongType()),
    T.StructField("GRUPO", T.IntegerType()),
])

CORRECTIONS = T.StructType(
    [T.StructField(c.lower(), T.LongType()) for c in (*fv.CARTOGRAPHY, fv.PERSON)]
    + [
        T.StructField("variable", T.StringType()),
        T.StructField(fv.NEW_VALUE, T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)

PRODUCTIVITY = T.StructType([
    T.StructField("analista", T.StringType()),
    T.StructField("conteo", T.LongType()),
])

VIOLATIONS = T.StructType([
    T.StructField("FECHA", T.DateType()),
    T.StructField("ENCUESTADOR", T.LongType()),
    *[T.StructField(c, T.LongType()) for c in fv.CARTOGRAPHY],
    T.StructField("CP", T.LongType()),
    T.StructField("CAPITULO", T.IntegerType()),
    T.StructField("SECCION", T.StringType()),
    T.StructField("PREGUNTA", T.IntegerType()),
    T.StructField(fv.DEFINITION, T.StringType()),
    T.StructField(fv.CODE, T.StringType()),
    T.StructField("COMENTARIOS", T.StringType()),
])

REJECTED = T.StructType([
    T.StructField("codigo", T.StringType()),
    T.StructField("condicion", T.StringType()),
    T.StructField("analista", T.StringType()),
    T.StructField("error", T.StringType()),
])
