"""Column functions, comparisons, groups, reports and rule sheets on small frames."""

import unicodedata

from survey_helpers import rows, rule, rule_sheet
from pyspark.sql import functions as F

from surveyqa import functions as fn
from surveyqa import schemas
from surveyqa.operators import compare, groups, reports, triage


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


def test_strip_accents(spark):
    text = "Está vacío: ÁÉÍÓÚ ñÑ çÇ àèìòù âêô äëïöü ǆ ĳ ﬁ œ ø ½ ñ é ŉ"
    expected = "".join(
        c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)
    )
    assert one(spark, fn.strip_accents, text) == expected
    assert one(spark, fn.strip_accents, "plain") == "plain" and one(spark, fn.strip_accents, None) is None


def test_every_character_is_decomposed(spark):
    """Equal to the standard library's tables for every code point, alone and inside a text."""
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF and (c < 0x30000 or c % 997 == 0)]
    chars = list(map(chr, codes))
    frame = spark.createDataFrame(list(zip(codes, chars)), "n int, c string").repartition(4)
    found = dict(map(tuple, frame.select("n", fn.strip_accents(F.col("c"))).collect()))
    plain = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    assert [hex(k) for k, c in zip(codes, chars) if found[k] != plain(c)] == []
    texts = ["".join(chars[k : k + 700]) for k in range(0x80, 0x2FB00, 700)] + [None, ""]
    rows_of = spark.createDataFrame(list(enumerate(texts)), "n int, c string")
    assert all(r[1] == (None if r[0] is None else plain(r[0])) for r in rows_of.select("c", fn.strip_accents(F.col("c"))).collect())


def test_collapse_whitespace(spark):
    text = " \t a  b\r\n c\x1f "
    assert one(spark, fn.collapse_whitespace, text) == " ".join(text.split())


def test_names_in_conditions(spark):
    text = "P01H09 = 1 y (P01H10 ES (VACIO) o CP NO ESTÁ EN (1)) y P01H09 > Xy"
    assert one(spark, fn.condition_variables, text) == ["P01H09", "P01H10", "CP", "EN", "P01H09", "Xy"]
    assert one(spark, fn.leading_variable, "  P01H09 >= 3") == "P01H09"
    assert one(spark, fn.leading_variable, "3 > 2") == ""


def test_file_names(spark):
    assert one(spark, fn.group_number, "InconsistenciasGRUPO12_3-4.xlsx") == 12
    assert one(spark, fn.group_number, "Inconsistencias.xlsx") is None
    assert str(one(spark, fn.batch_time, "Inconsistencias_05-11-13-45")).endswith("11-05 13:45:00")
    assert one(spark, fn.batch_time, "Otra_05-11-13-45") is None


def test_survey_dates(spark):
    for text, expected in (
        ("23/09/23", "2023-09-23"), ("3/9/23", "2023-09-03"), ("01/01/75", "1975-01-01"),
        ("29/02/68", "2068-02-29"), ("31/02/23", None), ("", None), ("2023-09-23", None), (None, None),
    ):
        found = one(spark, fn.parse_survey_date, text)
        assert (None if found is None else str(found)) == expected, text


def test_short_answers(spark):
    def poor(c):
        return fn.too_short_or_stopword(c, 3, ("NO", "NADA"))

    for text, expected in (
        (None, True), ("", True), ("abc", True), ("abcd", False), ("ñu", True), ("ñuñ", False),
        ("nada", True), ("Nadas", False), ("no ", True),
    ):
        assert one(spark, poor, text) is expected, text


def test_split_list(spark):
    assert one(spark, fn.split_list, " P1 ,P2,, P3 ,") == ["P1", "P2", "P3"]
    assert one(spark, fn.split_list, "") == []


def test_columns(spark):
    frame = spark.createDataFrame([(1, 2, 3, 4)], "a_x int, A_y int, ESTADO_PR int, INDEX int")
    assert fn.upper_columns(frame).columns == ["A_X", "A_Y", "ESTADO_PR", "INDEX"]
    assert fn.drop_index(frame).columns == ["a_x", "A_y", "ESTADO_PR"]
    assert fn.strip_round_suffix(frame).columns == ["a", "ESTADO", "INDEX"]
    both = spark.createDataFrame([(1, 2)], "V_PR int, V_SR int")
    assert fn.strip_round_suffix(both).columns == ["V", "V_SR"] or fn.strip_round_suffix(both).count() == 1
    assert rows(fn.with_default(frame, "CP", 0), "CP") == [(0,)]
    assert rows(fn.with_default(frame, "INDEX", 0), "INDEX") == [(4,)]


def test_fill_cast_int(spark):
    frame = spark.createDataFrame(
        [(1, 1.0, 0.5, "a"), (2, None, None, None), (3, float("nan"), 2.0, "")],
        "n int, whole double, part double, t string",
    )
    filled = fn.fill_cast_int(frame)
    assert dict(filled.dtypes) == {"n": "int", "whole": "bigint", "part": "double", "t": "string"}
    assert rows(filled, "n", "whole", "part") == [(1, 1, 0.5), (2, -1, -1.0), (3, -1, 2.0)]
    assert rows(fn.nan_to_null(frame), "n", "whole")[2] == (3, None)
    assert dict(fn.fill_cast_int(frame, integral=[]).dtypes)["whole"] == "double"


def test_compare(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    same = spark.createDataFrame([(2, None), (1, "x"), (1, "x")], "a int, b string")
    fewer = spark.createDataFrame([(2, None), (1, "x")], "a int, b string")
    report = compare.equality_report(a, {"same": same, "fewer": fewer, "other": a.select("a")})
    assert rows(report) == [("fewer", False, 1), ("other", False, None), ("same", True, 0)]
    assert rows(compare.frame_difference(a, fewer)) == [(1, "x", 2, 1)]
    assert compare.equals_any(a, {"fewer": fewer, "same": same})
    assert not compare.equals_any(a, {"fewer": fewer}) and not compare.equals_any(a, {})
    assert rows(compare.table_profile({"a": a, "none": a.limit(0)})) == [("a", 3, 2), ("none", 0, 2)]
    joined = compare.outer_join([a.select("a"), spark.createDataFrame([(2, 5), (9, 6)], "a int, c int")], "a")
    assert rows(joined) == [(1, None), (1, None), (2, 5), (9, 6)]


def test_groups(spark):
    units = spark.createDataFrame(
        [(1, "1234567101XX", None), (1, "1234567102XX", "1234567103XX"), (2, "1234567103XX", None),
         (None, "1234567104XX", None), (2, "bad", None)], schemas.GROUPS_BY_UNIT,
    )
    group_map = groups.group_sector_map(units)
    assert rows(group_map) == [(1, 101), (1, 103), (2, 103), (2, None)]
    violations = spark.createDataFrame([(101, "a"), (103, "b"), (999, "c"), (None, "d")], "SECTOR long, code string")
    placed = groups.assign_groups(violations, group_map, ["SECTOR"])
    assert rows(placed) == [(101, "a", 1), (103, "b", 1), (103, "b", 2)]
    assert rows(groups.deliverable_groups(placed)) == [(1, 2)]
    left = groups.assign_groups(violations, group_map, ["SECTOR"], "left")
    assert rows(left) == [(101, "a", 1), (103, "b", 1), (103, "b", 2), (999, "c", None), (None, "d", 2)]
    assert rows(reports.violations_rollup(left)) == [(1, 0, 2), (2, 0, 2), (None, 0, 1), (None, 1, 5)]


def test_reports(spark):
    left = spark.createDataFrame([(1, "a", 5), (None, "b", 6)], "GRUPO int, `CODIGO ERROR` string, DEPTO int")
    right = spark.createDataFrame([("c", 1, 7), ("d", 3, 8)], "`CODIGO ERROR` string, GRUPO int, DEPTO int")
    assert reports.merge_reports(left, right).count() == 4
    kept = reports.merge_reports(left, right, left_groups_only=True)
    assert rows(kept, "CODIGO ERROR") == [("a",), ("b",), ("c",)]
    assert reports.merge_reports(left.limit(0), right, left_groups_only=True).count() == 2
    frame = spark.createDataFrame([(2, "a", 1), (1, "b", 1), (1, "a", 2)], "DEPTO int, `CODIGO ERROR` string, n int")
    assert [tuple(r) for r in reports.report_order(frame).collect()] == [(1, "a", 2), (1, "b", 1), (2, "a", 1)]
    counted = spark.createDataFrame([("a",), ("a",), (None,)], "ENCUESTADOR string")
    assert rows(reports.frequency_by_interviewer(counted)) == [("a", 2)]
    batches = spark.createDataFrame(
        [("Inconsistencias_05-11-13-45",), ("Inconsistencias_30-01-23-59",), ("otra",)], "n string")
    assert reports.latest_batch(batches, "n").first()["n"] == "Inconsistencias_05-11-13-45"


def test_rule_sheet(spark):
    sheet = rule_sheet(
        spark, rule("PPA03 = 1 y EN > 2", "C1"), rule("P9 = 1", "C2", "Luis", 2, "B"), rule("P9 = 2", None)
    )
    catalog = spark.createDataFrame(
        [("PPA03", "personas", "PR", "int"), ("P9", "casa", "PR", "int"), ("P9", "casa", "SR", "int")],
        "variable string, table string, round string, dtype string",
    )
    assert rows(triage.route(sheet, catalog, "Código de Error")) == [
        ("C1", "personas", "PR"), ("C2", "casa", "PR"), ("C2", "casa", "SR"), (None, "casa", "PR"),
        (None, "casa", "SR"),
    ]
    assert triage.select_rules(sheet, "Luis", 2, "B").count() == 1
    assert rows(triage.sections(sheet)) == [(1, "A"), (2, "B")]
    codes = spark.createDataFrame([("C1",), ("C1",), ("C7",)], "`Código de Error` string")
    approved = triage.approved(sheet, codes)
    assert approved.count() == 1 and approved.columns == sheet.columns
    emitted = spark.createDataFrame([("C1",), ("C8",), ("C8",), (None,)], "c string")
    reviewed = spark.createDataFrame([("C1",), (None,)], "c string")
    assert rows(triage.unreviewed(emitted, reviewed, "c")) == [("C8",), ("C8",)]
