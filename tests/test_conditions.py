"""Condition texts against expected rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyqa.operators.conditions import ConditionError, compile_condition, condition_names
from surveyqa.operators.violations import WORD, Predicate, distinct_comparisons, evaluate
from surveyqa.plans.validate import check_rule

TYPES = {
    "A": T.LongType(), "B": T.StringType(), "C": T.DoubleType(), "D": T.DateType(),
    "PPA03": T.LongType(), "CP": T.IntegerType(), "P14A03A": T.StringType(),
}


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        [(0, 1, "x", 2.0, "2023-01-01"), (1, None, None, None, None), (2, 3, "", 0.0, "2023-05-05")],
        "n int, A long, B string, C double, D string",
    ).withColumn("D", F.col("D").cast("date"))


def holds(frame, condition):
    sql = compile_condition(condition, {f.name: f.dataType for f in frame.schema.fields}).sql
    return [r.n for r in frame.filter(sql).orderBy("n").collect()]


@pytest.mark.parametrize("condition, expected", [
    ("A <> 3", [0, 1]),
    ("A != 3", [0, 1]),
    ("A no está en (3,5)", [0, 1]),
    ("A NO ESTA EN (3, 5)", [0, 1]),
    ("A está en (1,3)", [0, 2]),
    ("A in [1, 3]", [0, 2]),
    ("A es vacio", [1]),
    ("A ES (VACÍO)", [1]),
    ("A = (vacio)", [1]),
    ("A no es vacio", [0, 2]),
    ("A <> (vacio)", [0, 2]),
    ("B es vacio", [1, 2]),
    ("B no es vacío", [0]),
    ('B = ""', [1, 2]),
    ("B <> ''", [0]),
    ('B <> "x"', [1, 2]),
    ("B = 'X'", []),
    ('A >= 1 | B = "x" & A = 9', [0, 2]),
    ('(A >= 1 | B = "x") & A = 9', []),
    ("A=1", [0]),
    ("A == 1", [0]),
    ("1 <= A <= 2", [0]),
    ("A = 1 y C > 1 o A = 3", [0, 2]),
    ("A = 1 Y C > 1 O A = 3", [0, 2]),
    ("~(A = 1)", [1, 2]),
    ("not (A = 1 y B = 'x')", [1, 2]),
    ("A > C", [2]),
    ("A <> C", [0, 1, 2]),
    ("A - C = -1", [0]),
    ("A + 1 > C * 2", [2]),
    ("A / C > 100", [2]),
    ("-1 < A", [0, 2]),
    ("D >= '2023-02-01'", [2]),
    ("D = '2023-01-01'", [0]),
    ("  A   =\n1 ", [0]),
    # a text column never equals a number, and always differs from it
    ("B = 1", []),
    ("B <> 1", [0, 1, 2]),
    ("B está en (1, 'x')", [0]),
    ("A no está en ('x')", [0, 1, 2]),
])
def test_condition(frame, condition, expected):
    assert holds(frame, condition) == expected


@pytest.mark.parametrize("condition", [
    "", "   ", "A", "A =", "A = 1 B = 2", "Z = 1", "A = NA", "B > 3", "A es", "(A + C) > 3",
    "A está en (C)", "D > 'ayer'", "B + 1 > 2", "no A = 1", "A = 1; DROP TABLE x",
])
def test_rejected(frame, condition):
    """Refused here, or by Spark's parser when the rule is checked against its columns."""
    with pytest.raises(ConditionError):
        compiled = compile_condition(condition, {f.name: f.dataType for f in frame.schema.fields})
        check_rule(frame, Predicate(0, compiled.sql))


def test_reference_conditions_compile():
    for condition in (
        "PPA03 es vacio",
        "P14A03A no es vacio y PPA03 no es vacio",
        "PPA03 >= 18 & CP no es vacio & (A está en (5,6) o PPA03 está en (5,6) o C > 0)",
        "A = 1 y (PPA03 = (VACIO) o CP = (VACIO) o B = (VACIO))",
        "A = 1 y (PPA03 es vacío o CP  es vacío o B  es vacío)",
        "A está en (27,29,30,31,32,33) & PPA03 = 30 & PPA03 = CP",
    ):
        assert compile_condition(condition, TYPES).comparisons >= 1


def test_quoted_text_is_kept(spark):
    frame = spark.createDataFrame([("él y ella",), ("el y ella",), ("o'b\\n",)], "B string")
    types = {"B": T.StringType()}
    assert frame.filter(compile_condition('B = "él y ella"', types).sql).count() == 1
    assert frame.filter(compile_condition('B = "o\'b\\n"', types).sql).count() == 1


def test_names_and_warnings():
    assert condition_names("PPA03 >= 18 y CP NO ES VACIO o P1 ESTÁ EN (1)") == ("PPA03", "CP", "P1")
    assert compile_condition("B = 1", TYPES).warnings
    assert not compile_condition("A = 1", TYPES).warnings


# -- one pass equals one filter per rule --------------------------------------------------------

comparison = st.one_of(
    st.builds("{} {} {}".format, st.sampled_from(["A", "C"]), st.sampled_from(["=", "<>", "<", ">="]),
              st.integers(0, 4)),
    st.builds("{} {}".format, st.sampled_from(["A", "B", "C"]), st.sampled_from(["es vacio", "no es vacio"])),
    st.builds("A {} ({}, {})".format, st.sampled_from(["está en", "no está en"]), st.integers(0, 4),
              st.integers(0, 4)),
)
condition_text = st.lists(comparison, min_size=1, max_size=4).flatmap(
    lambda parts: st.lists(st.sampled_from([" y ", " o "]), min_size=len(parts) - 1,
                           max_size=len(parts) - 1).map(
        lambda joins: parts[0] + "".join(j + p for j, p in zip(joins, parts[1:], strict=True))
    )
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(condition_text, min_size=1, max_size=80))
def test_one_pass_equals_filters(spark, conditions):
    frame = spark.createDataFrame(
        [(n, *v) for n, v in enumerate(
            (a, b, c) for a in (None, 0, 2, 4) for b in (None, "", "x") for c in (None, 0.0, 3.0)
        )] + [(0, 2, "x", 3.0)],
        "n int, A long, B string, C double",
    )
    types = {f.name: f.dataType for f in frame.schema.fields}
    predicates = []
    for n, text in enumerate(conditions):
        compiled = compile_condition(text, types)
        predicates.append(Predicate.of(n, compiled))
    found = sorted(tuple(r) for r in evaluate(frame, predicates, ["n"]).collect())
    data = frame.selectExpr("n", *[f"if({p.sql}, 1, 0) AS r{p.rule_id}" for p in predicates]).collect()
    expected = sorted((r.n, p.rule_id) for r in data for p in predicates if r[f"r{p.rule_id}"])
    assert found == expected


def test_many_words(spark):
    count = 4 * WORD + 7
    frame = spark.range(200).selectExpr("id AS A", "id % 7 AS CP")
    predicates = [Predicate(n, f"A = {n % 200}", 1, ("A",)) for n in range(count)]
    found = evaluate(frame, predicates, ["A"])
    assert found.count() == count
    assert found.filter("A <> rule_id % 200").count() == 0


def test_a_thousand_rules_share_comparisons_and_one_scan(spark, tmp_path):
    spark.range(300).selectExpr("id AS A", "nullif(id % 9, 4) AS B", "id % 7 AS CP").write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    types = {f.name: f.dataType for f in frame.schema.fields}
    texts = [f"A > {n % 50 * 6} y B = {n % 9} o ~(B <> {n % 8}) y CP = {n % 7}" for n in range(1000)]
    predicates = [Predicate.of(n, compile_condition(text, types)) for n, text in enumerate(texts)]
    assert len(distinct_comparisons(predicates)) == 50 + 9 + 8 + 7
    hits = evaluate(frame, predicates, ["A"])
    counted = {r.rule_id: r.n for r in hits.groupBy("rule_id").agg(F.count("*").alias("n")).collect()}
    whole = frame.agg(*[F.count_if(F.expr(p.sql)).alias(f"r{p.rule_id}") for p in predicates[::37]]).first()
    assert all(counted.get(n, 0) == whole[f"r{n}"] for n in range(0, 1000, 37))
    assert hits._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_no_rules(spark):
    frame = spark.range(3).selectExpr("id AS A")
    assert evaluate(frame, [], ["A"]).count() == 0


def test_exact_whole_numbers(spark):
    rows = spark.createDataFrame(
        [(9223372036854775807, 9007199254740993, 9007199254740992, -2147483648), (9223372036854775806, 5, 5, 1)],
        "A1 long, B1 long, C1 long, D1 int",
    )
    types = {f.name: f.dataType for f in rows.schema.fields}
    count = lambda text: rows.filter(compile_condition(text, types).sql).count()
    assert count("A1 = 9223372036854775807") == 1 and count("B1 - C1 = 1") == 1
    assert count("-D1 = 2147483648") == 1 and count("-D1 > 0") == 1
    assert count("A1 * B1 > 83076749736557242056487941267521536") == 1
    assert count("A1 * A1 * A1 > 0") == 2 and count("B1 / C1 = 1") == 2
    with pytest.raises(ConditionError):
        compile_condition("A1 = " + "9" * 39, types)
