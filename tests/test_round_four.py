"""Sheets of thousands of rules, and what corrections leave on disk."""

import pytest
from survey_helpers import rows

from surveyqa.operators import violations
from surveyqa.operators.conditions import compile_condition
from surveyqa.operators.violations import Predicate, evaluate


def sheet_of(frame, count):
    """Rules of one shape, and a few of shapes that no other rule has."""
    types = {f.name: f.dataType for f in frame.schema.fields}
    texts = [f"A > {k % 40} y B = {k % 7} o ~(T <> 'x') y B = {k % 5}" for k in range(count)]
    texts += [" o ".join(f"A = {k + i}" for i in range(k + 1)) for k in range(20)] + ["A es vacio", "~(B = 3)"]
    return [Predicate.of(10 * k + 1, compile_condition(t, types)) for k, t in enumerate(texts)]


@pytest.mark.parametrize("real", [False, True])
def test_many_rules_are_tested_once_for_rows_alike(spark, monkeypatch, real):
    """Each of 1,102 equal rows counts; rows kept with a double are not grouped."""
    data = [(k, None if k % 11 == 0 else k % 45, k % 8, (None, "", "x", "y")[k % 4]) for k in range(100)] * 2 + [(7, 44, 2, "z")] * (2 if real else 1102) + [(None, None, None, None)] * 2
    frame = spark.createDataFrame(data, "n int, A int, B int, T string").selectExpr("*", "n * 0.5D AS real")
    predicates = sheet_of(frame, 500)
    keep = ["T", "real"] if real else ["T"]
    found = evaluate(frame, predicates, keep)
    monkeypatch.setattr(violations, "MANY", 10_000)
    plain = evaluate(frame, predicates, keep)
    assert found.schema == plain.schema and rows(found) == rows(plain) and found.count() > 1_000


def test_the_plan_does_not_grow_with_rules_alike(spark):
    frame = spark.createDataFrame([(1, 2, 3, "x")], "n int, A int, B int, T string")
    steps = [
        evaluate(frame, sheet_of(frame, count), ["n"])._jdf.queryExecution().analyzed().toString().count("Generate ") for count in (500, 1500)
    ]
    assert steps[0] == steps[1]  # one more for every 40 rules before


def test_corrections_are_not_dealt_by_the_columns_they_name(spark, tables):
    """A catalog of a few columns goes to the corrections, not the corrections to a task per column."""
    from surveyqa.operators.corrections import clean_corrections
    from surveyqa.plans.cleaning import with_rounds

    sheet = spark.range(50).selectExpr("id AS seq", "if(id % 2 = 0, 'personas.ppa03', 'vivienda.p01h10') AS variable", "'1' AS `valor nuevo`", "1 AS cp")
    plan = with_rounds(clean_corrections(sheet), tables.catalog(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
