"""Rules on Structured Streaming: the batch operators over a streaming person table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from surveyqa import fixed_values as fv
from surveyqa.operators.conditions import ConditionError, compile_condition
from surveyqa.operators.violations import Predicate, evaluate
from surveyqa.plans.validate import RoutedRule, check_rule, rule_rows, with_rule_details


def validate_stream(answers: DataFrame, rules: DataFrame) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Violations of rules over already joined answers, and the rules set aside.

    ``answers`` may be streaming; it holds the identity columns and the variables. Rules keep no
    state, so every answer is checked as it arrives.
    """
    types = {f.name: f.dataType for f in answers.schema.fields}
    accepted, failed = [], []
    for rule_id, row in enumerate(rule_rows(rules)):
        try:
            compiled = compile_condition(row[fv.RULE_CONDITION], types)
            predicate = Predicate.of(rule_id, compiled)
            check_rule(answers, predicate)
        except ConditionError as error:
            failed.append((row[fv.RULE_CODE], str(error)))
            continue
        accepted.append(RoutedRule(rule_id, row, frozenset(), predicate, compiled.warnings))
    identity = [fv.DATE, fv.INTERVIEWER, *fv.CARTOGRAPHY, fv.PERSON]
    hits = evaluate(answers, [rule.predicate for rule in accepted], identity)
    return with_rule_details(hits, accepted), failed


def resent_once(
    answers: DataFrame, keys: Sequence[str], event_time: str, delay: str
) -> DataFrame:
    """The first copy of a questionnaire sent again within ``delay``; state is dropped after it."""
    return answers.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
