"""Rule-driven validation: rules times survey tables give violations."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyqa import fixed_values as fv
from surveyqa import schemas
from surveyqa.operators.assemble import (
    Answers,
    SurveyTables,
    TableKey,
    answers,
    assemble,
    check_columns,
    control_keys,
    household_base,
    live_cases,
    locate,
    meet_households,
    providers,
)
from surveyqa.operators.checks import TextCheck, poor_answers, recently_visited, set_mismatch
from surveyqa.operators.conditions import ConditionError, compile_condition, condition_names
from surveyqa.operators.violations import (
    FLAG_COLUMNS,
    WORD,
    Predicate,
    evaluate,
    expand_flags,
    flagged_rows,
    padded_ids,
)
from surveyqa.session import staged

IDENTITY = (fv.DATE, fv.INTERVIEWER, *fv.CARTOGRAPHY, fv.PERSON)


class ValidationResult(NamedTuple):
    violations: DataFrame
    rejected: DataFrame
    warnings: DataFrame


@dataclass(frozen=True)
class RoutedRule:
    """A rule that compiled, with the tables it needs."""

    rule_id: int
    row: Row
    needed: frozenset[TableKey]
    predicate: Predicate
    warnings: tuple[str, ...]


def rule_rows(rules: DataFrame) -> list[Row]:
    """The rules' texts, read a partition at a time: the driver makes one plan of all of them."""
    return list(rules.toLocalIterator())


def route_rule(
    tables: SurveyTables, rule_id: int, row: Row, condition: str, extra: Sequence[str] = ()
) -> RoutedRule:
    """Compile one rule against the tables holding its variables, or raise ``ConditionError``.

    ``extra`` are further variables whose tables the base must have.
    """
    names = [tables.spelling(name) for name in condition_names(condition or "")]
    variables = [name for name in dict.fromkeys([*names, *extra]) if name]
    synthetic = {fv.DATE: T.DateType()} if fv.DATE in variables else {}
    needed = locate(tables, [v for v in variables if v not in synthetic])
    types: dict[str, T.DataType] = {}
    for key in sorted(needed, key=tables.rank):
        for name, data_type in tables.columns(key).items():
            types.setdefault(name, data_type)
    rounds = {r for _, r in needed} or {fv.FIRST_ROUND}
    base_round = fv.FIRST_ROUND if fv.FIRST_ROUND in rounds else fv.SECOND_ROUND
    types |= tables.columns((fv.HOUSEHOLD_TABLE, base_round)) | synthetic
    types.setdefault(fv.PERSON, T.IntegerType())
    # Start dates are text in their table and dates in the base.
    types |= {c: T.DateType() for c in fv.START_DATE.values() if c in types}
    compiled = compile_condition(condition, types)
    return RoutedRule(
        rule_id, row, needed,
        Predicate.of(rule_id, compiled), compiled.warnings,
    )


def check_rule(base: DataFrame, *predicates: Predicate) -> None:
    """Let Spark resolve the predicates; no job runs."""
    try:
        base.selectExpr(*[f"if({predicate.sql}, 1, 0)" for predicate in predicates])
    except (AnalysisException, ParseException) as error:
        raise ConditionError(str(error).splitlines()[0]) from error


def accepted_rules(
    base: DataFrame, rules: Sequence[RoutedRule], failed: list[tuple[Row, str]]
) -> list[RoutedRule]:
    """The rules Spark accepts on a base; one by one only if together they are refused."""
    try:
        check_rule(base, *[rule.predicate for rule in rules])
        return list(rules)
    except ConditionError:
        accepted = []
        for rule in rules:
            try:
                check_rule(base, rule.predicate)
                accepted.append(rule)
            except ConditionError as error:
                failed.append((rule.row, str(error)))
        return accepted


def route_all(
    tables: SurveyTables, rows: Sequence[Row], condition_of: Callable[[Row], str],
    extra_of: Callable[[Row], Sequence[str]] = lambda row: (),
) -> tuple[dict[frozenset[TableKey], list[RoutedRule]], list[tuple[Row, str]]]:
    """Rules by the tables they need, and the rules that fail with the reason."""
    by_tables: dict[frozenset[TableKey], list[RoutedRule]] = {}
    failed: list[tuple[Row, str]] = []
    for rule_id, row in enumerate(rows):
        try:
            rule = route_rule(tables, rule_id, row, condition_of(row), extra_of(row))
        except ConditionError as error:
            failed.append((row, str(error)))
            continue
        by_tables.setdefault(rule.needed, []).append(rule)
    return by_tables, failed


def home_table(tables: SurveyTables, rule: RoutedRule) -> TableKey | None:
    """The question table that all variables of a rule are read from, if there is one."""
    provider = providers(tables, rule.needed)
    homes = {provider.get(v) for v in rule.predicate.variables}
    home = homes.pop() if len(homes) == 1 else None
    others = {(fv.HOUSEHOLD_TABLE, r) for r in fv.ROUNDS} | set(control_keys(fv.ROUNDS))
    return home if home in rule.needed - others else None


class RuleHits(NamedTuple):
    """Rows that break rules, those rules, and the column of each variable that a rule exports."""

    rows: DataFrame
    rules: list[RoutedRule]
    column: dict[tuple[int, str], str]


@dataclass(frozen=True)
class Flagged:
    """Flagged answers of some rules, before they meet their households."""

    answers: Answers
    rules: list[RoutedRule]
    exported: list[str]


def flagged_answers(
    tables: SurveyTables, needed: frozenset[TableKey], home: TableKey | None, rules: list[RoutedRule],
    exported: list[str], failed: list[tuple[Row, str]],
) -> Flagged | None:
    """The rules that Spark accepts, evaluated before any household is joined; None where that can't be."""
    variables = list(dict.fromkeys(v for rule in rules for v in rule.predicate.variables))
    plain = answers(tables, needed, variables, exported)
    if plain is None:
        return None
    accepted = accepted_rules(plain.rows if home is None else tables.tables[home], rules, failed)
    predicates = [rule.predicate for rule in accepted]
    if not accepted:
        return Flagged(plain, [], exported)
    found = answers(tables, needed, variables, exported, lambda df, keep: flagged_rows(df, predicates, keep), home)
    return Flagged(found, accepted, exported)


def united_hits(parts: Sequence[Flagged], base: DataFrame, keep: Sequence[str], apart: bool = False) -> RuleHits:
    """Flagged answers of all parts in one join with their households, or each in its own, then a row per rule."""
    ids: list[int] = []
    column = {
        (rule.rule_id, v): f"_x{n}_{k}" for n, part in enumerate(parts) for k, v in enumerate(part.exported) for rule in part.rules
    }
    rows = None
    for n, part in enumerate(parts):
        first = len(ids) // WORD
        own = part.answers.rows.selectExpr(
            f"`{fv.HOUSEHOLD_KEY}`", f"`{fv.PERSON}`", f"_word + {first} AS _word", "_flags",
            f"{str(part.answers.by_household).lower()} AS _by_household",
            *[f"`{v}` AS _x{n}_{k}" for k, v in enumerate(part.exported)],
        )
        ids += padded_ids([rule.predicate for rule in part.rules])
        own = meet_households(own, base, "_by_household") if apart else own
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    met = rows if apart else meet_households(rows, base, "_by_household")
    kept = [*keep, *[f"_x{n}_{k}" for n, part in enumerate(parts) for k in range(len(part.exported))]]
    flagged = met.select(*[F.col(f"`{c}`") for c in (*kept, *FLAG_COLUMNS)])
    return RuleHits(expand_flags(flagged, ids, kept), [rule for part in parts for rule in part.rules], column)


def rule_hits(
    tables: SurveyTables, by_tables: dict[frozenset[TableKey], list[RoutedRule]],
    keep: Sequence[str], start: str | None, end: str | None, failed: list[tuple[Row, str]],
    exports: Callable[[RoutedRule], Sequence[str]] = lambda rule: (), work_dir: str | None = None,
) -> Iterator[RuleHits]:
    """Hits with ``keep``, the exports and ``rule_id``.

    Rules on answers are evaluated on their tables, and only rows that break a rule are shuffled to meet
    their household: flagged rows of all tables of a round are united and joined once to one household base.
    Rules that read the household's own columns are evaluated on the joined base, which is written to
    ``work_dir`` once where that is given.
    """
    by_round: dict[tuple, list[Flagged]] = {}
    for needed, rules in by_tables.items():
        try:
            check_columns(tables, needed)
        except ConditionError as error:
            failed += [(rule.row, str(error)) for rule in rules]
            continue
        homes: dict[TableKey | None, list[RoutedRule]] = {}
        for rule in rules:
            homes.setdefault(home_table(tables, rule), []).append(rule)
        for home, group in homes.items():
            extra = list(dict.fromkeys(v for rule in group for v in exports(rule) if v not in keep))
            part = flagged_answers(tables, needed, home, group, extra, failed)
            if part is not None:
                if part.rules:
                    person = part.answers.rows.schema[fv.PERSON].dataType.simpleString()
                    by_round.setdefault((part.answers.rounds, person), []).append(part)
                continue
            variables = dict.fromkeys(v for rule in group for v in rule.predicate.variables)
            base = assemble(tables, needed, [*variables, *extra], start, end)
            accepted = accepted_rules(base, group, failed)
            if not accepted:
                continue
            if work_dir is not None:
                name = "-".join(sorted(f"{table}_{r}" for table, r in needed)) or "level"
                base = staged(base, f"{work_dir}/{name}")
            rows = evaluate(base, [rule.predicate for rule in accepted], [*keep, *extra])
            yield RuleHits(rows, accepted, {(rule.rule_id, v): v for rule in accepted for v in extra})
    bases: dict[tuple[str, ...], DataFrame] = {}
    for (rounds, _), parts in by_round.items():
        if rounds not in bases:
            bases[rounds] = household_base(tables, rounds, start, end)
        yield united_hits(parts, bases[rounds], keep, tables.co_located)


def _rule_details(spark: SparkSession, rules: Sequence[RoutedRule]) -> DataFrame:
    """What a violation says about its rule."""
    rows = [
        (
            r.rule_id, r.row[fv.RULE_CHAPTER], r.row[fv.RULE_SECTION], r.row[fv.RULE_QUESTION],
            r.row[fv.RULE_DEFINITION], r.row[fv.RULE_CODE],
        )
        for r in rules
    ]
    return spark.createDataFrame(
        rows,
        "rule_id int, CAPITULO int, SECCION string, PREGUNTA int, "
        f"`{fv.DEFINITION}` string, `{fv.CODE}` string",
    )


def with_rule_details(hits: DataFrame, rules: Sequence[RoutedRule]) -> DataFrame:
    """Hits (identity columns and ``rule_id``) as violations, columns in report order."""
    details = _rule_details(hits.sparkSession, rules)  # Spark broadcasts it if its size allows
    return as_violations(hits.join(details, "rule_id"))


def whole_numbers(df: DataFrame) -> DataFrame:
    """Columns of violations with the types of the report; a place or interviewer code that is text stays text."""
    types = {f.name: f.dataType.simpleString() for f in schemas.VIOLATIONS}

    def column(f: T.StructField) -> str:
        kept = isinstance(f.dataType, T.StringType) or f.name not in types
        return f"`{f.name}`" if kept else f"CAST(`{f.name}` AS {types[f.name]}) AS `{f.name}`"

    return df.selectExpr(*[column(f) for f in df.schema.fields])


def as_violations(df: DataFrame) -> DataFrame:
    """Columns in report order and with its types; the comment is left for the analyst."""
    return whole_numbers(df.withColumn("COMENTARIOS", F.lit(None).cast("string"))).selectExpr(
        *[f"`{f.name}`" for f in schemas.VIOLATIONS]
    )


def validate(
    tables: SurveyTables, rules: DataFrame, start: str | None = None, end: str | None = None,
    work_dir: str | None = None,
) -> ValidationResult:
    """All rules over the interviews begun between two dates, both included.

    A rule that cannot be read, names unknown or ambiguous variables, or does not fit the column
    types is set aside in ``rejected`` with its analyst; the others run. Rules that need the same
    tables are evaluated together. Nothing is computed here, except a base staged in ``work_dir``.
    """
    spark = rules.sparkSession
    rows = rule_rows(rules)
    by_tables, failed = route_all(tables, rows, lambda row: row[fv.RULE_CONDITION])
    hits, accepted = None, []
    for found in rule_hits(tables, by_tables, IDENTITY, start, end, failed, work_dir=work_dir):
        part = whole_numbers(found.rows)
        hits = part if hits is None else hits.unionByName(part)
        accepted += found.rules
    warnings = [(r.row[fv.RULE_CODE], w) for r in accepted for w in r.warnings]
    violations = None if hits is None else with_rule_details(hits, accepted)
    if violations is None:
        violations = spark.createDataFrame([], schemas.VIOLATIONS)
    rejected = spark.createDataFrame(
        [(r[fv.RULE_CODE], r[fv.RULE_CONDITION], r[fv.RULE_ANALYST], e) for r, e in failed],
        schemas.REJECTED,
    )
    return ValidationResult(
        violations, rejected, spark.createDataFrame(warnings, "codigo string, aviso string")
    )


def filter_rule(
    tables: SurveyTables, condition: str, columns: Sequence[str], start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """The rows one condition holds for, with chosen columns; its filters reach the scans."""
    extra = [c for c in columns if c not in (*IDENTITY, fv.HOUSEHOLD_KEY)]
    rule = route_rule(tables, 0, Row(), condition, extra)
    base = assemble(tables, rule.needed, [*rule.predicate.variables, *extra], start, end)
    check_rule(base, rule.predicate)
    return base.filter(rule.predicate.sql).selectExpr(*[f"`{c}`" for c in columns])


def condition_answers(tables: SurveyTables, condition: str, person: str) -> Answers | None:
    """Household and ``person`` of the answers a condition holds for, before any household is joined."""
    rule = route_rule(tables, 0, Row(), condition, [] if person == fv.PERSON else [person])

    def holding(df: DataFrame, keep: list[str]) -> DataFrame:
        check_rule(df, rule.predicate)
        return df.filter(rule.predicate.sql).selectExpr(f"`{fv.HOUSEHOLD_KEY}`", f"`{person}`")

    return answers(tables, rule.needed, rule.predicate.variables, [person], holding)


def cross_module_check(
    tables: SurveyTables, start: str | None = None, end: str | None = None,
    left_condition: str = fv.CROSS_LEFT_CONDITION, right_condition: str = fv.CROSS_RIGHT_CONDITION,
    right_person: str = fv.CROSS_RIGHT_PERSON,
) -> DataFrame:
    """Persons that one chapter takes for farm workers and the other does not, one row each.

    The chapters' persons are compared first; what differs meets its household in one join. Where a
    condition reads the household's own columns, both sides are assembled instead.
    """
    carry = [c for c in IDENTITY if c != fv.PERSON]
    sides = [condition_answers(tables, left_condition, fv.PERSON), condition_answers(tables, right_condition, right_person)]
    if all(sides) and len({side.rounds for side in sides}) == 1:
        base = household_base(tables, sides[0].rounds, start, end)
        differing = set_mismatch(sides[0].rows, sides[1].rows, fv.HOUSEHOLD_KEY, fv.PERSON, right_person, [])
        by_household = any(side.by_household for side in sides)
        persons = meet_households(differing.withColumn("_by_household", F.lit(by_household)), base, "_by_household")
    else:
        left = filter_rule(tables, left_condition, [fv.HOUSEHOLD_KEY, fv.PERSON, *carry], start, end)
        right = filter_rule(tables, right_condition, [fv.HOUSEHOLD_KEY, right_person], start, end)
        persons = set_mismatch(left, right, fv.HOUSEHOLD_KEY, fv.PERSON, right_person, carry)
    labelled = persons.withColumnRenamed("member", fv.PERSON).withColumns({
        "CAPITULO": F.lit(fv.CROSS_CHAPTER), "SECCION": F.lit(fv.CROSS_SECTION),
        "PREGUNTA": F.lit(fv.CROSS_QUESTION), fv.DEFINITION: F.lit(fv.CROSS_DEFINITION),
        fv.CODE: F.lit(fv.CROSS_CODE),
    })
    return as_violations(labelled)


OPEN_TEXT = tuple(
    TextCheck(column, question, size, words, code, label)
    for column, question, size, words, code, label in fv.OPEN_TEXT_CHECKS
)


def open_text_check(
    tables: SurveyTables, as_of: str | None = None, checks: Sequence[TextCheck] = OPEN_TEXT,
    max_days: int = fv.OPEN_TEXT_MAX_DAYS, text_max: bool = False, persons: str = "personas",
) -> DataFrame:
    """Missing or poor open answers of finished first-round interviews visited lately.

    ``as_of`` is the reference day, today when not given. Answers are tested before households
    join, so only the few poor ones travel.
    """
    r = fv.FIRST_ROUND
    day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    person_table = tables.tables[(persons, r)]
    answers = [c.column for c in checks]
    people = person_table.filter(F.col(fv.OPEN_TEXT_ANSWERED) >= 1).select(
        F.col(f"`{fv.HOUSEHOLD_KEY}`"), fv.PERSON, *answers
    )
    poor = poor_answers(
        people, checks, (fv.HOUSEHOLD_KEY, fv.PERSON), fv.OPEN_TEXT_CHAPTER, fv.OPEN_TEXT_SECTION
    )
    level = tables.tables[(fv.HOUSEHOLD_TABLE, r)]
    cover = tables.tables[(fv.STATE_TABLE[r], r)].filter(F.col(fv.STATE[r]) == 1)
    cover_columns = [fv.INTERVIEWER] if fv.INTERVIEWER not in level.columns else []
    level_columns = [fv.INTERVIEWER] if not cover_columns else []
    places = level.select(*[
        F.col(f"`{c}`") for c in (fv.HOUSEHOLD_KEY, fv.CASE_KEY, *fv.CARTOGRAPHY, *level_columns)
    ])
    recent = recently_visited(
        tables.tables[(fv.VISITS_TABLE, r)], fv.HOUSEHOLD_KEY, fv.VISIT_DATE, day, max_days, text_max
    )
    households = live_cases(
        places.join(cover.select(F.col(f"`{fv.HOUSEHOLD_KEY}`"), *cover_columns), fv.HOUSEHOLD_KEY)
        .join(recent, fv.HOUSEHOLD_KEY, "left_semi"),
        tables.tables[(fv.CASES_TABLE, r)],
    )
    columns = [c for c in fv.VIOLATION_COLUMNS if c != fv.DATE] + ["VALOR"]
    return poor.join(households, fv.HOUSEHOLD_KEY).select(
        *[F.col(f"`{c}`") for c in columns]
    ).distinct()
