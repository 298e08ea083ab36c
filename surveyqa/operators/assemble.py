"""Which tables a rule needs, and the joined base it is evaluated on."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyqa import fixed_values as fv
from surveyqa.functions.dates import parse_survey_date
from surveyqa.operators.conditions import ConditionError

TableKey = tuple[str, str]

#: Column of a bucketed snapshot's household tables: what their case says of its deletion.
CASE_MARK = "_CASE_DELETED"


@dataclass(frozen=True)
class SurveyTables:
    """The survey tables by (name, round), all column names in upper case.

    ``precedence`` names tables, first choice first, for variables that several tables hold.
    ``co_located`` tables lie in the same buckets by household: each joins without a shuffle, so that
    uniting their rows before the join would only cost one.
    """

    tables: Mapping[TableKey, DataFrame]
    precedence: Sequence[str] = ()
    co_located: bool = False
    _columns: dict[TableKey, dict[str, T.DataType]] = field(default_factory=dict, repr=False)
    _spellings: dict[str, str] = field(default_factory=dict, repr=False)

    def columns(self, key: TableKey) -> dict[str, T.DataType]:
        if key not in self._columns:
            if key not in self.tables:
                raise ConditionError(f"no table {key[0]} in round {key[1]}")
            self._columns[key] = {f.name: f.dataType for f in self.tables[key].schema.fields}
        return self._columns[key]

    def spelling(self, name: str) -> str | None:
        """A variable's name as the tables write it; conditions may use any case."""
        if not self._spellings:
            for key in self.tables:
                self._spellings.update({c.upper(): c for c in self.columns(key)})
            self._spellings[fv.DATE] = fv.DATE
        return self._spellings.get(name.upper())

    def rank(self, key: TableKey) -> tuple[int, str, str]:
        name, survey_round = key
        order = self.precedence.index(name) if name in self.precedence else len(self.precedence)
        return order, survey_round, name

    def holders(self, variable: str) -> list[TableKey]:
        """Question tables holding a variable, in order of precedence."""
        found = [
            key for key in self.tables
            if key[0] != fv.CASES_TABLE and variable in self.columns(key)
        ]
        return sorted(found, key=self.rank)

    def catalog(self, spark: SparkSession) -> DataFrame:
        """One row per variable and table: ``variable, table, round, dtype``."""
        rows = [
            (name, key[0], key[1], data_type.simpleString())
            for key in self.tables
            for name, data_type in self.columns(key).items()
            if name not in fv.NOT_VARIABLES
        ]
        return spark.createDataFrame(rows, "variable string, table string, round string, dtype string")


def locate(tables: SurveyTables, variables: Iterable[str]) -> frozenset[TableKey]:
    """The tables to join for a set of variables.

    A variable held by one table fixes that table. One held by several is read from a table already
    needed, else from the first by precedence; without a precedence it is rejected as ambiguous.
    """
    needed: set[TableKey] = set()
    open_choices: list[tuple[str, list[TableKey]]] = []
    for variable in variables:
        holders = tables.holders(variable)
        if not holders:
            raise ConditionError(f"unknown variable {variable}")
        if len(holders) == 1:
            needed.add(holders[0])
        else:
            open_choices.append((variable, holders))
    for variable, holders in open_choices:
        if needed.intersection(holders):
            continue
        if any(name == fv.HOUSEHOLD_TABLE for name, _ in holders):
            rounds = {survey_round for _, survey_round in needed} or {fv.FIRST_ROUND}
            if any((fv.HOUSEHOLD_TABLE, r) in holders for r in rounds):
                continue
        named = [key for key in holders if key[0] in tables.precedence]
        one_name = len({name for name, _ in holders}) == 1
        if not named and not one_name:
            raise ConditionError(f"ambiguous variable {variable}: {holders}")
        choices = named or holders
        rounds = {survey_round for _, survey_round in needed}
        needed.add(next((key for key in choices if key[1] in rounds), choices[0]))
    return frozenset(needed)


def finished_filter(columns: Iterable[str]) -> Column | None:
    """The test for a finished interview, chosen by the columns the base has."""
    present = set(columns)
    person, first, second = (
        c in present for c in (fv.PERSON_STATUS, fv.STATE["PR"], fv.STATE["SR"])
    )
    if person and first and second:
        return (F.col(fv.PERSON_STATUS) == 1) & (F.col(fv.STATE["SR"]) == 1)
    if person and first:
        return F.col(fv.PERSON_STATUS) == 1
    if second:
        return F.col(fv.STATE["SR"]) == 1
    if first:
        return F.col(fv.STATE["PR"]) == 1
    return None


def within(day: Column, start: str | None, end: str | None) -> Column:
    """Both ends belong to the window, either may be open; an unreadable date is outside it."""
    inside = day.isNotNull()
    if start is not None:
        inside &= day >= F.lit(start).cast("date")
    if end is not None:
        inside &= day <= F.lit(end).cast("date")
    return inside


def live_cases(households: DataFrame, cases: DataFrame) -> DataFrame:
    """Households whose case is not deleted."""
    live = cases.filter(f"{fv.DELETED} = 0").selectExpr(f"{fv.CASE_TABLE_KEY} AS `{fv.CASE_KEY}`")
    return households.join(live, fv.CASE_KEY)


def needed_rounds(needed: Iterable[TableKey]) -> list[str]:
    return sorted({survey_round for _, survey_round in needed} or {fv.FIRST_ROUND})


def control_keys(rounds: Iterable[str]) -> list[TableKey]:
    return [(names[r], r) for r in rounds for names in (fv.TIME_TABLE, fv.STATE_TABLE)]


def join_order(tables: SurveyTables, needed: Iterable[TableKey]) -> list[TableKey]:
    """The tables of a base; of two that hold the same column the earlier one provides it."""
    rounds = needed_rounds(needed)
    control = control_keys(rounds)
    levels = {(fv.HOUSEHOLD_TABLE, r) for r in fv.ROUNDS}
    questions = sorted(set(needed) - set(control) - levels, key=tables.rank)
    return [(fv.HOUSEHOLD_TABLE, rounds[0]), *questions, *control]


def providers(tables: SurveyTables, needed: Iterable[TableKey]) -> dict[str, TableKey]:
    """Which table of the base each column is read from."""
    found: dict[str, TableKey] = {}
    for key in join_order(tables, needed):
        for column in tables.columns(key):
            found.setdefault(column, key)
    return found


def check_columns(
    tables: SurveyTables, needed: Iterable[TableKey], variables: Iterable[str] = ()
) -> dict[str, TableKey]:
    """The providers of a base's columns, or ``ConditionError`` when a table or column is missing."""
    provider = providers(tables, needed)
    wanted = dict.fromkeys([*fv.CARTOGRAPHY, fv.INTERVIEWER, *variables])
    missing = [c for c in wanted if c not in provider and c not in (fv.PERSON, fv.DATE)]
    if missing:
        raise ConditionError(f"no needed table holds {', '.join(missing)}")
    return provider


def control_part(tables: SurveyTables, key: TableKey, columns: Sequence[str], start: str | None, end: str | None) -> DataFrame:
    """A control table's household key and columns, its start date read and inside the window."""
    date = fv.START_DATE[key[1]]
    df = tables.tables[key].selectExpr(*[f"`{c}`" for c in dict.fromkeys([fv.HOUSEHOLD_KEY, *columns])])
    if date not in columns:
        return df
    df = df.withColumn(date, parse_survey_date(F.col(date)))
    return df if start is None and end is None else df.filter(within(F.col(date), start, end))


def live_households(tables: SurveyTables, level: DataFrame, survey_round: str) -> DataFrame:
    """Households whose case is not deleted, by the cases or by the mark a bucketed snapshot puts on them."""
    if CASE_MARK in tables.columns((fv.HOUSEHOLD_TABLE, survey_round)):
        return level.filter(f"{CASE_MARK} = 0").drop(CASE_MARK)
    return live_cases(level, tables.tables[(fv.CASES_TABLE, survey_round)])


def household_columns(tables: SurveyTables, rounds: Sequence[str]) -> dict[str, TableKey]:
    """Which of the tables with one row per household each column is read from."""
    found: dict[str, TableKey] = {}
    for key in [(fv.HOUSEHOLD_TABLE, rounds[0]), *control_keys(rounds)]:
        for column in tables.columns(key):
            found.setdefault(column, key)
    return found


#: In a household base: whether the questionnaire's own status says that it is finished.
FINISHED = "_finished"


def household_base(tables: SurveyTables, rounds: Sequence[str], start: str | None = None, end: str | None = None) -> DataFrame:
    """Live households begun in the window: key, FECHA, interviewer, cartographic key and ``FINISHED``.

    Everything that is checked about an interview's household is here, so that answers of all tables meet
    their households in one join, whatever the number of rules.
    """
    provider = household_columns(tables, rounds)
    base_key, control = (fv.HOUSEHOLD_TABLE, rounds[0]), control_keys(rounds)
    state = fv.STATE[rounds[-1]]
    dates = [fv.START_DATE[r] for r in rounds]
    wanted = [fv.INTERVIEWER, *fv.CARTOGRAPHY, *dates, state]
    own = {key: [c for c in wanted if provider[c] == key] for key in (base_key, *control)}
    marks = [CASE_MARK] if CASE_MARK in tables.columns(base_key) else [fv.CASE_KEY]
    level = tables.tables[base_key].selectExpr(*[f"`{c}`" for c in dict.fromkeys([fv.HOUSEHOLD_KEY, *marks, *own[base_key]])])
    for key in control:
        level = level.join(control_part(tables, key, own[key], start, end), fv.HOUSEHOLD_KEY)
    return live_households(tables, level, rounds[0]).selectExpr(
        f"`{fv.HOUSEHOLD_KEY}`", f"{dates[-1]} AS {fv.DATE}", fv.INTERVIEWER, *fv.CARTOGRAPHY,
        f"coalesce({state} = 1, false) AS {FINISHED}",
    )


@dataclass(frozen=True)
class Answers:
    """Answers before any household is joined: ``rows`` are finished as far as a person's own status decides.

    With ``by_household`` the household's status decides.
    """

    rows: DataFrame
    rounds: tuple[str, ...]
    by_household: bool


#: What becomes of answers before they are joined to anything: a function of them and the columns to keep.
Reduce = Callable[[DataFrame, list[str]], DataFrame]


def answers(
    tables: SurveyTables, needed: Iterable[TableKey], variables: Iterable[str], exported: Iterable[str] = (),
    reduced: Reduce | None = None, home: TableKey | None = None,
) -> Answers | None:
    """The question tables of a base, joined: household key, CP, the exported variables and what ``reduced`` adds.

    ``reduced`` reads ``variables``. It is applied to the table ``home`` before others join it, or to all of
    them joined where there is no such table. None where a variable or part of the identity is read from a
    table that the household base is made of, or the other way round; then ``assemble`` is needed.
    """
    needed = set(needed)
    rounds = needed_rounds(needed)
    questions = [k for k in join_order(tables, needed)[1:] if k not in control_keys(rounds)]
    provider, households = providers(tables, needed), household_columns(tables, rounds)
    given = (fv.PERSON, fv.HOUSEHOLD_KEY)
    exported = [v for v in dict.fromkeys(exported) if v not in given]
    used = [v for v in dict.fromkeys([*variables, *exported]) if v not in given]
    status = provider.get(fv.PERSON_STATUS)
    by_person = status is not None and fv.STATE["PR"] in provider
    identity = (fv.INTERVIEWER, *fv.CARTOGRAPHY)
    outside = [v for v in used if provider.get(v) not in questions]
    inside = [c for c in (*identity, *fv.STATE.values()) if provider.get(c) in questions]
    lacking = [c for c in (*identity, fv.STATE[rounds[-1]], *(fv.START_DATE[r] for r in rounds)) if c not in households]
    if not questions or outside or inside or lacking or fv.PERSON in households or (by_person and status not in questions):
        return None
    persons = [k for k in questions if fv.PERSON in tables.columns(k)]
    rows: DataFrame | None = None
    for key in [*persons, *[k for k in questions if k not in persons]]:
        own = [c for c, owner in provider.items() if owner == key and (c in used or c == fv.PERSON)]
        part = tables.tables[key]
        if by_person and status == key:
            part = part.filter(F.col(fv.PERSON_STATUS) == 1)
        part = part.selectExpr(*[f"`{c}`" for c in (fv.HOUSEHOLD_KEY, *own)])
        if reduced is not None and key == home:
            part = reduced(part, [fv.HOUSEHOLD_KEY, *[c for c in own if c in exported or c == fv.PERSON]])
        rows = part if rows is None else rows.join(part, fv.HOUSEHOLD_KEY)
    if not persons:
        rows = rows.withColumn(fv.PERSON, F.lit(0))
    if reduced is not None and home is None:
        rows = reduced(rows, [fv.HOUSEHOLD_KEY, fv.PERSON, *exported])
    return Answers(rows, tuple(rounds), not by_person or len(rounds) > 1)


def meet_households(found: DataFrame, base: DataFrame, by_household: str) -> DataFrame:
    """Answers with their households, joined once; ``by_household`` names a column as of ``Answers``."""
    joined = found.join(base, fv.HOUSEHOLD_KEY)
    return joined.filter(f"{FINISHED} OR NOT {by_household}").drop(FINISHED, by_household)


def assemble(
    tables: SurveyTables,
    needed: Iterable[TableKey],
    variables: Iterable[str],
    start: str | None = None,
    end: str | None = None,
    person_keys: Sequence[str] = (fv.HOUSEHOLD_KEY,),
) -> DataFrame:
    """The base for rules that need the given tables, filtered and pruned to what they use.

    Columns: household key, FECHA, ENCUESTADOR, the cartographic key, CP and the variables.

    The narrow one-row-per-household tables are joined and filtered first, the case join last among
    them. Person tables come next, so that a hot household sits in a join whose two sides are both
    fresh shuffles, which adaptive execution can split. ``person_keys`` may add CP when two person
    tables describe the same persons; on the household alone each pairs with each.
    """
    needed = set(needed)
    rounds = needed_rounds(needed)
    order = join_order(tables, needed)
    base_key, control = order[0], control_keys(rounds)
    questions = [key for key in order[1:] if key not in control]
    variables = list(variables)
    provider = check_columns(tables, needed, variables)
    wanted = dict.fromkeys([*fv.CARTOGRAPHY, fv.INTERVIEWER, *variables])
    status = [c for c in (fv.PERSON_STATUS, *fv.STATE.values()) if c in provider]
    dates = [fv.START_DATE[r] for r in rounds]
    marked = CASE_MARK in tables.columns(base_key)

    def part(key: TableKey) -> DataFrame:
        own = [c for c, owner in provider.items() if owner == key]
        keys = [fv.HOUSEHOLD_KEY] + ([CASE_MARK if marked else fv.CASE_KEY] if key == base_key else [])
        if len(person_keys) > 1 and fv.PERSON in tables.columns(key):
            keys.append(fv.PERSON)
        used = [c for c in own if c in wanted or c in status or c in dates or c == fv.PERSON]
        used = list(dict.fromkeys([*keys, *used]))
        if key in control:
            return control_part(tables, key, used, start, end)
        return tables.tables[key].selectExpr(*[f"`{c}`" for c in used])

    households = part(base_key)
    for key in control:
        households = households.join(part(key), fv.HOUSEHOLD_KEY)
    finished = finished_filter(provider)
    if finished is not None and all(provider[c] in (base_key, *control) for c in status):
        households, finished = households.filter(finished), None
    base = live_households(tables, households, rounds[0])
    persons = [k for k in questions if fv.PERSON in tables.columns(k)]
    others = [k for k in questions if k not in persons]
    for n, key in enumerate([*persons, *others]):
        both_persons = 0 < n < len(persons)
        base = base.join(part(key), list(person_keys) if both_persons else [fv.HOUSEHOLD_KEY])
    if finished is not None:
        base = base.filter(finished)
    fixed = (fv.HOUSEHOLD_KEY, fv.DATE, fv.INTERVIEWER, *fv.CARTOGRAPHY, fv.PERSON)
    return base.selectExpr(
        f"`{fv.HOUSEHOLD_KEY}`", f"{dates[-1]} AS {fv.DATE}", fv.INTERVIEWER, *fv.CARTOGRAPHY,
        fv.PERSON if fv.PERSON in provider else f"0 AS {fv.PERSON}",
        *[f"`{c}`" for c in dict.fromkeys(variables) if c not in fixed],
    )


def bad_dates(tables: SurveyTables, survey_round: str) -> DataFrame:
    """Start dates that are present but unreadable, so that their rows leave every date window."""
    column = fv.START_DATE[survey_round]
    df = tables.tables[(fv.TIME_TABLE[survey_round], survey_round)]
    text = F.col(column)
    return (
        df.filter(text.isNotNull() & parse_survey_date(text).isNull())
        .groupBy(text.alias("fecha")).agg(F.count("*").alias("n"))
    )
