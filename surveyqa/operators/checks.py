"""Checks that are not rules: set mismatch between modules, open-text quality, recent visits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyqa.functions.dates import days_since, parse_survey_date
from surveyqa.functions.text import too_short_or_stopword

# Copies of a household's summary, so that the members of a hot household spread over as many tasks.
SALTS = 16
# Members of one list cell; longer lists continue in further rows, so no cell grows without bound.
LIST_SPAN = 1000


def _name(column: str) -> Column:
    return F.col(f"`{column}`")


def member_pairs(
    left: DataFrame, right: DataFrame, key: str, left_member: str, right_member: str,
    carry: Sequence[str],
) -> DataFrame:
    """Distinct (household, member) pairs, with the side or sides they occur on.

    The pair is one struct key. Grouped by two columns, the pairs would stay where the joins before
    put their household, in a single task for a hot one; a struct spreads them by pair.
    """
    member_type = left.select(_name(left_member)).schema[0].dataType
    absent = {c: left.schema[c].dataType for c in carry}
    sides = left.select(
        _name(key), _name(left_member).alias("_member"), *[_name(c) for c in carry],
        F.lit(True).alias("_in_left"), F.lit(False).alias("_in_right"),
    ).unionAll(right.select(
        _name(key), _name(right_member).try_cast(member_type).alias("_member"),
        *[F.lit(None).cast(t).alias(c) for c, t in absent.items()],
        F.lit(False).alias("_in_left"), F.lit(True).alias("_in_right"),
    ))
    return (
        sides.filter(F.col("_member").isNotNull())
        .groupBy(F.struct(_name(key), F.col("_member")).alias("_pair"))
        .agg(
            F.max("_in_left").alias("_in_left"), F.max("_in_right").alias("_in_right"),
            *[F.min(_name(c)).alias(c) for c in carry],
        )
        .select(
            F.col("_pair")[key].alias(key), F.col("_pair._member").alias("_member"), "_in_left",
            "_in_right", *[_name(c) for c in carry],
        )
    )


def set_mismatch(
    left: DataFrame, right: DataFrame, key: str, left_member: str, right_member: str,
    carry: Sequence[str], salts: int = SALTS,
) -> DataFrame:
    """Members listed on one side only, for households present on both: one row per member.

    Columns: the key, the carried columns (household minimum, from the left side), ``member``,
    ``in_left``. No household is ever gathered in one place: pairs are aggregated by household and
    member, and only a household's one-row summary is joined back, salted.
    """
    pairs = member_pairs(left, right, key, left_member, right_member, carry)
    differs = F.col("_in_left") != F.col("_in_right")
    summary = (
        pairs.groupBy(_name(key))
        .agg(
            F.max("_in_left").alias("_any_left"), F.max("_in_right").alias("_any_right"),
            F.max(differs).alias("_any_differs"),
            *[F.min(_name(c)).alias(f"_{c}") for c in carry],
        )
        .filter("_any_left AND _any_right AND _any_differs")
        .select(
            _name(key), *[_name(f"_{c}") for c in carry],
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
        )
    )
    # Two details keep both uses of the pairs alike, so that Spark aggregates the pairs once: the
    # salt is never NULL (no extra filter on the members), and least(), which is the household's own
    # minimum, reads the pair's values too (no column is left out).
    different = pairs.filter(differs).withColumn(
        "_salt", F.coalesce(F.pmod(F.hash("_member"), F.lit(salts)), F.lit(0))
    )
    return different.join(summary, [key, "_salt"]).select(
        _name(key),
        *[F.least(_name(c), _name(f"_{c}")).alias(c) for c in carry],
        F.col("_member").alias("member"), F.col("_in_left").alias("in_left"),
    )


def distinct_members(
    df: DataFrame, key: str, member: str, carry: Sequence[str] = ()
) -> DataFrame:
    """Distinct members per household as rows, with the carried columns' minimum per member."""
    pairs = df.select(_name(key), _name(member), *[_name(c) for c in carry])
    if not carry:
        return pairs.distinct()
    return pairs.groupBy(_name(key), _name(member)).agg(*[F.min(_name(c)).alias(c) for c in carry])


def member_lists(
    df: DataFrame, keys: Sequence[str], member: str, carry: Sequence[str] = (),
    span: int = LIST_SPAN,
) -> DataFrame:
    """Distinct whole-number members per group as a sorted list cell, for display.

    One cell holds the members of one span of numbers (0-999, 1000-1999, ...), so a cell has at
    most ``span`` entries; a group with higher member numbers continues in further rows.
    """
    part = F.floor(_name(member) / span).alias("parte")
    return df.groupBy(*[_name(k) for k in keys], part).agg(
        F.sort_array(F.collect_set(_name(member))).alias("miembros"),
        *[F.min(_name(c)).alias(c) for c in carry],
    )


@dataclass(frozen=True)
class TextCheck:
    """One open answer to check: texts of at most ``max_bytes`` bytes or stop words are violations."""

    column: str
    question: int
    max_bytes: int
    stopwords: tuple[str, ...]
    code: str
    label: str


def poor_answers(
    base: DataFrame, checks: Sequence[TextCheck], keep: Sequence[str], chapter: int, section: str
) -> DataFrame:
    """A row per poor open answer: one pass over the base for all checks, good rows dropped first.

    The last column is the answer itself, which is short by construction.
    """
    hits = F.array(*[
        F.when(
            too_short_or_stopword(_name(c.column), c.max_bytes, c.stopwords),
            F.struct(
                F.lit(c.question).alias("PREGUNTA"),
                F.lit(c.label).alias("DEFINICION DE INCONSISTENCIA"),
                F.lit(c.code).alias("CODIGO ERROR"),
                _name(c.column).alias("VALOR"),
            ),
        )
        for c in checks
    ])
    kept = [_name(c) for c in keep]
    any_poor = reduce(or_, [too_short_or_stopword(_name(c.column), c.max_bytes, c.stopwords) for c in checks])
    return (
        base.filter(any_poor).select(*kept, F.explode(hits).alias("_hit"))
        .filter(F.col("_hit").isNotNull())
        .select(
            *kept,
            F.lit(chapter).alias("CAPITULO"), F.lit(section).alias("SECCION"),
            F.col("_hit.PREGUNTA").alias("PREGUNTA"),
            _hit("DEFINICION DE INCONSISTENCIA"), _hit("CODIGO ERROR"),
            F.lit("").alias("COMENTARIOS"), F.col("_hit.VALOR").alias("VALOR"),
        )
    )


def text_quality(
    base: DataFrame, checks: Sequence[TextCheck], keep: Sequence[str], chapter: int, section: str
) -> DataFrame:
    """Poor open answers, each distinct row once."""
    return poor_answers(base, checks, keep, chapter, section).distinct()


def _hit(column: str) -> Column:
    return F.col(f"_hit.`{column}`").alias(column)


def last_visit(
    visits: DataFrame, key: str, date_column: str, text_max: bool = False
) -> DataFrame:
    """The last visit per questionnaire; ``text_max`` takes the largest text, then reads it."""
    text = _name(date_column)
    last = parse_survey_date(F.max(text)) if text_max else F.max(parse_survey_date(text))
    return visits.groupBy(_name(key)).agg(last.alias("ultima_visita"))


def recently_visited(
    visits: DataFrame, key: str, date_column: str, as_of: Column, max_days: int,
    text_max: bool = False,
) -> DataFrame:
    """Keys whose last visit is at most ``max_days`` old.

    The last visit is recent exactly when some visit is, so old visits are filtered out before
    anything is shuffled. The text order gives no such shortcut.
    """
    if text_max:
        last = last_visit(visits, key, date_column, text_max=True)
        return last.filter(days_since(F.col("ultima_visita"), as_of) <= max_days).select(_name(key))
    day = parse_survey_date(_name(date_column))
    return visits.filter(days_since(day, as_of) <= max_days).select(_name(key)).distinct()
