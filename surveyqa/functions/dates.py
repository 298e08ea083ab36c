"""Dates written as day/month/two-digit year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyqa import fixed_values as fv


def parse_survey_date(text: Column) -> Column:
    """``dd/mm/yy`` text to a date, NULL when it is not one; 69 to 99 are years of the 1900s."""
    parsed = F.try_to_date(text, fv.SURVEY_DATE_FORMAT)
    return F.when(F.year(parsed) >= 2069, F.add_months(parsed, -1200)).otherwise(parsed)


def date_label(moment: Column) -> Column:
    """A moment as in the names of reports: day, month, year and hour."""
    return F.date_format(moment, fv.LABEL_FORMAT)


def days_since(day: Column, as_of: Column) -> Column:
    return F.datediff(as_of, day)
