"""Text functions: accents, whitespace, names found in conditions, open-text quality."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyqa import fixed_values as fv

# Everything Python's str.split() takes for whitespace.
_WHITESPACE = r"[\s\x0B\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"
# Code points that can have a decomposition or be a mark lie below this one.
_LAST_DECOMPOSED = 0x2FA1F
# Composed syllables of the Korean script, and the first of their leading, middle and last letters.
_SYLLABLES = (0xAC00, 0xD7A3)
_LEADING, _MIDDLE, _LAST = 0x1100, 0x1161, 0x11A7
_MIDDLES, _LASTS = 21, 28
_NOT_ASCII = r"[^\x00-\x7F]"


def _without_marks(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@lru_cache(maxsize=1)
def _accent_tables() -> tuple[str, str, str, tuple[str, ...]]:
    """Characters with a one-character base form and marks, those forms; characters with longer forms, and those.

    Marks come last, without a form: translate() drops them. Syllables are left to arithmetic.
    """
    source, target, marks, longer, forms = [], [], [], [], []
    for code in range(0x80, _LAST_DECOMPOSED + 1):
        if _SYLLABLES[0] <= code <= _SYLLABLES[1] or 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        plain = _without_marks(char)
        if plain == char:
            continue
        if not plain:
            marks.append(char)
        elif len(plain) == 1:
            source.append(char)
            target.append(plain)
        else:
            longer.append(char)
            forms.append(plain)
    return "".join(source + marks), "".join(target), "".join(longer), tuple(forms)


def _letter(code: Column) -> Column:
    """The character of a code point from U+0800 to U+FFFF, from its three bytes."""
    high, middle, low = F.shiftright(code, 12), F.shiftright(code, 6).bitwiseAND(63), code.bitwiseAND(63)
    number = (high + 0xE0) * (1 << 16) + (middle + 0x80) * (1 << 8) + (low + 0x80)
    return F.decode(F.unhex(F.hex(number)), "UTF-8")


def _letters(syllable: Column) -> Column:
    """A composed syllable's letters: two, or three."""
    number = F.ascii(syllable) - _SYLLABLES[0]
    last = number % _LASTS
    return F.concat(
        _letter(F.floor(number / (_MIDDLES * _LASTS)).cast("int") + _LEADING),
        _letter((F.floor(number / _LASTS) % _MIDDLES).cast("int") + _MIDDLE),
        F.when(last == 0, "").otherwise(_letter(last + _LAST)),
    )


def strip_accents(text: Column) -> Column:
    """Letters without their accents: compatibility decomposition of every character, marks dropped.

    Characters with one base form are replaced in one pass. Only texts that hold one with a longer form, or a
    composed syllable, are taken apart by character first.
    """
    source, target, longer, forms = _accent_tables()
    first, last = map(chr, _SYLLABLES)
    syllables = f"[{first}-{last}]"
    expanded = F.array_join(F.transform(F.split(text, ""), lambda c: _expanded(c, syllables, longer, forms)), "")
    # translate() looks characters up in a table; a pattern of thousands of characters would try one by one.
    some = text.rlike(syllables) | (F.char_length(F.translate(text, longer, "")) < F.char_length(text))
    plain_text = F.translate(F.when(some, expanded).otherwise(text), source, target)
    return F.when(text.rlike(_NOT_ASCII), plain_text).otherwise(text)


def _expanded(char: Column, syllables: str, longer: str, forms: tuple[str, ...]) -> Column:
    """A character's longer form, or itself."""
    at = F.instr(F.lit(longer), char)
    form = F.get(F.split(F.lit("\x00".join(forms)), "\x00"), at - 1)
    return F.when(char < "\x80", char).when(char.rlike(syllables), _letters(char)).when(at > 0, form).otherwise(char)


def collapse_whitespace(text: Column) -> Column:
    """Runs of whitespace become one blank; none is left at the ends."""
    return F.trim(F.regexp_replace(text, _WHITESPACE, " "))


def condition_variables(condition: Column) -> Column:
    """Names in a condition, in order and with repeats, without the words of the rule language."""
    names = F.regexp_extract_all(condition, F.lit("(?U)" + fv.VARIABLE_PATTERN), F.lit(1))
    return F.filter(names, lambda name: ~name.isin(*fv.CONDITION_WORDS))


def leading_variable(condition: Column) -> Column:
    """The names that the lines of a condition start with, in order; empty without any."""
    names = F.regexp_extract_all(condition, F.lit("(?m)" + fv.LEADING_VARIABLE_PATTERN), F.lit(1))
    return F.array_join(names, ", ")


def group_number(file_name: Column) -> Column:
    """The group number held in a report file name; NULL when there is none."""
    return F.regexp_extract(file_name, fv.GROUP_FILE_PATTERN, 1).try_cast("int")


def batch_time(batch_name: Column) -> Column:
    """The moment a batch name was made; names carry no year, so all fall in one year."""
    stamp = F.regexp_extract(batch_name, fv.BATCH_PATTERN, 1)
    return F.try_to_timestamp(
        F.concat(F.lit("2000-"), stamp), F.lit("yyyy-" + fv.BATCH_TIME_FORMAT)
    )


def too_short_or_stopword(text: Column, max_bytes: int, stopwords: Sequence[str]) -> Column:
    """True for an open answer of at most ``max_bytes`` bytes, missing, or on the stop list."""
    answer = F.coalesce(text, F.lit(""))
    return (F.octet_length(answer) <= max_bytes) | F.upper(answer).isin(*stopwords)
