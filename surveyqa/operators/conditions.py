"""Rule conditions as Spark SQL predicates.

A condition is text such as ``PPA03 >= 18 & CP no es vacio & (P10C21 está en (5,6) o P10C47 > 0)``.
Its comparisons are rewritten one by one with regular expressions, with the column types at hand;
what remains (AND, OR, NOT, parentheses) is left to Spark's own SQL parser. Only rule texts pass
through here, never data.

NULL follows the rule language, not SQL: ``<>`` and ``no está en`` hold for an empty answer, every
other comparison fails for it.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T


class ConditionError(ValueError):
    """The condition cannot be evaluated on the given columns."""


@dataclass(frozen=True)
class Condition:
    """A condition as one predicate, and as its comparisons with the text that connects their numbers."""

    sql: str
    variables: tuple[str, ...]
    comparisons: int
    warnings: tuple[str, ...]
    atoms: tuple[str, ...] = ()
    template: tuple[str | int, ...] = ()


_RESERVED = r"\b(?!(?:y|o|no|es|esta|en|vacio|and|or|not|in)\b)"
_LITERAL = r"\x02\d+\x03"
_NUMBER = r"\b\d+(?:\.\d+)?\b"
_NAME = rf"{_RESERVED}[A-Za-z_]\w*"
_TERM = rf"-?(?:{_LITERAL}|{_NUMBER}|{_NAME})"
_OPERAND = rf"{_TERM}(?:\s*[-+*/]\s*{_TERM})*"
_OPERATOR = r"(?:<==|>==|<=|>=|=<|=>|<>|!=|==|=|<|>)"
_EMPTY = r"(?:\(\s*vacio\s*\)|vacio\b)"

_COMPARISON = re.compile(
    rf"(?P<m_left>{_OPERAND})\s+(?P<m_not>no\s+|not\s+)?(?:esta\s+en|in)\s*[(\[](?P<m_list>[^()\[\]]*)[)\]]"
    rf"|(?P<e_name>{_NAME})\s+(?P<e_not>no\s+)?es\s*{_EMPTY}"
    rf"|(?P<q_name>{_NAME})\s*(?P<q_op><>|!=|==|=)\s*{_EMPTY}"
    rf"|(?P<chain>{_OPERAND}(?:\s*{_OPERATOR}\s*{_OPERAND})+)",
    re.IGNORECASE,
)
_REST = re.compile(r"\s*(\x04\d+\x05|[()~]|&{1,2}|\|{1,2}|\b(?:y|and|o|or|not)\b)\s*", re.IGNORECASE)
_CONNECTIVES = {
    "y": "AND", "and": "AND", "&": "AND", "&&": "AND",
    "o": "OR", "or": "OR", "|": "OR", "||": "OR",
    "not": "NOT", "~": "NOT", "(": "(", ")": ")",
}
_SPELLINGS = {"==": "=", "!=": "<>", "=<": "<=", "=>": ">=", "<==": "<=", ">==": ">="}


def _plain(text: str) -> str:
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(c for c in decomposed if not unicodedata.combining(c))


def _kind(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return "number"
    if isinstance(data_type, T.StringType):
        return "text"
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    return data_type.simpleString()


_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
#: Digits of the widest decimal.
_WIDEST = 38


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class _Side:
    sql: str
    kind: str
    names: tuple[str, ...] = ()
    text: str | None = None
    #: The most digits of a whole number; None for other values.
    digits: int | None = None


class _Rewriter:
    """Turns the comparisons of one condition into SQL, noting what it meets."""

    def __init__(self, types: Mapping[str, T.DataType]):
        self.types = {name.upper(): (name, kind) for name, kind in types.items()}
        self.literals: list[str] = []
        self.atoms: list[str] = []
        self.variables: dict[str, None] = {}
        self.warnings: list[str] = []

    # -- operands ---------------------------------------------------------

    def column(self, word: str) -> tuple[str, T.DataType]:
        if word.upper() not in self.types:
            raise ConditionError(f"unknown variable {word}")
        name, data_type = self.types[word.upper()]
        self.variables[name] = None
        return name, data_type

    def term(self, text: str) -> _Side:
        text = text.strip()
        if text.startswith("-"):
            side = self.term(text[1:])
            if side.kind != "number":
                raise ConditionError("a sign needs a number")
            # The least whole number has no opposite of its own type.
            value = side.sql if side.digits is None else f"CAST({side.sql} AS DECIMAL({side.digits}, 0))"
            return _Side(f"(-{value})", "number", side.names, digits=side.digits)
        if text.startswith("\x02"):
            value = self.literals[int(text[1:-1])]
            return _Side(_quote(value), "text", text=value)
        if text[0].isdigit():
            if not text.isdigit():
                return _Side(f"{text}D", "number")
            if len(text) > _WIDEST:
                raise ConditionError(f"more than {_WIDEST} digits: {text}")
            return _Side(text if len(text) <= 18 else f"{text}BD", "number", digits=len(text))
        name, data_type = self.column(text)
        return _Side(f"`{name}`", _kind(data_type), (name,), digits=_DIGITS.get(type(data_type)))

    def operand(self, text: str) -> _Side:
        """A column, number or quoted text, or a sum/product of numbers.

        Sums, differences and products of whole numbers are decimals wide enough to be exact. Other
        arithmetic, and any that needs more digits than a decimal has, is done in double, which
        cannot overflow; dividing by zero gives a signed infinity, or NULL for 0/0.
        """
        pieces = re.split(r"(?<=[\w\x03])\s*([-+*/])\s*", text.strip())
        if len(pieces) == 1:
            return self.term(text)
        sides = [self.term(piece) for piece in pieces[::2]]
        if any(side.kind != "number" for side in sides):
            raise ConditionError(f"arithmetic needs numbers: {text}")
        digits = self.exact_digits(sides, pieces[1::2])
        cast = [f"CAST({s.sql} AS {'DOUBLE' if digits is None else f'DECIMAL({s.digits}, 0)'})" for s in sides]
        sums, signs = cast[:1], [""]
        for sign, value in zip(pieces[1::2], cast[1:], strict=True):
            if sign in "+-":
                sums.append(value)
                signs.append(sign)
            elif sign == "*":
                sums[-1] = f"{sums[-1]} * {value}"
            else:
                top = f"({sums[-1]})"
                sums[-1] = (
                    f"coalesce(try_divide({top}, {value}), CASE WHEN {value} = 0 AND {top} > 0 THEN "
                    f"double('Infinity') WHEN {value} = 0 AND {top} < 0 THEN double('-Infinity') END)"
                )
        sql = " ".join(f"{sign} {part}".strip() for sign, part in zip(signs, sums, strict=True))
        names = tuple(name for side in sides for name in side.names)
        if "/" in pieces[1::2]:
            # Infinity less infinity is NaN, which Spark would order above every number.
            sql = f"nullif({sql}, double('NaN'))"
        return _Side(f"({sql})", "number", names, digits=digits)

    @staticmethod
    def exact_digits(sides: list[_Side], signs: list[str]) -> int | None:
        """Digits of an exact result, or None where there is no exact one."""
        if "/" in signs or any(side.digits is None for side in sides):
            return None
        terms = [sides[0].digits]
        for sign, side in zip(signs, sides[1:], strict=True):
            if sign == "*":
                terms[-1] += side.digits
            else:
                terms.append(side.digits)
        digits = max(terms) + len(terms) - 1
        return digits if digits <= _WIDEST else None

    # -- comparisons ------------------------------------------------------

    def empty(self, word: str, negated: bool) -> str:
        name, data_type = self.column(word)
        column = f"`{name}`"
        if isinstance(data_type, T.StringType):
            if negated:
                return f"({column} IS NOT NULL AND {column} <> '')"
            return f"({column} IS NULL OR {column} = '')"
        return f"({column} IS {'NOT ' if negated else ''}NULL)"

    def shown(self, text: str) -> str:
        return re.sub(_LITERAL, lambda m: repr(self.literals[int(m.group(0)[1:-1])]), text)

    def mismatch(self, what: str, result: bool) -> str:
        self.warnings.append(f"types differ, always {str(result).lower()}: {self.shown(what)}")
        return str(result).lower()

    def compare(self, left: _Side, op: str, right: _Side, what: str) -> str:
        op = _SPELLINGS.get(op, op)
        if op in ("=", "<>"):
            for one, other in ((left, right), (right, left)):
                if other.text == "" and len(one.names) == 1 and one.sql == f"`{one.names[0]}`":
                    return self.empty(one.names[0], op == "<>")
        if {left.kind, right.kind} == {"date", "text"} and (left.text or right.text):
            left, right = self.dated(left), self.dated(right)
        elif left.kind != right.kind:
            if op == "=":
                return self.mismatch(what, False)
            if op == "<>":
                return self.mismatch(what, True)
            raise ConditionError(f"cannot order {left.kind} and {right.kind}: {what}")
        sql = f"{left.sql} {op} {right.sql}"
        if op != "<>":
            return f"({sql})"
        nulls = [f" OR {side.sql} IS NULL" for side in (left, right) if side.names]
        return f"({sql}{''.join(nulls)})"

    def dated(self, side: _Side) -> _Side:
        if side.text is None:
            return side
        if not re.fullmatch(r"\d{4}-\d{1,2}-\d{1,2}([ T][\d:.]+)?", side.text):
            raise ConditionError(f"not a date: {side.text}")
        return _Side(f"TIMESTAMP_NTZ {_quote(side.text)}", "date")

    def chain(self, text: str) -> str:
        pieces = re.split(rf"\s*({_OPERATOR})\s*", text)
        sides = [self.operand(piece) for piece in pieces[::2]]
        pairs = [
            self.compare(left, op, right, text)
            for left, op, right in zip(sides[:-1], pieces[1::2], sides[1:], strict=True)
        ]
        return pairs[0] if len(pairs) == 1 else "(" + " AND ".join(pairs) + ")"

    def member(self, left_text: str, negated: bool, list_text: str, what: str) -> str:
        left = self.operand(left_text)
        items = [self.term(item) for item in list_text.split(",") if item.strip()]
        if any(item.names for item in items):
            raise ConditionError(f"a list holds values only: {what}")
        if left.kind == "date":
            items = [self.dated(item) for item in items]
        fitting = [item.sql for item in items if item.kind == left.kind]
        if len(fitting) < len(items):
            self.warnings.append(f"types differ in list: {self.shown(what)}")
        if not fitting:
            return self.mismatch(what, negated)
        values = ", ".join(fitting)
        if negated:
            return f"({left.sql} NOT IN ({values}) OR {left.sql} IS NULL)"
        return f"({left.sql} IN ({values}))"

    def rewrite(self, match: re.Match[str]) -> str:
        what = match.group(0)
        if match["m_left"]:
            sql = self.member(match["m_left"], bool(match["m_not"]), match["m_list"], what)
        elif match["e_name"]:
            sql = self.empty(match["e_name"], bool(match["e_not"]))
        elif match["q_name"]:
            sql = self.empty(match["q_name"], match["q_op"] in ("<>", "!="))
        else:
            sql = self.chain(match["chain"])
        self.atoms.append(sql)
        return f"\x04{len(self.atoms) - 1}\x05"


def _hide_literals(text: str, literals: list[str]) -> str:
    def keep(match: re.Match[str]) -> str:
        literals.append(match.group(0)[1:-1])
        return f"\x02{len(literals) - 1}\x03"

    return re.sub(r"'[^']*'|\"[^\"]*\"", keep, text)


def condition_names(text: str) -> tuple[str, ...]:
    """Names a condition uses, in order, each once."""
    hidden = _hide_literals(text, [])
    words = re.findall(_NAME, _plain(hidden), re.IGNORECASE)
    return tuple(dict.fromkeys(words))


def compile_condition(text: str, types: Mapping[str, T.DataType]) -> Condition:
    """SQL text of a condition over columns of the given types, or ``ConditionError``."""
    if text is None or not text.strip():
        raise ConditionError("empty condition")
    rewriter = _Rewriter(types)
    hidden = " ".join(_plain(_hide_literals(text, rewriter.literals)).split())
    rest = _COMPARISON.sub(rewriter.rewrite, hidden)
    words: list[str] = []
    position = 0
    while position < len(rest):
        match = _REST.match(rest, position)
        if not match:
            raise ConditionError(f"cannot read: {re.sub(r'[^ -~]+', '…', rest[position:])}")
        words.append(match.group(1))
        position = match.end()
    two_valued = any(_CONNECTIVES.get(word.lower()) == "NOT" for word in words)
    template = [int(w[1:-1]) if w.startswith("\x04") else _CONNECTIVES[w.lower()] for w in words]

    def shown(word: str | int) -> str:
        if isinstance(word, str):
            return word
        return f"coalesce({rewriter.atoms[word]}, false)" if two_valued else rewriter.atoms[word]

    if not rewriter.atoms:
        raise ConditionError("no comparison found")
    return Condition(
        " ".join(map(shown, template)), tuple(rewriter.variables), len(rewriter.atoms), tuple(rewriter.warnings),
        tuple(rewriter.atoms), tuple(template),
    )

