"""Many rules over one base in one scan: each distinct comparison once, rules as programs over its bit."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyqa.operators.conditions import Condition

# Flags held by one 64-bit word; the sign bit stays unused.
WORD = 60
# Comparisons evaluated by one plan step, and tests of bits. The JIT compiler skips generated methods over
# 8 KB, and a step much larger than this outgrows that and runs many times slower.
STEP_COMPARISONS = 24
STEP_TESTS = 120
# Sheets of more rules are tested once for rows that are alike in all comparisons and kept columns, and not once a row.
MANY = 480
# Rules alike but for their comparisons are rows of a table then: the shapes of at least ALIKE rules and at most
# SHAPE_ATOMS comparisons, SHAPES of them. The others are tested in plan steps as well.
ALIKE, SHAPE_ATOMS, SHAPES = 16, 16, 32


@dataclass(frozen=True)
class Predicate:
    """A rule ready to run: its id, its SQL text, and the same as comparisons and what connects them.

    ``template`` holds connectives and, for each comparison, its place in ``atoms``. A rule without them is
    a single comparison.
    """

    rule_id: int
    sql: str
    comparisons: int = 1
    variables: tuple[str, ...] = ()
    atoms: tuple[str, ...] = ()
    template: tuple[str | int, ...] = ()

    @classmethod
    def of(cls, rule_id: int, compiled: Condition) -> Predicate:
        return cls(rule_id, compiled.sql, compiled.comparisons, compiled.variables, compiled.atoms, compiled.template)

    def program(self) -> tuple[tuple[str, ...], tuple[str | int, ...]]:
        return (self.atoms, self.template) if self.atoms else ((self.sql,), (0,))


def distinct_comparisons(predicates: Iterable[Predicate]) -> dict[str, int]:
    """Each comparison of all rules once, numbered; those on the same columns stand together."""
    found: dict[str, tuple[str, ...]] = {}
    for predicate in predicates:
        for atom in predicate.program()[0]:
            found.setdefault(atom, predicate.variables)
    return {atom: k for k, atom in enumerate(sorted(found, key=lambda a: (found[a], a)))}


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{name}`" for name in names]


def bit_words(
    df: DataFrame, carried: Sequence[str], tests: Sequence[tuple[str, int]], prefix: str, step_cost: int
) -> tuple[DataFrame, list[str]]:
    """The carried columns and one bit per test, packed in words; a test comes with its cost.

    Each step adds its flags through a one-element ``explode``. That changes no row, but keeps the step an
    operator of its own: plain column additions would be merged into one projection, too large for the JIT
    compiler once there are dozens of tests.
    """
    columns, words = _quoted(carried), []
    for start in range(0, len(tests), WORD):
        word, flags, cost, begun = f"{prefix}{len(words)}", [], 0, False
        own = tests[start:start + WORD]
        for bit, (sql, weight) in enumerate(own):
            flags.append(f"if({sql}, {1 << bit}L, 0L)")
            cost += weight
            if cost >= step_cost or bit == len(own) - 1:
                value = " | ".join(([word] if begun else []) + flags)
                df = df.selectExpr(*columns, *words, f"explode(array({value})) AS {word}")
                flags, cost, begun = [], 0, True
        words.append(word)
    return df, words


def comparison_words(base: DataFrame, numbers: dict[str, int], keep: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The kept columns and one bit per distinct comparison, over a single scan of the base."""
    df, bits = bit_words(base, base.columns, [(atom, 1) for atom in numbers], "_c", STEP_COMPARISONS)
    return df.selectExpr(*_quoted(keep), *bits), bits


def rule_words(
    df: DataFrame, predicates: Sequence[Predicate], numbers: dict[str, int], bits: Sequence[str], keep: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """The kept columns and one flag per rule, packed in words, from the bits of the comparisons.

    A sheet of thousands of rules has far fewer different comparisons, and a test of a bit costs a fraction of a
    comparison. A comparison with NULL sets no bit, which is what connectives without a truth value of their own
    make of it.
    """

    def tested(predicate: Predicate) -> tuple[str, int]:
        atoms, template = predicate.program()

        def test(part: str | int) -> str:
            if isinstance(part, str):
                return part
            word, bit = divmod(numbers[atoms[part]], WORD)
            return f"(_c{word} & {1 << bit}L) <> 0L"

        return " ".join(map(test, template)), len(atoms)

    carried = list(dict.fromkeys([*keep, *bits]))
    return bit_words(df, carried, [tested(p) for p in predicates], "_w", STEP_TESTS)


#: A row's flags: the number of the word and its bits.
FLAG_COLUMNS = ("_word", "_flags")


def narrowed(base: DataFrame, predicates: Sequence[Predicate], keep: Sequence[str]) -> DataFrame:
    """The columns that the rules or the result need."""
    used = dict.fromkeys(keep) | dict.fromkeys(v for p in predicates for v in p.variables)
    return base.selectExpr(*_quoted([c for c in base.columns if c in used])) if all(p.variables for p in predicates) else base


def words_of_rows(flagged: DataFrame, words: Sequence[str], keep: Sequence[str], first: int = 0) -> DataFrame:
    """A row for each word with a bit set: the kept columns and flags."""
    broken = flagged.filter(" OR ".join(f"{word} <> 0L" for word in words))
    rows = broken.selectExpr(*_quoted(keep), f"posexplode(array({', '.join(words)})) AS (_word, _flags)")
    return rows.filter("_flags <> 0L").selectExpr(*_quoted(keep), f"_word + {first} AS _word", "_flags")


def flagged_rows(base: DataFrame, predicates: Sequence[Predicate], keep: Sequence[str], first: int = 0) -> DataFrame:
    """Rows that break some rule, a row for each word with a bit set: the kept columns and flags.

    Words are numbered from ``first``, so that rows of several bases can share a list of rules.
    """
    numbers = distinct_comparisons(predicates)
    df, bits = comparison_words(narrowed(base, predicates, keep), numbers, keep)
    return words_of_rows(*rule_words(df, predicates, numbers, bits, keep), keep, first)


def padded_ids(predicates: Sequence[Predicate]) -> list[int]:
    """Rule ids by word and bit, -1 where a last word has no rule."""
    return [p.rule_id for p in predicates] + [-1] * (-len(predicates) % WORD)


def expand_flags(flagged: DataFrame, ids: Sequence[int], keep: Sequence[str]) -> DataFrame:
    """One row per flagged row and rule that holds for it: the kept columns and ``rule_id``."""
    kept = _quoted(keep)
    return (
        flagged.selectExpr(*kept, *FLAG_COLUMNS, f"explode(sequence(0, {WORD - 1})) AS _bit")
        .filter("shiftright(_flags, _bit) & 1L = 1L")
        .selectExpr(*kept, f"element_at(array({', '.join(map(str, ids))}), _word * {WORD} + _bit + 1) AS rule_id")
    )


def common_shapes(predicates: Sequence[Predicate]) -> list[tuple[str | int, ...]]:
    """What connects the comparisons of many rules, the most frequent first."""
    counts: dict[tuple[str | int, ...], int] = {}
    for predicate in predicates:
        atoms, template = predicate.program()
        if len(atoms) <= SHAPE_ATOMS:
            counts[template] = counts.get(template, 0) + 1
    return sorted((t for t, n in counts.items() if n >= ALIKE), key=lambda t: -counts[t])[:SHAPES]


def can_group(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether values that are grouped as equal are the same: zeros, collated texts and nested values may not be."""
    exact = (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
    return all(isinstance(t, exact) or t == T.StringType() for t in (df.schema[c].dataType for c in columns))


def evaluate_patterns(base: DataFrame, predicates: Sequence[Predicate], keep: Sequence[str]) -> DataFrame:
    """``evaluate`` for large sheets, in one scan: equal rows are tested once, rules alike are rows of a table.

    Rows with the same kept columns and the same bits are counted before the rules are tested, so that their cost
    no longer grows with the rows where rows are alike. Rules meet them in one join: a rule says where its bits are,
    a shape is one condition. Rules of rare shapes are tested in plan steps first, and are a bit of their own.
    """
    numbers = distinct_comparisons(predicates)
    rows, words = comparison_words(narrowed(base, predicates, keep), numbers, keep)
    kept = [*keep]
    if grouped := can_group(rows, keep):
        # Groups of more than a thousand rows are several, so that no task has to give all rows of a large one.
        rows = rows.groupBy(*_quoted(keep), *words).agg(F.count("*").alias("_all"))
        rows = rows.selectExpr(*_quoted(keep), *words, "_all", "explode(sequence(0L, (_all - 1) div 1000)) AS _part")
        rows = rows.selectExpr(*_quoted(keep), *words, "least(1000L, _all - 1000 * _part) AS _times")
        rows = rows.repartition(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        kept.append("_times")
    shapes = {shape: k for k, shape in enumerate(common_shapes(predicates))}
    apart = [p for p in predicates if p.program()[1] not in shapes]
    placed = {id(p): (0, [(len(words) + k // WORD, k % WORD)]) for k, p in enumerate(apart)}
    if apart:
        rows, own = rule_words(rows, apart, numbers, words, [*kept, *words])
        words = [*words, *own]
    for predicate in predicates:
        atoms, template = predicate.program()
        if template in shapes:
            placed[id(predicate)] = 1 + shapes[template], [divmod(numbers[atom], WORD) for atom in atoms]
    width = max(len(places) for _, places in placed.values())
    sheet = []
    for predicate in predicates:
        shape, places = placed[id(predicate)]
        sheet.append((predicate.rule_id, shape, *[x for place in [*places, *[(0, 0)] * (width - len(places))] for x in place]))
    kind = "int" if all(abs(p.rule_id) < 1 << 31 for p in predicates) else "long"
    columns = ", ".join(f"_at{k} int, _bit{k} int" for k in range(width))
    rules = base.sparkSession.createDataFrame(sheet, f"rule_id {kind} NOT NULL, _shape int, {columns}")

    def holds(shape: tuple[str | int, ...]) -> str:
        return " ".join(x if isinstance(x, str) else f"(shiftright(_bits[_at{x}], _bit{x}) & 1L) <> 0L" for x in shape)

    condition = " OR ".join(f"(_shape = {k} AND ({holds(shape)}))" for k, shape in enumerate([(0,), *shapes]))
    met = rows.selectExpr(*_quoted(kept), f"array({', '.join(words)}) AS _bits").join(F.broadcast(rules), F.expr(condition))
    if grouped:
        met = met.selectExpr(*_quoted(keep), "rule_id", "explode(sequence(1L, _times)) AS _n")
    return met.selectExpr(*_quoted(keep), "rule_id")


def evaluate(base: DataFrame, predicates: Sequence[Predicate], keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``rule_id`` for every base row and rule that holds for it.

    Rows that break no rule are dropped before anything is multiplied.
    """
    if not predicates:
        return base.selectExpr(*_quoted(keep), "0 AS rule_id").limit(0)
    if len(predicates) > MANY and not base.isStreaming:
        return evaluate_patterns(base, predicates, keep)
    return expand_flags(flagged_rows(base, predicates, keep), padded_ids(predicates), keep)
