"""Quality rules whose thresholds adapt to language and source.

Method. One pass measures every whole text. The ratios (symbols, capitals, repeated lines, repeated
words) of the texts that pass the base rules go into sketches per language and source: counts per
logarithmic bin, which merge by addition, know every quantile to a relative error of ``ERROR`` and don't
depend on the order of rows. A sketch's level is the ``UPPER`` quantile of its non-zero part times the share
of that part, so that a ratio most texts of a group don't have is low there, and no floor holds it up. A
group's level counts with its number of texts, its language's with ``PRIOR`` more, and that of everything
stands behind the language's in the same way: no number of texts switches anything. A text fails where the lower confidence bound
(Wilson, ``SURE`` deviations) of its ratio is over ``FENCE`` times the level: one repeated line of ten
says less than a hundred of a thousand. The fences are joined back to the measures.

Results. One row per input row. A null or blank text has no words and fails the base rules. A null
language or source is a group of its own. Equal lines and windows are counted within one text only;
repeated rows count once each. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyqa.llm.storage import shared_folder, staged
from surveyqa.llm.words import BYTES, SPACE, Words, blocks, mix, span_hashes, windows

ERROR, UPPER, PRIOR, FENCE, SURE = 0.01, 0.9, 200.0, 2.0, 3.0
#: Bin of the value 0.
ZERO = -(1 << 30)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", "n_repeat_words"]
RATIOS = {
    "symbols": "n_symbols / greatest(1, word_chars)", "capitals": "n_capitals / greatest(1, word_chars)",
    "lines": "n_dup_lines / greatest(1, n_lines)", "repeats": "n_repeat_words / greatest(1, n_words)",
}
#: What each ratio is counted from; a repeated word comes with the five of its window.
UNITS = {"symbols": "word_chars", "capitals": "word_chars", "lines": "n_lines", "repeats": "n_words / 5"}
BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"
#: Bytes that begin a character, symbols and capitals.
BEGINS = (np.arange(256) & 0xC0) != 0x80
SYMBOL, CAPITAL = np.zeros(256, bool), np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
CAPITAL[ord("A") : ord("Z") + 1] = True


def per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Marked bytes of each row."""
    total = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def repeats(keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys so that equal ones of a row are neighbours, and where neighbours are equal."""
    keys = keys ^ mix(row.astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    return order, keys[order][1:] == keys[order][:-1]


def measures(words: Words) -> list[np.ndarray]:
    data, offsets, count = words.data, words.offsets, words.last - words.first
    inside = ~SPACE[data]
    n_words = np.bincount(words.row, minlength=count)
    ends = np.flatnonzero(np.concatenate((data == 0x0A, [False])))
    start = np.unique(np.concatenate((ends + 1, offsets[:-1][np.diff(offsets) > 0])))
    start = start[start < len(data)]
    end = np.minimum(np.append(start[1:], len(data)), len(data))
    row = np.searchsorted(offsets, start, "right") - 1
    end = end - ((data[end - 1] == 0x0A) if len(end) else 0)
    total = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
    filled = total[end] > total[start]
    row = row[filled]
    lines = span_hashes(data, BYTES, start[filled], end[filled])
    order, equal = repeats(lines, row)
    n_dup = np.bincount(row[order][1:][equal], minlength=count)
    keys, first = windows(words, 5)
    order, equal = repeats(keys, words.row[first])
    again = np.zeros(len(keys), bool)
    again[order[1:][equal]] = again[order[:-1][equal]] = True
    cover = np.zeros(len(words.row) + 1, np.int64)
    cover[first[again]] += 1
    cover[first[again] + 5] -= 1
    covered = np.cumsum(cover)[:-1] > 0
    return [
        n_words, per_row(inside & BEGINS[data], offsets), per_row(SYMBOL[data], offsets), per_row(CAPITAL[data], offsets),
        np.bincount(row, minlength=count), n_dup, np.bincount(words.row[covered], minlength=count),
    ]


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: the counts of every text."""
    for batch in batches:
        parts = [measures(words) for words in blocks(batch["text"], lower=False)]
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*parts)] or [np.zeros(0, np.int64)] * len(COUNTS)
        keys = ["doc_id", "lang", "source"]
        yield pa.RecordBatch.from_arrays([batch[c] for c in keys] + list(map(pa.array, columns)), names=keys + COUNTS)


def surely(ratio: str) -> str:
    """SQL of the least ratio that a text's count is evidence for (Wilson's lower bound)."""
    x, n = f"({RATIOS[ratio]})", f"greatest(1D, {UNITS[ratio]})"
    z = f"{SURE ** 2}D"
    bound = f"({x} + {z} / (2 * {n}) - {SURE}D * sqrt(greatest(0D, {x} * (1 - {x})) / {n} + {z} / (4 * {n} * {n}))) / (1 + {z} / {n})"
    return f"if({x} > 0, {bound}, 0D)"  # exactly 0 without any


def fences(rows: DataFrame) -> DataFrame:
    """``lang``, ``source`` and an upper fence per ratio, from mergeable sketches."""
    growth = (1 + ERROR) / (1 - ERROR)
    passing = F.expr(f"NOT ({BASE_FAILED})").cast("long")
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), F.expr(v).cast("double").alias("x")) for k, v in RATIOS.items()]))
    bins = rows.select("lang", "source", passing.alias("w"), values.alias("m")).select(
        "lang", "source", "w", "m.ratio",
        F.when(F.col("m.x") > 0, F.ceil(F.log("m.x") / np.log(growth)).cast("int")).otherwise(ZERO).alias("bin"),
    ).groupBy("lang", "source", "ratio", "bin").agg(F.sum("w").alias("n"))

    def levels(sketch: DataFrame, keys: list[str], tag: str) -> DataFrame:
        """Level and number of texts by key and ratio; a sketch has some hundreds of bins, however many texts."""
        merged = sketch.groupBy(*keys, "ratio", "bin").agg(F.sum("n").alias("n"))
        whole = Window.partitionBy(*keys, "ratio")
        some = F.when(F.col("bin") != ZERO, F.col("n")).otherwise(0)
        placed = merged.select(
            "*", F.sum(some).over(whole).alias("some"),
            F.sum(some).over(whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        )
        at = F.when((F.col("bin") != ZERO) & (F.col("some") > 0) & (F.col("upto") >= UPPER * F.col("some")), F.col("bin"))
        found = placed.groupBy(*keys, "ratio").agg(F.min(at).alias("bin"), F.max("some").alias("some"), F.sum("n").alias(f"n_{tag}"))
        value = F.expr(f"2D * power({growth}D, bin) / ({growth}D + 1)")
        share = F.col("some") / F.nullif(F.col(f"n_{tag}"), F.lit(0))
        return found.select(*keys, "ratio", F.coalesce(value * share, F.lit(0.0)).alias(f"level_{tag}"), f"n_{tag}")

    own = levels(bins, ["lang", "source"], "own")
    language = levels(bins, ["lang"], "lang").withColumnsRenamed({"lang": "l", "ratio": "r"})
    every = levels(bins, [], "all").withColumnRenamed("ratio", "r2")
    merged = own.join(language, F.col("lang").eqNullSafe(F.col("l")) & (F.col("ratio") == F.col("r"))).join(every, F.col("ratio") == F.col("r2"))
    behind = F.expr(f"(n_lang * level_lang + {PRIOR}D * level_all) / (n_lang + {PRIOR}D)")
    level = (F.col("n_own") * F.col("level_own") + PRIOR * behind) / (F.col("n_own") + PRIOR)
    return merged.withColumn("fence", FENCE * level).groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("ratio") == k, F.col("fence"))).alias(f"max_{k}") for k in RATIOS]
    )


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every row; see the module."""
    folder = shared_folder(docs.sparkSession)
    named = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"),
    )
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    rows = staged(named.mapInArrow(measured, schema), folder, "measures")
    limits = staged(fences(rows), folder, "fences").withColumnsRenamed({"lang": "l", "source": "s"})
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")))
    failed = F.expr(BASE_FAILED)
    within = F.expr(" AND ".join(f"{surely(k)} <= max_{k}" for k in RATIOS))
    return joined.select(
        "doc_id", *COUNTS, failed.alias("base_failed"), (~failed & within).alias("kept"), *[f"max_{k}" for k in RATIOS]
    )
