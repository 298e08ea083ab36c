"""Records of delimited files whose quoted fields hold line breaks, read by any number of tasks a file.

Files are scanned as lines, in the splits that Spark makes of them. A line break belongs to a field where the
number of quotes before it is odd, so each split needs one thing from those before it: the parity of their
quotes. A first pass counts it, a number per split. A second pass joins lines to records within its split;
what a split's first or last record lacks is put together from neighbouring splits, at most two pieces each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
#: Kinds of pieces: a whole record, one begun in a split before, one that goes on in the split after.
WHOLE, REST, BEGUN = 0, 1, 2
PIECES = "file string, start long, place long, kind int, record string"


def file_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their file and the start of their split; only a line feed ends a line."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def open_splits(lines: DataFrame) -> set[tuple[str, int]]:
    """The splits that begin within a quoted field. The driver sees one row per split."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    rows = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd")).collect()
    found, inside, file = set(), 0, None
    for row in sorted(rows, key=lambda r: (r["file"], r["start"])):
        if row["file"] != file:
            file, inside = row["file"], 0
        if inside:
            found.add((file, row["start"]))
        inside ^= int(row["odd"])
    return found


def joined_lines(opened: set[tuple[str, int]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: the pieces of each split, in order. Lines without a broken record pass as they are."""
    key: tuple[str, int] | None = None
    held: list[str] = []
    inside = rest = False
    place = 0

    def batch_of(key: tuple[str, int], records: list, kinds: list) -> pa.RecordBatch:
        nonlocal place
        first, place = place, place + len(records)
        columns = [
            pa.array([key[0]] * len(records), pa.string()), pa.array([key[1]] * len(records), pa.int64()),
            pa.array(range(first, place), pa.int64()), pa.array(kinds, pa.int32()), pa.array(records, pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["file", "start", "place", "kind", "record"])

    def ended() -> Iterator[pa.RecordBatch]:
        if key is not None and (held or rest):
            yield batch_of(key, ["\n".join(held)], [BEGUN if not rest else REST])

    for batch in batches:
        file, start = batch["file"], batch["start"]
        codes = file.dictionary_encode().indices.to_numpy()
        edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(start.to_numpy()) != 0)) + 1
        for first, last in zip([0, *edges], [*edges, len(batch)]):
            if first == last:
                continue
            own = (file[int(first)].as_py(), start[int(first)].as_py())
            if own != key:
                yield from ended()
                key, held, place = own, [], 0
                inside = rest = own in opened
            values = batch["value"].slice(first, last - first)
            odd = pc.count_substring(values, QUOTE).to_numpy(zero_copy_only=False) % 2 == 1
            records, kinds = [], []
            if not inside and not odd.any():
                records, kinds = values.to_pylist(), [WHOLE] * len(values)
            else:
                for text, turns in zip(values.to_pylist(), odd):
                    held.append(text)
                    inside ^= bool(turns)
                    if not inside:
                        records.append("\n".join(held))
                        kinds.append(REST if rest else WHOLE)
                        held, rest = [], False
            yield batch_of(key, records, kinds)
    yield from ended()


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file``, ``record`` and ``first``: every record of the files, and whether it is its file's first."""
    lines = file_lines(spark, path)
    opened = open_splits(lines)
    pieces = lines.mapInArrow(lambda batches: joined_lines(opened, batches), PIECES)
    first = (F.col("start") == 0) & (F.col("place") == 0)
    whole = pieces.filter(F.col("kind") == WHOLE).select("file", "record", first.alias("first"))
    order = Window.partitionBy("file").orderBy("start", "kind")
    broken = pieces.filter(F.col("kind") != WHOLE).withColumn("number", F.sum(F.when(F.col("kind") == BEGUN, 1).otherwise(0)).over(order))
    put = broken.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "record"))).alias("p"),
        F.max(first & (F.col("kind") == BEGUN)).alias("first"),
    ).select("file", F.expr("array_join(transform(p, x -> x.record), '\n')").alias("record"), "first")
    return whole.unionAll(put).withColumn("record", F.regexp_replace("record", "\r$", ""))


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ",", file: Column | None = None
) -> DataFrame:
    """Files with a header line, quotes doubled inside quoted fields, parsed by Spark's own reader; a blank line is no record.

    ``file`` is an expression of the column ``file``, kept as ``_file``.
    """
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "multiLine": "true", "mode": "PERMISSIVE"}
    kept = records(spark, path).filter("NOT first AND record <> ''")
    parsed = F.from_csv("record", ddl(schema), options)
    source = [] if file is None else [file.alias("_file")]
    return kept.select(*source, parsed.alias("_r")).select(*[F.col("_file")][: len(source)], "_r.*")


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
