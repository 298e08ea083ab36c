"""Importance resampling towards a target text distribution: hashed word features, log-ratio weights, one draw.

Method. A text's features are its runs of 1 to ``n`` words, each in the bucket its CRC-32 names. A block of
texts is cut into words at once; its distinct features are grouped by equal length into two-dimensional
arrays of bytes (a column a feature, a row a position), the checksums of all features of a length are
updated position by position, and the buckets are scattered back to where the features occur. Features
longer than ``WIDEST`` bytes, of which hardly two share a length, go to the C function one by one.

Tasks count their texts' buckets and hand on one row per bucket. Source and target counts meet in a table
of ``buckets`` rows, the only data sent to all tasks. A second pass adds up the gains of each text's
features. The draw takes the highest noisy scores: rows are dealt to sorted ranges, and a row's rank is its
place in its range plus the rows of the ranges before, so that no task sees all rows.

Results. One row per input row. A null or blank text has no features, weight 0 and no rank, unless texts
without words may be drawn. A null id counts as an empty one in the noise and comes after the others in
ties; rows with equal ids share their noise and rank one after another, in any order where their scores are
equal too. With an empty target every gain measures rarity alone; an empty table gives no rows. Extra
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyqa.llm.storage import shared_folder, staged
from surveyqa.llm.words import texts

#: Bytes of text handled at once, and of the longest feature that goes through the arrays.
BLOCK, WIDEST = 1 << 21, 256
#: Rows of one sorted range are numbered in these low bits of Spark's row numbers.
RANGE_BITS = 33


def checksum_table() -> np.ndarray:
    """CRC-32 of every byte, from the reflected polynomial of ISO 3309."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1)
    return crc


TABLE = checksum_table()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
WORD = np.zeros(256, bool)
WORD[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def column_checksums(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of each column of a two-dimensional array of bytes, all columns a position at a time."""
    crc = np.full(matrix.shape[1], 0xFFFFFFFF, np.uint32)
    for position in matrix:
        crc = TABLE[(crc ^ position) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return ~crc


def checksums(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """CRC-32 of every feature: its bytes are ``data`` between two neighbouring offsets."""
    sizes, found = np.diff(offsets), np.zeros(len(offsets) - 1, np.uint32)
    order = np.argsort(sizes, kind="stable")
    edges = np.flatnonzero(np.diff(sizes[order], prepend=-1, append=-1))
    for first, last in zip(edges[:-1], edges[1:]):
        same, size = order[first:last], int(sizes[order[first]])
        if size > WIDEST:
            found[same] = [zlib.crc32(data[offsets[k] : offsets[k + 1]]) for k in same]
        else:
            found[same] = column_checksums(data[offsets[same][None, :] + np.arange(size)[:, None]])
    return found


def gathered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all spans one after another, and their offsets."""
    offsets = np.concatenate(([0], np.cumsum(end - start)))
    return data[np.repeat(start - offsets[:-1], end - start) + np.arange(offsets[-1])], offsets


def feature_blocks(column: pa.Array, n: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block of whole rows: their number, words of each, and row and bucket of every feature."""
    data, offsets = texts(column)
    count, first = len(offsets) - 1, 0
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1
        last = min(count, max(first + 1, last))
        part, at = LOWER[data[offsets[first] : offsets[last]]], offsets[first : last + 1] - offsets[first]
        inside = WORD[part]
        edge = np.ones(len(part) + 1, bool)
        edge[1:-1] = ~inside[:-1]
        edge[at] = True
        start = np.flatnonzero(inside & edge[:-1])
        edge[:-1] = ~inside
        edge[at] = True
        end = np.flatnonzero(inside & edge[1:]) + 1
        row = np.searchsorted(at, start, "right") - 1
        # Words with one space after each, so that a run of words is one span.
        spaced, bounds = gathered(np.append(part, np.uint8(0x20)), start, end)
        place = np.zeros(len(spaced) + len(start), np.uint8)
        place[np.arange(len(spaced)) + np.repeat(np.arange(len(start)), end - start)] = spaced
        place[bounds[1:] + np.arange(len(start))] = 0x20
        begins, ends = bounds[:-1] + np.arange(len(start)), bounds[1:] + np.arange(len(start))
        rows, found = [], []
        for size in range(1, n + 1):
            whole = np.flatnonzero(row[: max(0, len(row) - size + 1)] == row[size - 1 :])
            own, cuts = gathered(place, begins[whole], ends[whole + size - 1])
            features = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(whole), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(own)]
            ).dictionary_encode()
            distinct, edges = texts(features.dictionary)
            number = (checksums(distinct, edges) % np.uint32(buckets)).astype(np.int64)
            rows.append(row[whole])
            found.append(number[features.indices.to_numpy()])
        yield last - first, np.bincount(row, minlength=last - first), np.concatenate(rows), np.concatenate(found)
        first = last


def bucket_counts(column: str, docs: DataFrame, n: int, buckets: int, total: str) -> DataFrame:
    """``bucket`` and its features in all texts; a task hands on one row per bucket it met."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, found in feature_blocks(batch["text"], n, buckets):
                counts += np.bincount(found, minlength=buckets)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["bucket", "n"])

    texts_only = docs.select(F.col(column).cast("string").alias("text"))
    return texts_only.mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias(total))


def gains(source: DataFrame, target: DataFrame, buckets: int, folder: str) -> np.ndarray:
    """A number per bucket: a thousand times the log ratio of its smoothed shares, target over source."""
    every = source.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    both = staged(every.join(source, "bucket", "left").join(target, "bucket", "left").select(
        "bucket", F.coalesce("s", F.lit(0)).cast("double").alias("s"), F.coalesce("t", F.lit(0)).cast("double").alias("t")
    ), folder, "buckets")
    total = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = f"((t + 1D) * {total.s + buckets!r}D) / ((s + 1D) * {total.t + buckets!r}D)"
    rows = both.select("bucket", F.expr(f"cast(floor(1000D * ln({ratio})) AS long)").alias("gain")).collect()
    found = np.zeros(buckets, np.int64)
    found[[r.bucket for r in rows]] = [r.gain for r in rows]
    return found


def weighed(docs: DataFrame, gain_of: np.ndarray, n: int) -> DataFrame:
    """``docs`` (id and text) with the number of words and features and the sum of the features' gains."""
    buckets = len(gain_of)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for count, n_words, row, found in feature_blocks(batch["text"], n, buckets):
                total = np.zeros(count, np.int64)
                np.add.at(total, row, gain_of[found])
                words.append(n_words)
                features.append(np.bincount(row, minlength=count))
                weights.append(total)
            columns = [np.concatenate(c).astype(np.int64) for c in (words, features, weights)]
            yield pa.RecordBatch.from_arrays([batch["id"], *map(pa.array, columns)], names=["id", "n_words", "n_features", "weight"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(summed, f"id {kind}, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, order: list, folder: str) -> DataFrame:
    """``rows`` with ``rank``, 1 first, in the given order, over any number of tasks.

    The driver receives one number per sorted range, which are at most as many as shuffle partitions.
    """
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), folder, "sorted")
    sizes = placed.groupBy(F.shiftright("_at", RANGE_BITS).alias("range")).agg(F.count("*").alias("n")).collect()
    before, offsets = 0, []
    for r in sorted(sizes, key=lambda r: r["range"]):
        offsets.append((r["range"], before))
        before += r["n"]
    table = rows.sparkSession.createDataFrame(offsets, "range long, before long")
    place = F.col("_at") - F.shiftleft(F.col("range"), RANGE_BITS)
    return placed.withColumn("range", F.shiftright("_at", RANGE_BITS)).join(F.broadcast(table), "range").withColumn(
        "rank", F.col("before") + place + 1
    ).drop("range", "before", "_at")


def resampled(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    n: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: str = "2024",
) -> DataFrame:
    """Every row's features, weight and score, and the rank of those drawn; see the module.

    Of the texts with ``least_words`` words or more, ``percent`` in a hundred are drawn. Features are runs
    of 1 to ``n`` words in one of ``buckets`` buckets; ``seed`` fixes the noise of each id.
    """
    folder = shared_folder(docs.sparkSession)
    gain_of = gains(
        bucket_counts(text_col, docs, n, buckets, "s"), bucket_counts(target_col, target, n, buckets, "t"), buckets, folder
    )
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    noise = f"sha2(concat('{seed}:', coalesce(cast(id AS string), '')), 256)"
    share = f"(cast(conv(substring({noise}, 1, 8), 16, 10) AS double) + 0.5D) / 4294967296D"
    score = F.expr(f"weight + cast(floor(-1000D * ln(-ln({share}))) AS long)")
    rows = staged(
        weighed(named, gain_of, n).withColumn("score", score).withColumn("_row", F.monotonically_increasing_id()),
        folder, "weights",
    )
    may = F.col("n_words") >= least_words
    chosen = percent * rows.filter(may).count() // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("_row")]
    drawn = ranked(rows.filter(may), order, folder)
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= chosen, F.col("rank")))
    rest = rows.filter(~may).withColumn("rank", F.lit(None).cast(T.LongType()))
    columns = [F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank", "n_words"]
    return drawn.select(*columns).unionByName(rest.select(*columns))
