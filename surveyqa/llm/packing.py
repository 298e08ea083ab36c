"""Packing token sequences: linear grouping of long pieces, then best fit of short ones.

Method. Texts become token ids; those over ``capacity`` are cut. Only the histogram of piece lengths
(at most ``capacity`` numbers, whatever the input) reaches the driver, where the packing is worked out
for runs of pieces of one length: long lengths are rounded up within ``GROUPS`` groups of equal
cardinality; a linear program over the few rounded sizes, by column generation, says how many
sequences to fill by which configuration; real lengths take the places of rounded ones; what is left,
and all short pieces, goes by best fit in falling length into the smallest gap that holds it. Every
piece then finds its sequence by its length and its number among the pieces of that length.

Results. One row per piece. A null or blank text still has its end id (a blank one its white space).
A null id is kept as it is; repeated rows are packed once each. An empty table gives no rows; extra
columns are not read. Pieces are staged in the shared folder with the partition that made them, so
that numbers don't change when an executor is lost.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyqa.llm.storage import shared_folder, staged
from surveyqa.llm.tokens import encoder, spaced

CAPACITY, GROUPS = 2048, 128
#: Pieces of at most one part in SHORT of a sequence are short.
SHORT = 3
COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]


def pieces_of(vocabulary: str, capacity: int, end: int):
    """Task function: the pieces of every text, numbered within partition and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, closing = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), end.to_bytes(4, "little")
        encode = encoder(vocabulary, spaced).encode
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 256):
                chunk = batch.slice(at, 256)
                for doc_id, data in zip(chunk["doc_id"].to_pylist(), encode([t or "" for t in chunk["text"].to_pylist()])):
                    data += closing
                    count = len(data) // 4
                    start, length, piece = 0, (count - 1) % capacity + 1, 0
                    while start < count:
                        crc = zlib.crc32(memoryview(data)[4 * start : 4 * (start + length)])
                        rows.append((doc_id, piece, start, length, crc, part, int(seen[length])))
                        seen[length] += 1
                        start, length, piece = start + length, capacity, piece + 1
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=COLUMNS)

    return run


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often each is used: the linear program of cutting stock.

    Columns are found by a knapsack over at most capacity / smallest size pieces.
    """
    kinds, demand = len(sizes), np.array(counts, float)
    basis = np.diag([float(capacity // s) for s in sizes])
    use = demand / np.diag(basis)
    layers = capacity // min(sizes)
    for _ in range(40 * kinds):
        worth = np.linalg.solve(basis.T, np.ones(kinds))
        best, choice = np.zeros(capacity + 1), []
        for _ in range(layers):
            value, which = best.copy(), np.full(capacity + 1, -1)
            for g, s in enumerate(sizes):
                if worth[g] > 1e-12:
                    gain = best[: capacity + 1 - s] + worth[g]
                    better = gain > value[s:] + 1e-12
                    value[s:][better], which[s:][better] = gain[better], g
            choice.append(which)
            best = value
        if best[capacity] <= 1 + 1e-9:
            break
        column, room = np.zeros(kinds), capacity
        for which in reversed(choice):
            if which[room] >= 0:
                column[which[room]] += 1
                room -= sizes[which[room]]
        direction = np.linalg.solve(basis, column)
        ratio = np.where(direction > 1e-9, use / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(np.argmin(ratio))
        use = use - ratio[out] * direction
        use[out] = ratio[out]
        basis[:, out] = column
    return [(basis[:, k].astype(int), use[k]) for k in range(kinds)]


@dataclass
class Plan:
    """Where runs of pieces of one length go: (length, first number, pieces, first sequence, offset)."""

    capacity: int
    places: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    gaps: dict[int, list[tuple[int, int]]] = field(default_factory=lambda: defaultdict(list))
    sizes: list[int] = field(default_factory=list)

    def free(self, gap: int, first: int, count: int) -> None:
        if gap and count:
            if not self.gaps[gap]:
                insort(self.sizes, gap)
            self.gaps[gap].append((first, count))

    def opened(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def configured(self, slots: list[list[tuple[int, int, int]]], count: int) -> None:
        """``count`` sequences whose slots hold the given runs (length, number, pieces)."""
        first, at = self.opened(count), [0] * len(slots)
        left, done = [list(s[0]) for s in slots], 0
        while done < count:
            step, offset = min(x[2] for x in left), 0
            for k, run in enumerate(left):
                self.places.append((run[0], run[1], step, first + done, offset))
                offset += run[0]
                run[1], run[2] = run[1] + step, run[2] - step
                if not run[2] and done + step < count:
                    at[k] += 1
                    left[k] = list(slots[k][at[k]])
            self.free(self.capacity - offset, first + done, step)
            done += step

    def best_fit(self, length: int, number: int, count: int) -> None:
        while count:
            k = bisect_left(self.sizes, length)
            if k == len(self.sizes):
                bins = -(-count // (self.capacity // length))
                self.free(self.capacity, self.opened(bins), bins)
                continue
            gap = self.sizes[k]
            first, bins = self.gaps[gap].pop()
            if not self.gaps[gap]:
                self.sizes.pop(k)
            each = gap // length
            taken = min(bins, count // each)
            if not taken:
                each, taken = count, 1
            for j in range(each):
                self.places.append((length, number + j * taken, taken, first, self.capacity - gap + j * length))
            number, count = number + each * taken, count - each * taken
            self.free(gap - each * length, first, taken)
            self.free(gap, first + taken, bins - taken)


def planned(histogram: dict[int, int], capacity: int) -> Plan:
    """The packing of ``histogram[length]`` pieces of every length."""
    plan, rest = Plan(capacity), []
    if histogram.get(capacity):
        plan.configured([[(capacity, 0, histogram[capacity])]], histogram[capacity])
    long = [(length, histogram[length]) for length in sorted(histogram, reverse=True) if capacity // SHORT < length < capacity]
    total, groups = sum(c for _, c in long), []
    share = max(1, -(-total // GROUPS))
    for length, count in long:  # equal groups; equal rounded sizes are one group
        number = 0
        while number < count:
            if not groups or (groups[-1][1] >= share and groups[-1][0] != length):
                groups.append([length, 0, []])
            size, held, runs = groups[-1]
            step = count - number if size == length else min(count - number, share - held)
            runs.append((length, number, step))
            groups[-1][1], number = held + step, number + step
    if groups:
        queues = [list(reversed(g[2])) for g in groups]

        def take(g: int, count: int) -> list[tuple[int, int, int]]:
            runs = []
            while count:
                length, number, size = queues[g].pop()
                step = min(size, count)
                runs.append((length, number, step))
                if size > step:
                    queues[g].append((length, number + step, size - step))
                count -= step
            return runs

        for column, use in configurations([g[0] for g in groups], [g[1] for g in groups], capacity):
            left = [sum(r[2] for r in queues[g]) // n for g, n in enumerate(column) if n]
            count = min([int(use + 1e-9), *left])
            if count:
                plan.configured([take(g, count) for g, n in enumerate(column) for _ in range(n)], count)
        rest = [run for queue in queues for run in reversed(queue)]
    for run in sorted(rest, reverse=True):
        plan.best_fit(*run)
    for length in range(min(capacity - 1, capacity // SHORT), 0, -1):
        if histogram.get(length):
            plan.best_fit(length, 0, histogram[length])
    return plan


def packed(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = 0
) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``; see the module."""
    folder = shared_folder(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"
    pieces = staged(texts.mapInArrow(pieces_of(vocabulary, capacity, end), schema), folder, "pieces")
    counts = staged(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), folder, "counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    numbers = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = np.array(sorted(planned(histogram, capacity).places), np.int64).reshape(-1, 5)
    keys = (places[:, 0] << 44) + places[:, 1]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch["length"].to_numpy(), batch["number"].to_numpy()
            place = places[np.searchsorted(keys, (length << 44) + number, "right") - 1]
            sequence = place[:, 3] + number - place[:, 1]
            columns = [batch[c] for c in COLUMNS[:5]] + [pa.array(sequence), pa.array(place[:, 4].copy())]
            yield pa.RecordBatch.from_arrays(columns, names=[*COLUMNS[:5], "sequence_id", "offset"])

    numbered = pieces.join(numbers, ["length", "part"]).select(*COLUMNS[:5], (F.col("before") + F.col("nth")).alias("number"))
    return numbered.mapInArrow(
        placed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
