"""Interpolated modified Kneser-Ney model, counted in Spark and looked up in memory-mapped arrays.

Method. Tasks count the words and word pairs of training texts as hashes and hand them, packed, to shards: a
pair to the shard of its first word. A pair shard sums its pairs, which gives the pair counts and, for each
first word, its total and its numbers of followers seen once, twice and more often; how many different words
come before a word goes on to the word shards. Each shard is a file of arrays sorted by hash in the shared
folder. Scoring maps these files into memory and looks up the distinct words and pairs of many texts at
a time, in order. The order of the model is two: longer n-grams are the same again, at the cost of one
more shuffle of all texts' n-grams.

Probability of w after c: (n(cw) - D(n(cw))) / n(c) + g(c) P(w); P(w) discounts the number of different words
before w in the same way and falls back to the uniform 1 / (V + 1). D are the three discounts of each level,
g(c) what the discounts leave over. After an unseen c it is P(w).

Results. One row per input row. A null or blank text has one token, the end. Words are 64-bit hashes; a pair is
known by 40 bits of either word, and found by all 64 bits of its hash, so that an unseen pair is taken for
a seen one about once in 2^64 / (pairs of a shard) lookups. A null id is held out. With no training
text the probabilities are uniform. Repeated rows count as often as they come. An empty table gives no rows; extra columns
are not read. Shards need a shared folder that is mounted on all hosts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyqa.llm.storage import mounted, shared_folder, staged, write_file
from surveyqa.llm.words import BASE, Words, blocks, mix

#: Tokens counted, and looked up, at once.
COUNTED = 1 << 20
END, BEGIN = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
LOW40 = np.uint64((1 << 40) - 1)
LARGE = 255


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token before, token and row: the words of each row, then its end."""
    rows = words.last - words.first
    now = np.full(len(words.hash) + rows, END, np.uint64)
    now[np.arange(len(words.hash)) + words.row] = words.hash
    row = np.repeat(np.arange(rows), np.diff(words.bounds()) + 1)
    before = np.empty_like(now)
    before[1:] = now[:-1]
    before[np.searchsorted(row, np.arange(rows))] = BEGIN
    return before, now, row + words.first


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes & LOW40) % np.uint64(shards)).astype(np.int32)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts.astype(np.int64), first)


def summed_pairs(before: np.ndarray, now: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of 40-bit words sorted by the first, and the sums of their counts."""
    if not len(before):
        return before, now, counts.astype(np.int64)
    order = np.argsort(pair_hash(before, now), kind="stable")
    order = order[np.argsort(before[order], kind="stable")]
    before, now, counts = before[order], now[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], (before[1:] != before[:-1]) | (now[1:] != now[:-1]))))
    return before[first], now[first], np.add.reduceat(counts.astype(np.int64), first)


def pair_hash(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(BASE) + now)


def planes(values: np.ndarray, size: int) -> bytes:
    """The low ``size`` bytes of each number, byte by byte: sorted numbers compress well so."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def from_planes(data: bytes, size: int, count: int) -> np.ndarray:
    whole = np.zeros((count, 8), np.uint8)
    whole[:, :size] = np.frombuffer(data, np.uint8).reshape(size, count).T
    return whole.view("<u8").ravel()


def pack(columns: list[tuple[np.ndarray, int]]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes(v, s) for v, s in columns))


def unpack(data: bytes, sizes: list[int], count: int) -> list[np.ndarray]:
    whole, at, found = zstandard.ZstdDecompressor().decompress(data), 0, []
    for size in sizes:
        found.append(from_planes(whole[at : at + size * count], size, count))
        at += size * count
    return found


PACKED = "kind int, shard int, n long, data binary"
#: Bytes of the columns of each kind: words and counts; pairs and counts; words and numbers of words before.
SIZES = {0: [8, 5], 1: [5, 5, 5], 2: [5, 5]}


def packed_rows(kind: int, shard: np.ndarray, columns: list[np.ndarray], shards: int) -> Iterator[tuple]:
    order = np.argsort(shard, kind="stable")
    at = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(at)):
        own = order[at[s] : at[s + 1]]
        yield kind, int(s), len(own), pack([(c[own], size) for c, size in zip(columns, SIZES[kind])])


def packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["kind", "shard", "n", "data"])


def counted(shards: int, kind: int):
    """Task function: words (kind 0) or pairs (kind 1) of the task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            before, now = (np.concatenate(x) for x in zip(*held))
            ones = np.ones(len(now), np.int64)
            columns = list(summed_pairs(before & LOW40, now & LOW40, ones) if kind else summed(now, ones))
            yield packed_batch(list(packed_rows(kind, shard_of(columns[0], shards), columns, shards)))

        for batch in batches:
            for words in blocks(batch["text"], lower=True):
                before, now, _ = tokens(words)
                held.append((before, now))
                size += len(now)
                if size >= COUNTED:
                    yield from flushed()
                    held, size = [], 0
        if held:
            yield from flushed()

    return run


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[np.ndarray]]]]:
    """Each shard of a task, whose rows are sorted by shard, with its columns by kind."""
    shard, parts = None, {}

    def whole() -> dict[int, list[np.ndarray]]:
        return {k: [np.concatenate(c) for c in zip(*p)] for k, p in parts.items()}

    for batch in batches:
        for kind, own, n, data in zip(*(batch[c].to_pylist() for c in ("kind", "shard", "n", "data"))):
            if own != shard:
                if parts:
                    yield shard, whole()
                shard, parts = own, {}
            parts.setdefault(kind, []).append(unpack(data, SIZES[kind], n))
    if parts:
        yield shard, whole()


def of_counts(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


def with_large(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts in one byte; where they don't fit, their places and values."""
    large = np.flatnonzero(counts >= LARGE)
    return np.minimum(counts, LARGE).astype(np.uint8), large.astype("<u8"), counts[large].astype("<u8")


def write_arrays(path: str, arrays: list[np.ndarray]) -> None:
    """Arrays of one file: their number of bytes, then each from a multiple of 8 on."""
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], "<u8").tobytes()
    write_file(path, head + b"".join(a.tobytes() + bytes(-a.nbytes % 8) for a in arrays))


def map_arrays(path: str, types: list[str]) -> list[np.ndarray]:
    data = np.memmap(path, np.uint8, "r")
    count = int(data[:8].view("<u8")[0])
    sizes, at, arrays = data[8 : 8 + 8 * count].view("<u8").tolist(), 8 + 8 * count, []
    for size, kind in zip(sizes, types):
        arrays.append(data[at : at + size].view(kind))
        at += size + (-size % 8)
    return arrays


PAIR_ARRAYS = ["<u8", "u1", "<u8", "<u8", "<u8", "<u8", "<u4", "<u4", "<u4"]
WORD_ARRAYS = ["<u8", "<u8", "<u8"]
FACTS = ["kind", "shard", "types", "total", "c1", "c2", "c3", "c4", "data"]


def pair_shards(folder: str, shards: int):
    """Task function: writes the pair shards; gives their numbers and, for words, the words before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, kinds in gathered(batches):
            before, now, counts = summed_pairs(*kinds[1])
            contexts, first = np.unique(before, return_index=True)
            total = np.add.reduceat(counts, first)
            seen = [np.add.reduceat((counts == k) if k < 3 else (counts >= 3), first, dtype=np.int64) for k in (1, 2, 3)]
            hashes = pair_hash(before, now)
            order = np.argsort(hashes, kind="stable")
            hashes, own = hashes[order], counts[order]
            small, large, values = with_large(own)
            write_arrays(f"{folder}/pairs/{shard:06d}", [
                hashes, small, large, values,
                contexts, total.astype("<u8"), *[s.astype("<u4") for s in seen],
            ])
            rows = [(1, shard, len(counts), int(counts.sum()), *of_counts(counts), None)]
            words, times = summed(now, np.ones(len(now), np.int64))
            rows += [(2, s, n, 0, 0, 0, 0, 0, data) for _, s, n, data in packed_rows(2, shard_of(words, shards), [words, times], shards)]
            yield fact_batch(rows)

    return run


def word_shards(folder: str):
    """Task function: writes the word shards: counts, and numbers of different words before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, kinds in gathered(batches):
            words, counts = summed(*kinds[0])
            low, times = summed(*kinds[2])
            before = times[np.searchsorted(low, words & LOW40)]
            write_arrays(f"{folder}/words/{shard:06d}", [words, counts.astype("<u8"), before.astype("<u8")])
            yield fact_batch([
                (0, shard, len(words), int(counts.sum()), 0, 0, 0, 0, None), (3, shard, len(words), int(before.sum()), *of_counts(before), None),
            ])

    return run


def fact_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), *[pa.int64()] * 6, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=FACTS)


FACT_SCHEMA = "kind int, shard int, types long, total long, c1 long, c2 long, c3 long, c4 long, data binary"


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """The discounts of counts 0, 1, 2 and 3 or more; common values where counts of counts are missing."""
    if not (n1 and n2 and n3 and n4):
        return np.array([0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    return np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], [0, 0.05, 0.05, 0.05], [0, 1, 2, 3])


class Model:
    """The model in a mounted folder; ``scored`` looks up many texts at a time."""

    def __init__(self, folder: str, shards: int, facts: dict[int, tuple]) -> None:
        none = (0, 0, 0, 0, 0, 0)
        self.folder, self.shards = folder, shards
        self.vocabulary, self.train_tokens = facts.get(0, none)[:2]
        self.of_pair, self.of_word = discounts(*facts.get(1, none)[2:]), discounts(*facts.get(3, none)[2:])
        types, self.pair_types, *few = facts.get(3, none)
        left = self.of_word[1:] @ np.array([few[0], few[1], types - few[0] - few[1]], float)
        self.word_rest = left / self.pair_types if self.pair_types else 1.0
        self.open: dict[str, list[np.ndarray]] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "open": {}}

    def arrays(self, kind: str, shard: int, types: list[str]) -> list[np.ndarray] | None:
        path = f"{self.folder}/{kind}/{shard:06d}"
        if path not in self.open:
            try:
                self.open[path] = map_arrays(path, types)
            except FileNotFoundError:  # a shard without words
                self.open[path] = None
        return self.open[path]

    def by_shard(self, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        shard = shard_of(hashes, self.shards)
        order = np.argsort(shard, kind="stable")
        at = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(at)):
            yield int(s), order[at[s] : at[s + 1]]

    def words(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of sorted distinct words, and of different words before them."""
        counts, before = np.zeros((2, len(words)))
        for shard, own in self.by_shard(words):
            found = self.arrays("words", shard, WORD_ARRAYS)
            if found:
                at = np.minimum(np.searchsorted(found[0], words[own]), len(found[0]) - 1)
                known = found[0][at] == words[own]
                counts[own], before[own] = found[1][at] * known, found[2][at] * known
        return counts, before

    def pairs(self, before: np.ndarray, now: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of pairs, totals of their first words, and what the discounts leave over there."""
        counts, totals, rest = np.zeros((3, len(before)))
        for shard, own in self.by_shard(before):
            found = self.arrays("pairs", shard, PAIR_ARRAYS)
            if not found:
                continue
            known, small, large, values, contexts, total, *seen = found
            hashes = pair_hash(before[own], now[own])
            order = np.argsort(hashes)
            place = np.minimum(np.searchsorted(known, hashes[order]), len(known) - 1)
            hit = known[place] == hashes[order]
            count = small[place] * hit.astype(float)
            big = np.flatnonzero(count == LARGE)
            if len(big):
                count[big] = values[np.searchsorted(large, place[big])]
            counts[own[order]] = count
            at = np.minimum(np.searchsorted(contexts, before[own]), len(contexts) - 1)
            met = contexts[at] == before[own]
            totals[own] = total[at] * met
            rest[own] = sum(d * s[at] for d, s in zip(self.of_pair[1:], seen)) * met
        return counts, totals, rest

    def scored(self, before: np.ndarray, now: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Known, base score and log10 probability of every token."""
        words, where = np.unique(now, return_inverse=True)
        counts, preceded = self.words(words)
        base = np.log10((counts + 0.1) / (self.train_tokens + 0.1 * (self.vocabulary + 1)))
        uniform = 1 / (self.vocabulary + 1)
        kept = np.maximum(preceded - self.of_word[np.minimum(preceded, 3).astype(int)], 0)
        lower = (kept / self.pair_types if self.pair_types else kept) + self.word_rest * uniform
        first, second = before & LOW40, now & LOW40
        _, one, back = np.unique(pair_hash(first, second), return_index=True, return_inverse=True)
        count, total, rest = self.pairs(first[one], second[one])
        safe = np.maximum(total, 1)
        kept = np.maximum(count - self.of_pair[np.minimum(count, 3).astype(int)], 0) / safe
        share = np.where(total > 0, rest / safe, 1.0)
        return counts[where] > 0, base[where], np.log10(kept[back] + share[back] * lower[where])


def trained(docs: DataFrame, learn: Column, folder: str, text_col: str = "text") -> Model:
    """Count the texts for which ``learn`` holds and write the model's shards below ``folder``."""
    spark, place = docs.sparkSession, mounted(folder)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = 2 * parts
    texts = docs.filter(learn).select(F.col(text_col).cast("string").alias("text"))
    words, pairs = (texts.mapInArrow(counted(shards, kind), PACKED) for kind in (0, 1))
    deal = lambda df: df.repartition(parts, "shard").sortWithinPartitions("shard")
    pairs = staged(deal(pairs).mapInArrow(pair_shards(place, shards), FACT_SCHEMA), folder, "pair-facts")
    before = pairs.filter("kind = 2").select("kind", "shard", F.col("types").alias("n"), "data")
    words = staged(deal(words.union(before)).mapInArrow(word_shards(place), FACT_SCHEMA), folder, "word-facts")
    facts = pairs.filter("kind = 1").drop("data").union(words.drop("data")).groupBy("kind").agg(
        *[F.sum(c).alias(c) for c in FACTS[2:-1]]
    )
    return Model(place, shards, {r.kind: tuple(r)[1:] for r in facts.collect()})


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            totals = np.zeros((4, batch.num_rows))

            def flushed() -> None:
                before, now, row = (np.concatenate(x) for x in zip(*held))
                for k, value in enumerate((np.ones(len(row)), *model.scored(before, now))):
                    totals[k] += np.bincount(row, value, batch.num_rows)

            for words in blocks(batch["text"], lower=True):
                held.append(tokens(words))
                size += len(held[-1][1])
                if size >= COUNTED:
                    flushed()
                    held, size = [], 0
            if held:
                flushed()
            columns = [batch["doc_id"], *[pa.array(t.astype(np.int64)) for t in totals[:2]], *map(pa.array, totals[2:])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def language_scores(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows for which ``learn`` holds; score every row."""
    model = trained(docs, learn, shared_folder(docs.sparkSession), text_col)
    return scored(docs, model, id_col, text_col).withColumn("train_tokens", F.lit(model.train_tokens).cast("long"))
