"""Document quality by a linear-chain conditional random field over lines.

Method. Every line with a word gets features of its own (symbols, capitals, repeats ...) and those of
the lines before and after it. A two-state chain (bad, good) is trained on labelled documents, whose
label every line takes. Forward-backward marginals, weighted by line length, give a document's share
of good text, and a logistic curve fitted on the same documents turns that share into a probability.

The model is fitted on the driver from at most ``most_docs`` labelled documents, those that come first in
a hash order, as far as they have ``most_lines`` lines together; each is taken whole, and one of more than a
quarter of these lines is not learned from. The model is a few dozen numbers. Scoring covers every line.

Results. One row per input row: score and prediction. A null or blank text has no line and gets the
curve's value for an even share. Repeated rows get equal scores. Labels that are null or without a
document are not used; of several labels of a document the largest is. With no usable labels, or all
alike, every score is the smoothed share of label 1. An empty table gives no rows; columns other
than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyqa.llm.storage import shared_folder, ship, staged
from surveyqa.llm.words import BYTES, SPACE, Words, blocks, mix, span_hashes

DOCS, LINES, STEPS, RIDGE = 2000, 200_000, 80, 1e-3
LETTERS = [*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]
#: Kinds of bytes: capitals, digits, exclamation marks, bars, other ASCII signs, sentence ends.
KINDS = np.zeros((6, 256), bool)
KINDS[0, ord("A") : ord("Z") + 1] = True
KINDS[1, ord("0") : ord("9") + 1] = True
KINDS[2, ord("!")] = True
KINDS[3, ord("|")] = True
KINDS[4, list(b"#*$%&<>@^~_=+\\/{}[]`")] = True
KINDS[5, list(b".,;:?")] = True
WIDTH = len(KINDS) + 5


def line_features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, length in bytes and own features of each line with a word."""
    data, offsets = words.data, words.offsets
    breaks = np.flatnonzero(data == 0x0A)
    start = np.unique(np.concatenate((breaks + 1, offsets[:-1][np.diff(offsets) > 0])))
    start = start[start < len(data)]
    end = np.append(start[1:], len(data))[: len(start)]
    first, last = np.searchsorted(words.start, start), np.searchsorted(words.start, end)
    start, end, first, last = (x[last > first] for x in (start, end, first, last))
    row = np.searchsorted(offsets, start, "right") - 1
    inside = np.concatenate(([0], np.cumsum(~SPACE[data], dtype=np.int64)))
    size = inside[end] - inside[start]
    columns = []
    for kind in KINDS:
        total = np.concatenate(([0], np.cumsum(kind[data], dtype=np.int64)))
        columns.append((total[end] - total[start]) / size)
    again = np.zeros(len(words.hash), bool)
    for lag in (1, 2, 3):
        again[lag:] |= words.hash[lag:] == words.hash[:-lag]
    total = np.concatenate(([0], np.cumsum(again, dtype=np.int64)))
    count = last - first
    columns.append((total[last] - total[first]) / count)
    keys = span_hashes(data, BYTES, start, words.end[last - 1] if len(last) else end) ^ mix(row.astype(np.uint64))
    _, where, times = np.unique(keys, return_inverse=True, return_counts=True)
    columns.append(times[where] > 1)
    columns.append(np.minimum(size / count, 40) / 10)
    columns.append(np.log1p(size) / 10)
    columns.append(KINDS[5][data[words.end[last - 1] - 1]] if len(last) else np.zeros(0))
    return row + words.first, size, np.stack(columns, axis=1).astype(np.float64).reshape(-1, WIDTH)


def batch_lines(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [line_features(words) for words in blocks(column, lower=False)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros((0, WIDTH))
    return tuple(np.concatenate(x) for x in zip(*parts))


def with_neighbours(row: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Features of a line, of the ones before and after in the same document, and a constant."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = (row[1:] == row[:-1])[:, None]
    before[1:], after[:-1] = own[:-1] * same, own[1:] * same
    return np.hstack([own, before, after, np.ones((len(own), 1))])


@dataclass
class Chains:
    """Documents of several lines, longest first, walked one line position at a time."""

    starts: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, row: np.ndarray) -> Chains:
        starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
        lengths = np.diff(np.append(starts, len(row)))
        order = np.argsort(-lengths, kind="stable")
        return cls(starts[order], lengths[order])

    def positions(self) -> Iterator[np.ndarray]:
        """Lines at position 0, 1, ... of all documents that are so long."""
        at = np.searchsorted(-self.lengths, -np.arange(1, (self.lengths[0] if len(self.lengths) else 0) + 1), "right")
        for t, count in enumerate(at):
            yield self.starts[:count] + t


def forward_backward(chains: Chains, unary: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of each line (bad, good), and the expected moves between states."""
    psi = np.stack([np.ones(len(unary)), np.exp(np.clip(unary, -30, 30))], axis=1)
    alpha, beta = np.empty_like(psi), np.ones_like(psi)
    step, expected = np.exp(moves), np.zeros((2, 2))
    walk = list(chains.positions())
    for t, lines in enumerate(walk):
        own = psi[lines] if t == 0 else (alpha[lines - 1] @ step) * psi[lines]
        alpha[lines] = own / own.sum(axis=1, keepdims=True)
    for lines in reversed(walk[1:]):
        later = psi[lines] * beta[lines]
        pair = alpha[lines - 1][:, :, None] * step * later[:, None, :]
        expected += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back = later @ step.T
        beta[lines - 1] = back / back.sum(axis=1, keepdims=True)
    marginal = alpha * beta
    return marginal / marginal.sum(axis=1, keepdims=True), expected


def logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Newton steps of a ridge logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * len(y) * np.eye(x.shape[1])
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - ridge * len(y) * w)
    return w


@dataclass
class Model:
    weights: np.ndarray
    moves: np.ndarray
    curve: np.ndarray
    prior: float | None = None

    def share(self, row: np.ndarray, size: np.ndarray, own: np.ndarray, rows: int) -> np.ndarray:
        """Length-weighted marginal of good lines of each of ``rows`` documents."""
        good, _ = forward_backward(Chains.of(row), with_neighbours(row, own) @ self.weights, self.moves)
        whole = np.bincount(row, size, rows)
        part = np.bincount(row, size * good[:, 1], rows)
        return np.where(whole > 0, part / np.maximum(whole, 1), 0.5)

    def scores(self, row: np.ndarray, size: np.ndarray, own: np.ndarray, rows: int) -> np.ndarray:
        if self.prior is not None:
            return np.full(rows, self.prior)
        share = np.clip(self.share(row, size, own, rows), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-np.clip(curve_inputs(share) @ self.curve, -30, 30)))


def curve_inputs(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return np.stack([np.log(share / (1 - share)), np.ones(len(share))], axis=1)


def fitted(documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """The field and the curve from (line sizes, own features) of labelled documents."""
    ones = int(labels.sum())
    if not documents or ones in (0, len(labels)) or not sum(len(s) for s, _ in documents):
        return Model(np.zeros(0), np.zeros((2, 2)), np.zeros(2), (ones + 1) / (len(labels) + 2))
    lengths = np.array([len(s) for s, _ in documents])
    row, size = np.repeat(np.arange(len(documents)), lengths), np.concatenate([s for s, _ in documents])
    own = np.concatenate([x for _, x in documents])
    x, y, chains = with_neighbours(row, own), labels[row].astype(float), Chains.of(row)
    weights, moves = logistic(x, y, RIDGE), np.zeros((2, 2))
    same = row[1:] == row[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][same].astype(int), y[1:][same].astype(int)), 1)
    scale, first, second = len(y), 0.0, 0.0
    for k in range(1, STEPS + 1):  # Adam on the penalised likelihood
        marginal, expected = forward_backward(chains, x @ weights, moves)
        slope = np.concatenate([x.T @ (y - marginal[:, 1]) / scale - RIDGE * weights, ((seen - expected) / scale - RIDGE * moves).ravel()])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        change = 0.05 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
        weights, moves = weights + change[:-4], moves + change[-4:].reshape(2, 2)
    model = Model(weights, moves, np.zeros(2))
    model.curve = logistic(curve_inputs(model.share(row, size, own, len(documents))), labels.astype(float), 1e-4)
    return model


def sample_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: number, sizes and features of all lines of labelled documents."""
    for batch in batches:
        row, size, own = batch_lines(batch["text"])
        at = np.searchsorted(row, np.arange(batch.num_rows + 1))
        spans = list(zip(at[:-1], at[1:]))
        columns = [batch["doc_id"], batch["quality"], pa.array(np.diff(at), pa.int64())]
        columns += [pa.array([x[a:b].astype(np.float64).tobytes() for a, b in spans], pa.binary()) for x in (size, own)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", "lines", "size", "own"])


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", learn: Column | None = None,
    most_docs: int = DOCS, most_lines: int = LINES,
) -> Model:
    """The model from labelled documents; ``learn`` says which ids may be learned from.

    ``most_docs`` and ``most_lines`` bound what the driver receives and fits.
    """
    ship(docs.sparkSession)
    usable = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
    usable = (usable.filter(learn) if learn is not None else usable).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    usable = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    lines = texts.join(F.broadcast(usable), "doc_id").mapInArrow(sample_lines, "doc_id long, quality int, lines long, size binary, own binary")
    short = staged(lines.filter(F.col("lines") <= max(1, most_lines // 4)).dropDuplicates(["doc_id"]), shared_folder(docs.sparkSession), "lines")
    upto = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    chosen = short.select("doc_id", F.sum("lines").over(upto).alias("upto")).filter(F.col("upto") <= most_lines)  # most_docs rows
    rows = sorted(short.join(F.broadcast(chosen), "doc_id").collect(), key=lambda r: r.doc_id)
    documents = [(np.frombuffer(r.size), np.frombuffer(r.own).reshape(-1, WIDTH)) for r in rows]
    return fitted(documents, np.array([r.quality > 0 for r in rows], int))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``score`` and the columns of ``keep`` for every row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = model.scores(*batch_lines(batch[text_col]), batch.num_rows)
            kept = [batch[c] for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(values)], names=[*names, "quality_score"])

    names = list(dict.fromkeys([id_col, *keep]))
    chosen = docs.select(*dict.fromkeys([*names, text_col]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.select(*names).schema.fields)
    return chosen.mapInArrow(run, f"{schema}, quality_score double")


def good_documents(docs: DataFrame, labels: DataFrame, least: float, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose score is under ``least``."""
    kept = docs.columns
    named = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)])
    id_name, text_name = (named.columns[kept.index(c)] for c in (id_col, text_col))
    model = train(named, labels, id_name, text_name, learn)
    rows = scored(named, model, id_name, text_name, keep=tuple(named.columns))
    return rows.filter(F.col("quality_score") >= least).select(*named.columns).toDF(*kept)
