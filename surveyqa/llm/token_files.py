"""Token ids in binary shards: every document compressed by itself with one shared dictionary.

Method. A zstandard dictionary is trained on the serialized ids of at most ``SAMPLE`` documents, those
that come first in a hash order, and of each at most ``SAMPLE_BYTES``; everything else covers all documents. The
documents are range-partitioned and sorted by id; each task encodes its documents, compresses each one
with the dictionary and writes one shard: header (with the dictionary's hash), compressed documents,
index (id, offset, length, tokens), footer. A short document is read by its index entry alone.

Shard layout, little-endian: ``MAGIC``; bytes per id (1 byte); SHA-256 of the dictionary (32 bytes); the
documents; for each document id, offset, compressed length, tokens (int64 each); for each document
one byte, 1 if its id is null; index offset and number of documents (int64 each); ``MAGIC``.

Results. Documents in ascending id order, null ids first, equal ids by text. A null or blank text has
its end id only. Repeated rows are written once each. An empty table gives no rows; extra columns
are not read. A task that runs twice replaces its shard as a whole. Shards need a shared folder that
is mounted on all hosts.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from surveyqa.llm.storage import mounted, shared_folder, staged, write_file
from surveyqa.llm.tokens import encoder, plain

MAGIC = b"SQTOKEN1"
HEADER = len(MAGIC) + 1 + 32
SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES, LEVEL = 1000, 1 << 15, 1 << 16, 3


def narrowed(data: bytes, width: int) -> bytes:
    """Ids of 4 bytes as ids of ``width`` bytes."""
    return data if width == 4 else np.frombuffer(data, "<u4").astype("<u2").tobytes()


def widened(data: bytes, width: int) -> bytes:
    return data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def width_of(vocabulary: str, end: int, wanted: int | None = None) -> int:
    """Bytes per id that hold all ids of a vocabulary and the end id."""
    largest = max(end, *Tokenizer.from_file(vocabulary).get_vocab(with_added_tokens=True).values())
    least = 2 if largest < 1 << 16 else 4
    if wanted is not None and (wanted not in (2, 4) or wanted < least):
        raise ValueError(f"ids up to {largest} don't fit {wanted} bytes")
    return wanted or least


def dictionary_of(samples: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples, their content itself."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Shard:
    """Random access to a shard."""

    def __init__(self, path: str) -> None:
        self.file = open(path, "rb")  # noqa: SIM115
        head = self.file.read(HEADER)
        self.width, digest = head[len(MAGIC)], head[len(MAGIC) + 1 :]
        self.file.seek(-16 - len(MAGIC), os.SEEK_END)
        tail = self.file.read()
        if head[: len(MAGIC)] != MAGIC or tail[16:] != MAGIC:
            raise ValueError(f"{path} is no whole shard")
        at, self.count = np.frombuffer(tail[:16], "<i8").tolist()
        self.file.seek(at)
        self.index = np.frombuffer(self.file.read(32 * self.count), "<i8").reshape(-1, 4)
        self.null = np.frombuffer(self.file.read(self.count), np.uint8)
        with open(f"{os.path.dirname(path)}/{digest.hex()}.dictionary", "rb") as source:
            dictionary = source.read()
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError(f"{path}: its dictionary has changed")
        self.unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def ids(self, k: int) -> bytes:
        """Ids of the shard's k-th document as unsigned 32-bit integers."""
        _, offset, length, tokens = self.index[k].tolist()
        self.file.seek(offset)
        return widened(self.unpack.decompress(self.file.read(length), max_output_size=max(1, tokens * self.width)), self.width)

    def of(self, doc_id: int) -> bytes:
        """Ids of a document by its id."""
        first = int(self.null.sum())
        k = first + int(np.searchsorted(self.index[first:, 0], doc_id))
        if k == self.count or self.index[k, 0] != doc_id:
            raise KeyError(doc_id)
        return self.ids(k)


def encode_texts(vocabulary: str, texts: list[str | None], end: int) -> list[bytes]:
    closing = end.to_bytes(4, "little")
    return [data + closing for data in encoder(vocabulary, plain).encode([t or "" for t in texts])]


def writer(vocabulary: str, folder: str, dictionary: bytes, width: int, end: int):
    """Task function: one shard of the task's documents; gives its number, documents and tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, index, null, out = TaskContext.get().partitionId(), [], [], None
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))
        path = f"{folder}/{number:06d}.tokens"
        temporary = f"{path}.{uuid.uuid4().hex}"
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                chunk = batch.slice(at, 256)
                if out is None:
                    out = open(temporary, "wb")  # noqa: SIM115
                    out.write(MAGIC + bytes([width]) + hashlib.sha256(dictionary).digest())
                for doc_id, data in zip(chunk["doc_id"].to_pylist(), encode_texts(vocabulary, chunk["text"].to_pylist(), end)):
                    packed = pack.compress(narrowed(data, width))
                    index.append((doc_id or 0, out.tell(), len(packed), len(data) // 4))
                    null.append(doc_id is None)
                    out.write(packed)
        if out is not None:
            at = out.tell()
            entries = np.array(index, "<i8")
            out.write(entries.tobytes() + np.array(null, np.uint8).tobytes())
            out.write(np.array([at, len(index)], "<i8").tobytes() + MAGIC)
            out.close()
            os.replace(temporary, path)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([len(index)]), pa.array([int(entries[:, 3].sum())])], names=["shard", "documents", "tokens"]
            )

    return run


def reader(folder: str):
    """Task function: every document of the given shards, read back from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, start in zip(batch["shard"].to_pylist(), batch["before"].to_pylist()):
                shard, crcs = Shard(f"{folder}/{number:06d}.tokens"), []
                tokens = np.zeros(shard.count, np.int64)
                for k in range(shard.count):
                    data = shard.ids(k)
                    tokens[k] = len(data) // 4
                    crcs.append(zlib.crc32(data))
                ids = pa.array(shard.index[:, 0].copy(), mask=shard.null.astype(bool))
                columns = [ids, pa.array(start + np.cumsum(tokens) - tokens), pa.array(tokens), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def write_tokens(
    docs: DataFrame, folder: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end: int = 2, width: int | None = None,
    samples: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """Write the shards and the dictionary below ``folder``; gives the shards' numbers and sizes.

    Ids take two bytes where the vocabulary's and ``end`` fit, else four; a ``width`` that they don't fit is
    refused. The dictionary is trained on ``samples`` documents, ``sample_bytes`` of each; of too few to train on, it is
    their content itself.
    """
    spark, place = docs.sparkSession, mounted(folder)
    width = width_of(vocabulary, end, width)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chosen = texts.select("doc_id").filter("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(samples)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [narrowed(x, width)[:sample_bytes] for x in encode_texts(vocabulary, batch["text"].to_pylist(), end)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(data, pa.binary())], names=["doc_id", "ids"])

    sample = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(sampled, "doc_id long, ids binary").groupBy("doc_id").agg(F.min("ids").alias("ids"))
    dictionary = dictionary_of([bytes(r.ids) for r in sample.orderBy("doc_id").collect()])
    write_file(f"{place}/{hashlib.sha256(dictionary).hexdigest()}.dictionary", dictionary)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    written = ordered.mapInArrow(writer(vocabulary, place, dictionary, width, end), "shard long, documents long, tokens long")
    return staged(written, folder, "shards")


def read_tokens(shards: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document, from the files."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))
    parts = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(parts, "shard").mapInArrow(
        reader(mounted(folder)), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write all documents to the shared folder and read them back."""
    folder = shared_folder(docs.sparkSession)
    return read_tokens(write_tokens(docs, folder, vocabulary), folder)
