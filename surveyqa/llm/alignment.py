"""Token alignment between two vocabularies: groups of ids that cover the same bytes, and their links.

Method. A text is encoded by both vocabularies. Every token's bytes are known, so each side has its
cumulative ends. A dictionary from end to index on each side, the intersection of their key sets and its
sorted keys slice both id lists into groups. No token is without bytes, so that exactly one token of each
side ends where a slice does: a slice expands to one link, its last token on the left and on the right.

Links are counted over the whole corpus without a shuffle of links: texts come in blocks of about ``BLOCK``
bytes, or of one longer text; a block keeps its distinct id pairs once and each link as an index into them.
Pairs are counted and rated by joins, and every block gets the rates of its own pairs back. A pair that is
in all texts is one row a block, so no key is hot, and no task holds more than a block.

Results. One row per input row. Texts that are null or empty, or whose bytes one of the vocabularies does
not give back, have no tokens: zeros and an empty digest. Repeated rows count as often as they are there.
Ties among a right token's pairs are all highest. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from surveyqa.llm.storage import shared_folder, staged
from surveyqa.llm.tokens import BYTE_LETTERS, COMMON, KEPT_BYTES, ODD_BLANKS, WHITE, Encoder, Memory, spaced

#: Bytes of text in a block, and in what is encoded at once.
BLOCK, CHUNK = 4 << 20, 1 << 19
#: A pair is its left id in the high bits and its right id in these low ones.
RIGHT_BITS = 32
#: How byte-level vocabularies cut a text before they merge.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A blank after other white space, or at the end, and where a text may be cut.
AFTER_WHITE = re.compile(f"[{WHITE}] | \\Z")
CUT = re.compile(f"(?<=[^{WHITE}])(?= [^{WHITE}])")


@lru_cache(maxsize=4)
def left_bytes(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary."""
    byte = {letter: b for b, letter in BYTE_LETTERS.items()}
    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    found = [b""] * (max(vocabulary.values()) + 1)
    for entry, number in vocabulary.items():
        found[number] = bytes(byte[c] for c in entry)
    return found


@lru_cache(maxsize=4)
def ranked_encoding(path: str) -> tiktoken.Encoding | None:
    """The left vocabulary for a library that merges by rank alone: the same ids, several times faster.

    None unless every merge makes the next id after the single bytes; only texts of common letters go
    through it, which both libraries' patterns cut alike.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    entries, singles = left_bytes(path), len(BYTE_LETTERS)
    if any(model["vocab"].get(a + b) != singles + k for k, (a, b) in enumerate(merges)) or any(len(e) != 1 for e in entries[:singles]):
        return None
    ranks = {entry: k for k, entry in enumerate(entries[: singles + len(merges)])}
    return tiktoken.Encoding(path, pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def right_model(path: str) -> tuple[sentencepiece.SentencePieceProcessor, list[bytes]]:
    """A model of pieces and the bytes of each id: blanks for its marks, one byte for a byte's piece."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        bytes([int(piece[3:5], 16)]) if model.is_byte(k) else piece.replace("▁", " ").encode()
        for k, piece in enumerate(map(model.id_to_piece, range(model.get_piece_size())))
    ]
    return model, pieces


def slices(left_ends: list[int], right_ends: list[int]) -> tuple[list[int], list[int]]:
    """Where the groups stop in each of two id lists, from the cumulative ends of their tokens."""
    left, right = dict(zip(left_ends, range(1, len(left_ends) + 1))), dict(zip(right_ends, range(1, len(right_ends) + 1)))
    common = sorted(left.keys() & right.keys())
    return [left[end] for end in common], [right[end] for end in common]


def shown(left: list[int], right: list[int], stops: tuple[list[int], list[int]]) -> list[str]:
    """Each group as text: ids joined by commas, the sides by a bar."""
    parts, i, j = [], 0, 0
    for i_stop, j_stop in zip(*stops):
        if i_stop - i == j_stop - j == 1:
            parts.append(f"{left[i]}|{right[j]}")
        else:
            parts.append(f"{','.join(map(str, left[i:i_stop]))}|{','.join(map(str, right[j:j_stop]))}")
        i, j = i_stop, j_stop
    return parts


#: Of a stretch of text: tokens on each side, groups as text, and the pairs of all links as 64-bit integers.
Stretch = tuple[int, int, str, bytes]


class Aligner:
    """Aligned ids of texts by two vocabularies.

    No token of either vocabulary goes on behind a character that a single blank and a further character
    follow: the left one's pattern cuts there, and the right one has no piece with a mark after another
    character. So a text is aligned stretch by stretch, and a worker remembers the stretches of late. A text
    in which some stretch does not come back from its tokens is looked at as a whole.
    """

    def __init__(self, left: str, right: str, kept: int = KEPT_BYTES) -> None:
        self.encoder, self.left, self.ranks = Encoder(left, spaced, kept // 8), left_bytes(left), ranked_encoding(left)
        self.model, self.right = right_model(right)
        if any("\u2581" in piece.lstrip("\u2581") for piece in map(self.model.id_to_piece, range(self.model.get_piece_size()))):
            raise ValueError(f"{right}: a piece goes on behind a blank")
        self.known = Memory(kept)

    def left_ids(self, texts: list[str]) -> list[int]:
        """Ids of some texts that follow one another."""
        if self.ranks is not None and all(map(COMMON.fullmatch, texts)):
            return self.ranks.encode_ordinary("".join(texts))
        return array("I", b"".join(self.encoder.encode(texts))).tolist()

    def stretches(self, texts: list[str]) -> list[Stretch | None]:
        """Each of some texts that begin with a blank; None where it does not come back from its tokens.

        All of them are aligned at once, as one text: each ends with a token on both sides.
        """
        whole = [t.encode() for t in texts]
        left, right = self.left_ids(texts), list(chain.from_iterable(self.model.encode([t[1:] for t in texts], num_threads=1)))
        left_tokens, right_tokens = [self.left[k] for k in left], [self.right[k] for k in right]
        if not b"".join(left_tokens) == b"".join(right_tokens) == b"".join(whole):
            return [None] if len(texts) == 1 else [found for t in texts for found in self.stretches([t])]
        left_ends, right_ends = list(accumulate(map(len, left_tokens))), list(accumulate(map(len, right_tokens)))
        stops = slices(left_ends, right_ends)
        groups = shown(left, right, stops)
        pairs = array("q", [left[i - 1] << RIGHT_BITS | right[j - 1] for i, j in zip(*stops)]).tobytes()
        number = {left_ends[i - 1]: k for k, i in enumerate(stops[0], 1)}
        found, g, i, j = [], 0, 0, 0
        for end in accumulate(map(len, whole)):
            stop = number[end]
            i_stop, j_stop = stops[0][stop - 1], stops[1][stop - 1]
            found.append((i_stop - i, j_stop - j, ";".join(groups[g:stop]), pairs[8 * g : 8 * stop]))
            g, i, j = stop, i_stop, j_stop
        return found

    def aligned(self, texts: list[str]) -> Iterator[tuple[int, int, str, np.ndarray]]:
        """Per text: tokens on each side, the groups' digest, and the pair of every link."""
        self.known.turn()
        cut = [stretches_of(" " + t) if t else [] for t in texts]
        known, early = self.known.late, self.known.early
        new = []
        for text in set().union(*cut).difference(known) if cut else ():
            if text in early:
                found = early[text]
                self.known.add(text, found, 0 if found is None else 150 + len(found[2]) + len(found[3]))
            else:
                new.append(text)
        # Common ones apart, so that a rare letter doesn't send all of them the slow way.
        new.sort(key=lambda t: COMMON.fullmatch(t) is None)
        common = bisect_left(new, True, key=lambda t: COMMON.fullmatch(t) is None)
        for some in filter(None, (new[:common], new[common:])):
            for text, found in zip(some, self.stretches(some)):
                self.known.add(text, found, 0 if found is None else 150 + len(found[2]) + len(found[3]))
        for text, parts in zip(texts, cut):
            own = [known[p] for p in parts]
            if None in own:
                own = self.stretches([" " + text])
            if not own or own == [None]:
                yield 0, 0, "", np.zeros(0, np.int64)
                continue
            left, right, groups, pairs = zip(*own)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            yield sum(left), sum(right), digest, np.frombuffer(b"".join(pairs), np.int64)


def stretches_of(text: str) -> list[str]:
    """Stretches of a text that begins with a blank, cut before each blank between two other characters."""
    if ODD_BLANKS.search(text) or AFTER_WHITE.search(text):
        return CUT.split(text)
    return [" " + word for word in text[1:].split(" ")]


DOCUMENT = "n_a long, n_b long, groups_sha256 string, links binary"


def aligned_blocks(docs: DataFrame, left: str, right: str) -> DataFrame:
    """One row per text with its links as indexes, and one per block with its distinct pairs and their counts."""
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"block long, id {kind}, {DOCUMENT}, pairs array<long>, counts array<long>"

    def chunks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str], int]]:
        """Ids and texts of at most about ``CHUNK`` bytes, or of one longer text."""
        ids, texts, size = [], [], 0
        for row, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
            ids.append(row)
            texts.append(text or "")
            size += len(texts[-1])
            if size >= CHUNK:
                yield ids, texts, size
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts, size

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, own = Aligner(left, right), TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        held = 0

        def finished() -> pa.RecordBatch:
            every = np.concatenate([r[4] for r in rows])
            pairs, index, counts = np.unique(every, return_inverse=True, return_counts=True)
            cuts = np.cumsum([len(r[4]) for r in rows])[:-1]
            links = [part.astype(np.int32).tobytes() for part in np.split(index, cuts)]
            none = [None] * len(rows)
            columns = [
                [own] * (len(rows) + 1), [*(r[0] for r in rows), None], [*(r[1] for r in rows), None], [*(r[2] for r in rows), None],
                [*(r[3] for r in rows), None], [*links, None], [*none, pairs], [*none, counts],
            ]
            types = [pa.int64(), id_type, pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            names = ["block", "id", "n_a", "n_b", "groups_sha256", "links", "pairs", "counts"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("id").type
            for ids, texts, size in chunks(batch):
                rows += [(k, *found) for k, found in zip(ids, aligner.aligned(texts))]
                held += size
                if held >= BLOCK:
                    yield finished()
                    rows, held, own = [], 0, own + 1
        if rows:
            yield finished()

    return docs.mapInArrow(blocks, schema)


def rated_pairs(blocks: DataFrame) -> DataFrame:
    """Of every block's pairs: place in the block, links of the pair in the corpus, highest of its right id or not."""
    pairs = blocks.filter("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "p")).select(
        "block", "place", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n")
    )
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("links"))
    right = F.expr(f"pair & {(1 << RIGHT_BITS) - 1}L").alias("right")
    highest = totals.groupBy(right).agg(F.max("links").alias("highest"))
    rates = totals.withColumn("right", right).join(highest, "right").select("pair", "links", (F.col("links") == F.col("highest")).alias("best"))
    return pairs.drop("n").join(rates, "pair").select(F.col("block").alias("of_block"), "place", "links", "best")


def rated_documents(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """A block's texts with the sums over their links."""
    links, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    place = pairs["place"].to_numpy()
    links[place], best[place] = pairs["links"].to_numpy(), pairs["best"].to_numpy(zero_copy_only=False)
    found = [np.frombuffer(data, np.int32) for data in docs["links"].to_pylist()]
    sums = [[len(k) for k in found], [int(best[k].sum()) for k in found], [int(links[k].sum()) for k in found]]
    columns = [docs["id"], docs["n_a"], docs["n_b"], *[pa.array(c, pa.int64()) for c in (sums[0], *sums)], docs["groups_sha256"]]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return pa.Table.from_arrays(columns, names=names)


def alignments(docs: DataFrame, left: str, right: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's tokens, groups, links and sums over its links; see the module.

    ``left`` is the path of a byte-level vocabulary, which gets a space before the text, ``right`` of a model
    of pieces that adds one.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = staged(aligned_blocks(named, left, right), shared_folder(docs.sparkSession), "blocks")
    texts = blocks.filter("pairs IS NULL").select("block", "id", "n_a", "n_b", "groups_sha256", "links")
    kind = named.schema["id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return texts.groupBy("block").cogroup(rated_pairs(blocks).groupBy("of_block")).applyInArrow(rated_documents, schema)
