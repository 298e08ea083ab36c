"""Token ids of whole texts by a public tokenizer, each distinct word encoded once a worker.

Both kinds of vocabulary split a text before they merge, and never merge across the start of a word.
So a text's ids are those of its words, one after another, and a worker remembers the words it has
seen. ``words_of`` cuts so that every piece is encoded alone as it would be in its text; a text with
white space that the fast cut can't handle is cut by the slow pattern. New words of common letters are cut
into the vocabulary's pieces, which go to the merges all at once; any other new word goes through the whole
tokenizer.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Bytes of words that a worker remembers at most, and of an entry besides its text and ids. Half is
#: for those met lately; when it is full they replace the other half, whose words were not met since.
KEPT_BYTES, ENTRY_BYTES = 96 << 20, 250
#: White space as the vocabularies' patterns know it, and a blank before more of it, where runs are
#: cut differently.
WHITE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
ODD_BLANKS = re.compile(f" [{WHITE}]")
PIECES = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
BLACK = re.compile(f"[^{WHITE}]+")
#: Letters of ASCII and Latin-1, which are their own normal form; words of these and ASCII are common.
LETTERS = "A-Za-z" + "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
COMMON = re.compile(rf"[\t-\r -~{LETTERS}]*")
#: How the vocabularies cut common words, after folding for the one that folds.
SPACED_PIECES = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[0-9]+| ?[^\t-\r {LETTERS}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
PLAIN_PIECES = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[0-9]|[^\t-\r {LETTERS}0-9]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable bytes for themselves, the others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTE_LETTERS = byte_letters()


def spaced(text: str) -> list[str]:
    """Words with the blank before them; their concatenation is the text."""
    if ODD_BLANKS.search(text):
        return PIECES.findall(text)
    first, *rest = text.split(" ")
    words = [" " + w for w in rest]
    return [first, *words] if first else words


def plain(text: str) -> list[str]:
    """Words without white space."""
    return BLACK.findall(text)


class Memory:
    """What a worker remembers by text, bounded in bytes; what was met lately outlives the rest."""

    def __init__(self, limit: int) -> None:
        self.limit, self.size = limit // 2, 0
        self.late: dict[str, Any] = {}
        self.early: dict[str, Any] = {}

    def add(self, text: str, found: Any, size: int) -> None:
        self.late[text] = found
        self.size += len(text) + size + ENTRY_BYTES

    def turn(self) -> None:
        """Forget the early half when the late one is full."""
        if self.size > self.limit:
            self.late, self.early, self.size = {}, self.late, 0


#: Ends a piece on its way through the merges; common words don't hold it.
MARK = "\x01"
#: What ends the entries of vocabularies that tell a word's last piece from others.
WORD_END = "</w>"


class Merges:
    """The ids of many pieces at once, by a library that merges by rank alone, several times as fast.

    Ranks are ids, so every merge must make the next id after the single bytes; ``of`` gives None for other
    vocabularies. Pieces go as one text with a mark after each. Where a vocabulary has entries for word ends,
    the mark is the end; elsewhere it is a token of its own and left out.
    """

    def __init__(self, path: str, ranks: dict[bytes, int], ids: np.ndarray, ends: bool) -> None:
        self.encoding = tiktoken.Encoding(path, pat_str=f"[^{MARK}]+{MARK}" if ends else f"[^{MARK}]+|{MARK}", mergeable_ranks=ranks, special_tokens={})
        self.ids, self.ends = ids, ends
        mark = MARK.encode()
        self.last = np.zeros(len(ids), bool)
        self.last[[k for entry, k in ranks.items() if entry.endswith(mark) and (ends or entry == mark)]] = True

    @classmethod
    def of(cls, path: str) -> Merges | None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ends = model.get("end_of_word_suffix") == WORD_END
        first = 512 if ends else 256
        byte, mark = {letter: bytes([b]) for b, letter in BYTE_LETTERS.items()}, MARK.encode()
        singles = [(letter, b) for letter, b in byte.items()] + ([(letter + WORD_END, b + mark) for letter, b in byte.items()] if ends else [])
        if any(vocabulary.get(a + b) != first + k for k, (a, b) in enumerate(merges)):
            return None
        if sorted(vocabulary.get(entry, -1) for entry, _ in singles) != list(range(first)):
            return None
        ranks = {data: vocabulary[entry] for entry, data in singles}
        for a, b in merges:
            entry = a + b
            whole, tail = (entry.removesuffix(WORD_END), mark if entry.endswith(WORD_END) else b"") if ends else (entry, b"")
            ranks.setdefault(b"".join(map(byte.__getitem__, whole)) + tail, vocabulary[entry])
        return cls(path, ranks, np.arange(first + len(merges), dtype=np.uint32), ends) if len(ranks) == first + len(merges) else None

    def encoded(self, pieces: list[list[str]]) -> list[bytes]:
        """Ids of words given as their pieces."""
        ids = np.array(self.encoding.encode_ordinary("".join(p + MARK for word in pieces for p in word)), np.int64)
        last = np.flatnonzero(self.last[ids])
        stops = last + 1 if self.ends else last - np.arange(len(last))
        data = (ids if self.ends else ids[~self.last[ids]]).astype("<u4").tobytes()
        upto = np.concatenate(([0], stops))[np.cumsum([len(word) for word in pieces])] * 4
        return [data[a:b] for a, b in zip([0, *upto[:-1].tolist()], upto.tolist())]


class Encoder:
    """``encode`` gives a text's ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, words_of: Callable[[str], list[str]], kept: int = KEPT_BYTES) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.words_of, self.folds = words_of, words_of is plain
        self.pieces, self.merges = PLAIN_PIECES if self.folds else SPACED_PIECES, Merges.of(path)
        self.known = Memory(kept)

    def new(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Words that the worker does not know, with their ids."""
        common = [w for w in words if COMMON.fullmatch(w)] if self.merges is not None else []
        if common:
            cut = [self.pieces.findall(w.lower() if self.folds else w) for w in common]
            yield from zip(common, self.merges.encoded(cut))
        rest = set(words).difference(common) if len(common) < len(words) else ()
        for text in rest:
            yield text, array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; a call's own words are held until it ends, however many."""
        self.known.turn()
        cut = [self.words_of(t) for t in texts]
        known, early, new = self.known.late, self.known.early, []
        for text in set().union(*cut).difference(known) if cut else ():
            ids = early.get(text)
            if ids is None:
                new.append(text)
            else:
                self.known.add(text, ids, len(ids))
        for text, ids in self.new(new):
            self.known.add(text, ids, len(ids))
        get = known.__getitem__
        return [b"".join(map(get, words)) for words in cut]


ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, words_of: Callable[[str], list[str]]) -> Encoder:
    """The worker's encoder for a vocabulary."""
    key = (path, words_of.__name__)
    if key not in ENCODERS:
        ENCODERS[key] = Encoder(path, words_of)
    return ENCODERS[key]
