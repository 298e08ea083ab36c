"""Importance resampling, token alignment and personal data against plain versions."""

import collections
import hashlib
import math
import os
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from surveyqa.llm import importance, personal_data
from surveyqa.llm.alignment import Aligner, alignments, slices
from surveyqa.llm.importance import checksums, feature_blocks, resampled
from surveyqa.llm.queries import QUERIES
from surveyqa.llm.tokens import Encoder, Memory, spaced

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
given = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")
LEFT, RIGHT = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# -- importance resampling -----------------------------------------------------------------------


def plain_features(text, n):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(words[k : k + size]) for size in range(1, n + 1) for k in range(len(words) - size + 1)], len(words)


def plain_draw(docs, target, n, buckets, percent, least):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own, wanted = collections.Counter(), collections.Counter()
    for _, text in docs:
        own.update(map(bucket, plain_features(text, n)[0]))
    for text in target:
        wanted.update(map(bucket, plain_features(text, n)[0]))
    all_s, all_t = float(sum(own.values())), float(sum(wanted.values()))
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1.0) * (all_t * 0 + all_s + buckets) / ((own[b] + 1.0) * (all_t + buckets))))
    rows = []
    for doc_id, text in docs:
        features, words = plain_features(text, n)
        weight = sum(gain(bucket(f)) for f in features)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    may = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, row in enumerate(may[: percent * len(may) // 100]):
        row[4] = place + 1
    return sorted(map(tuple, rows), key=str)


def test_checksums_of_all_lengths():
    features = [b"", b"a", b"word", b"other", b"x" * importance.WIDEST, b"y" * (importance.WIDEST + 1), "ñandú".encode(), b"word" * 900]
    data = np.frombuffer(b"".join(features), np.uint8)
    offsets = np.concatenate(([0], np.cumsum(list(map(len, features)))))
    assert checksums(data, offsets).tolist() == list(map(zlib.crc32, features))


@pytest.mark.parametrize("n", [1, 3])
def test_features_of_blocks(n, monkeypatch):
    monkeypatch.setattr(importance, "BLOCK", 40)
    texts = [None, "", "One two, TWO three", "...", "a" * 300 + " b1 é", "x y z x y z", "\x00tab\tand\x7fend"]
    found, first = collections.defaultdict(list), 0
    for count, words, row, bucket in feature_blocks(pa.array(texts), n, 977):
        for r, b in zip(row, bucket):
            found[first + r].append(b)
        assert words.tolist() == [plain_features(t, 1)[1] for t in texts[first : first + count]]
        first += count
    for k, text in enumerate(texts):
        assert sorted(found[k]) == sorted(zlib.crc32(f.encode()) % 977 for f in plain_features(text, n)[0])


@given
@pytest.mark.parametrize("n", [1, 2])
def test_draw(spark, n):
    docs, target = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    found = resampled(docs, target, n=n, buckets=500, percent=15, least_words=30).collect()
    expected = plain_draw([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], n, 500, 15, 30)
    assert sorted(map(tuple, found), key=str) == expected and sum(r.rank is not None for r in found) > 10


def test_draw_of_odd_and_empty_tables(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    target = [None, "", "plain words of eleven words"]
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, n int")
    for wanted, texts in ((aim, target), (nothing, [])):
        found = resampled(odd, wanted, buckets=50, percent=60, least_words=0)
        expected = plain_draw(rows, texts, 1, 50, 60, 0)
        shape = lambda rs: sorted(((r[0], *r[1:4], r[5]) for r in rs), key=str)  # noqa: E731 - equal ids and scores rank in any order
        assert shape(map(tuple, found.collect())) == shape(expected)
        assert sorted(r.rank for r in found.collect() if r.rank) == list(range(1, 60 * len(rows) // 100 + 1))
    assert resampled(nothing, aim).count() == 0


def test_ranks_over_many_ranges(spark, staging):
    rows = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 7L, id % 50) AS score", "id AS _row").repartition(7)
    found = importance.ranked(rows, [F.col("score").desc(), F.col("id"), F.col("_row")], f"{staging}/ranks").collect()
    expected = sorted(((r.score, r.id) for r in found), key=lambda r: (-r[0], r[1]))
    assert [(r.score, r.id) for r in sorted(found, key=lambda r: r["rank"])] == expected
    assert sorted(r["rank"] for r in found) == list(range(1, 5001))


# -- token alignment -----------------------------------------------------------------------------


def plain_alignment(docs):
    left, right = Tokenizer.from_file(LEFT), sentencepiece.SentencePieceProcessor(model_file=RIGHT)
    left.encode_special_tokens = True
    letters = {v: k for k, v in personal_letters().items()}
    rows, links = [], []
    for doc_id, text in docs:
        whole = (" " + (text or "")).encode()
        a = left.encode(whole.decode(), add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in left.id_to_token(k)) for k in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) and right.is_byte(k) else p.replace("▁", " ").encode()
                   for k, p in ((k, right.id_to_piece(k)) for k in b)]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            a, b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = np.cumsum(list(map(len, bytes_a))).tolist(), np.cumsum(list(map(len, bytes_b))).tolist()
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x = [k for k, e in zip(a, ends_a) if i < e <= end]
            y = [k for k, e in zip(b, ends_b) if i < e <= end]
            groups.append(f"{','.join(map(str, x))}|{','.join(map(str, y))}")
            i = end
        own = [(x, y) for x, ex in zip(a, ends_a) for y, ey in zip(b, ends_b) if ex == ey] if len(a) < 400 else [
            (x, b[ends_b.index(ex)]) for x, ex in zip(a, ends_a) if ex in set(ends_b)]
        links.append(own)
        rows.append([doc_id, len(a), len(b), len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
    counts = collections.Counter(pair for own in links for pair in own)
    highest = collections.Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return sorted(((*r[:5], sum(counts[p] == highest[p[1]] for p in own), sum(counts[p] for p in own), r[5]) for r, own in zip(rows, links)), key=str)


def personal_letters():
    from surveyqa.llm.tokens import BYTE_LETTERS
    return BYTE_LETTERS


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@given
def test_alignment(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").limit(60)
    rows = [tuple(r) for r in docs.collect()] + [
        (-1, "</s> <|endoftext|> <0x41> ▁x"), (-2, "<s>no mark</s> <|endoftext|>"), (-3, "é🙂\x00 日本語  two\n\n\tblanks "), (-4, " "), (-5, None), (-6, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted((tuple(r) for r in alignments(table, LEFT, RIGHT).select(*COLUMNS).collect()), key=str)
    assert found == plain_alignment(rows)
    own = {r[0]: r for r in found}
    assert own[-1][1] == 0 and own[-1][-1] == "" and own[-2][1] > 0 and own[-3][3] > 3


def test_alignment_over_blocks(spark, odd, nothing, monkeypatch):
    from surveyqa.llm import alignment
    before = sorted((tuple(r) for r in alignments(odd, LEFT, RIGHT).collect()), key=str)
    monkeypatch.setattr(alignment, "BLOCK", 64)
    monkeypatch.setattr(alignment, "CHUNK", 32)
    assert sorted((tuple(r) for r in alignments(odd, LEFT, RIGHT).collect()), key=str) == before and len(before) == odd.count()
    assert alignments(nothing, LEFT, RIGHT).count() == 0


ODD_TEXTS = ["two  blanks", " led", "end ", "line\n next", "line \nnext", "tab\t tab", "\u00a0 nbsp\u00a0x", "a\u2581b c", "x\u2003 y \u2003z", "a" * 3000 + " b", "é 🙂 ñ's it's",
             "<s> </s> <|endoftext|> x", "\x00 \x1c \x85 \u200b x", "ﬁ ½ Å Å", "   ", "\n", "日本語 テスト"]


def test_stretches_are_encoded_as_in_their_texts():
    left, right = Tokenizer.from_file(LEFT), sentencepiece.SentencePieceProcessor(model_file=RIGHT)
    left.encode_special_tokens = True
    texts = ODD_TEXTS + [" ".join(ODD_TEXTS), "  ".join(ODD_TEXTS)]
    if os.path.isdir(SF_DIR):
        texts += [t for (t,) in __import__("duckdb").sql(f"SELECT text FROM '{SF_DIR}/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    aligner = Aligner(LEFT, RIGHT)
    for text, (n_a, n_b, _, _) in zip(texts, aligner.aligned(texts)):
        (whole,) = aligner.stretches([" " + text])
        if n_a:
            parts = aligner.stretches(alignment_module().stretches_of(" " + text))
            a = left.encode(" " + text, add_special_tokens=False).ids
            assert sum(p[0] for p in parts) == n_a == len(a) and n_b == len(right.encode(text))
            assert ";".join(p[2] for p in parts) == whole[2] and b"".join(p[3] for p in parts) == whole[3]
            assert aligner.encoder.encode([" " + text]) == [np.array(a, np.uint32).tobytes()]
        else:
            assert whole is None


def alignment_module():
    from surveyqa.llm import alignment
    return alignment


def test_slices_and_texts_without_tokens():
    assert slices([2, 5, 6, 9], [1, 5, 9]) == ([2, 4], [2, 3]) and slices([], []) == ([], [])
    found = list(Aligner(LEFT, RIGHT).aligned(["", "a▁b", "ab"]))
    assert [f[:3] for f in found[:2]] == [(0, 0, "")] * 2 and found[2][0] > 0 and len(found[2][3])


def test_worker_memory_is_bounded():
    small, large = Encoder(LEFT, spaced, kept=20_000), Encoder(LEFT, spaced)
    texts = [f"word{k} und{k % 50} x" for k in range(2000)]
    assert [small.encode([t]) for t in texts] == [large.encode([t]) for t in texts]
    assert small.known.size <= small.known.limit + 2000 and len(small.known.late) + len(small.known.early) < 200
    memory = Memory(1000)
    memory.add("kept", b"1", 1)
    memory.size = 501
    memory.turn()
    assert memory.early == {"kept": b"1"} and not memory.late and memory.size == 0


# -- personal data -------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and plain_luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


TRICKY = [
    "a@b.c_d@e.f g@h@i.j k@l..m @n.o p@q.r.", "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.003.4 12345678901234567890.1.1.1 1.2.3.",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 0 4 1 1 1", "+1 (377) 555-0271 +1((((( +123456789 +1 2 3 +12 345 678 901 234 567",
    "x" * 5000 + "@" + "9" * 4000 + ".1.1.1", "é🙂 mail é.x@ü.de a.b@c-d.ef 🙂+49 30 1234567",
]


@pytest.mark.parametrize("text", TRICKY)
def test_base_spans(text):
    assert [f"{personal_data.KINDS[k]}:{s}:{e}" for k, s, e in personal_data.base_spans(text)] == plain_spans(text)


@given
def test_registered_query_keeps_base_spans(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in QUERIES["op13_personal_data"](spark, SF_DIR).collect():
        base = plain_spans(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [getattr(r, f"n_{k}") for k in PATTERNS] == [sum(b.startswith(k + ":") for b in base) for k in PATTERNS]
        assert [s for s in r.spans.split(",") if s.split(":")[0] in PATTERNS] == base and r.n_added == len([s for s in r.spans.split(",") if s]) - len(base)


def test_odd_and_empty_tables(spark, odd, nothing):
    found = personal_data.personal_data(odd).collect()
    assert len(found) == odd.count() and all(r.n_email == 0 for r in found)
    assert personal_data.personal_data(nothing).count() == 0


def planted(k):
    """A text with personal data in wider forms, or one with like spans that are none."""
    if k % 2:
        return (f"Dear James Miller{'abcdefgh'[k % 8]}, my phone is 0{20 + k % 9} {2345 + k} {6789 + k % 90}, "
                f"write to anna.m{k} (at) mail{k} (dot) com. SSN: {123 + k % 500}-{45 + k % 50}-{6000 + k}.")
    return f"Order part 000-{10 + k % 80}-0000, version 12345-{k % 900 + 100}. Example invoice 555 0{k % 90 + 100} 0000 total 12-12-{3000 + k}."


def test_labelers_agree_on_added_spans(spark):
    rows = [(k, planted(k)) for k in range(400)] + [(1000 + k, "plain words of no person at all") for k in range(200)]
    found = {r.doc_id: r for r in personal_data.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    kinds = collections.Counter(s.split(":")[0] for k in range(1, 400, 2) for s in found[k].spans.split(",") if s)
    assert min(kinds[k] for k in ("ssn", "written_email", "local_phone", "name")) >= 190
    assert sum(found[k].n_added > 0 for k in range(0, 400, 2)) <= 10 and all(found[k].spans == "" for k in range(1000, 1200))


def test_expectation_maximisation_finds_reliabilities():
    rng = np.random.default_rng(7)
    truth = rng.random(20_000) < 0.3
    right = [0.9, 0.8, 0.7, 0.6, 0.75, 0.65]
    votes = np.stack([np.where(rng.random(len(truth)) < p, truth, ~truth) * 2 for p in right], axis=1)
    votes = np.where(rng.random(votes.shape) < 0.2, 1, votes)
    kind = np.full(len(truth), 5)
    found = personal_data.reliabilities(kind, votes, np.ones(len(truth)))
    assert abs(found.share[5] - 0.3) < 0.03
    for j, p in enumerate(right):
        assert abs(found.votes[j, 1, 2] / (found.votes[j, 1, 2] + found.votes[j, 1, 0]) - p) < 0.05
    assert ((found.posterior(kind, votes) > 0.5) == truth).mean() > 0.9
    # Counts of equal rows stand for the rows.
    pattern, n = np.unique(votes, axis=0, return_counts=True)
    again = personal_data.reliabilities(np.full(len(pattern), 5), pattern, n.astype(float))
    assert np.allclose(found.votes, again.votes, atol=1e-6)


def test_logistic_regression_follows_soft_labels():
    kind, shape, context = np.array([4, 4, 5, 5]), np.array([0, 48, 0, 48]), np.array([1, 1, 2, 2])
    columns, counts = personal_data.columns_of(kind, shape, context), np.array([500.0, 500, 500, 500])
    weights = personal_data.logistic(columns, np.array([0.05, 0.95, 0.1, 0.9]), counts)
    p = 1 / (1 + np.exp(-weights[columns].sum(axis=1)))
    assert p[0] < 0.2 < 0.8 < p[1] and p[2] < 0.2 < 0.8 < p[3]
