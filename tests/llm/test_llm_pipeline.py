import collections
import os
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from surveyqa.llm import quality_crf
from surveyqa.llm.mixing import mixed
from surveyqa.llm.secret_scan import secrets

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = kept[name] = spark.read.parquet(f"{tmp_path}/{name}")
        assert name == "packing" or docs.columns == columns
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    judged = collections.Counter((r.quality, r.stays) for r in labels.join(
        kept["quality"].select("doc_id", F.lit(True).alias("stays")), "doc_id", "left").collect())
    assert judged[1, None] <= 0.02 * judged[1, True] and judged[0, True] <= 0.1 * judged[0, None]
    texts = [r.text for r in kept["near_copies"].collect()]
    assert len(texts) == len(set(texts)) < kept["quality"].count()
    assert kept["secrets"].count() == len(texts)
    assert secrets(kept["near_copies"]).agg(F.sum("n_live")).first()[0] > 0
    ids = collections.Counter(r.doc_id for r in kept["mixing"].select("doc_id").collect())
    assert max(ids.values()) <= 2
    pieces = kept["packing"].collect()
    assert collections.Counter(r.doc_id for r in pieces if r.piece == 0) == ids
    again = corpus_pipeline.run(spark, SF_DIR).collect()  # which copy of a length goes where may differ
    shape = lambda rows: collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert shape(again) == shape(pieces) and len({r.sequence_id for r in again}) == len({r.sequence_id for r in pieces})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Every stage's input and output, as rows."""
    folder, docs, found = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        found[name] = (docs, spark.read.parquet(f"{folder}/{name}"))
        docs = found[name][1]
    return found


def test_quality_stage_keeps_what_the_model_accepts(spark, kept):
    docs, out = kept["quality"]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality_crf.train(docs, labels, learn=F.expr("crc32(cast(doc_id AS string)) % 4 <> 2"))
    good = {r.doc_id for r in quality_crf.scored(docs, model).collect() if r.quality_score >= corpus_pipeline.LEAST_QUALITY}
    assert sorted(map(tuple, out.collect()), key=str) == sorted((tuple(r) for r in docs.collect() if r.doc_id in good), key=str)


def test_near_copies_stage_against_all_pairs(kept):
    docs, out = kept["near_copies"]
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    group = {k: k for k in sets}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    holders = collections.defaultdict(list)
    for k, own in sets.items():
        for shingle in own:
            holders[shingle].append(k)
    pairs = {(a, b) for held in holders.values() for a in held for b in held if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            a, b = sorted((root(a), root(b)))
            group[b] = a
    stay = [r.doc_id for r in out.collect()]
    assert sorted(map(root, stay)) == sorted({root(k) for k in sets}) and len(stay) < len(sets)
    given = {r.doc_id: tuple(r) for r in docs.collect()}
    assert all(tuple(r) == given[r.doc_id] for r in out.collect())


def test_secrets_stage_masks_live_spans_only(kept):
    docs, out = kept["secrets"]
    spans = {r.doc_id: r for r in secrets(docs).collect()}
    owners = collections.defaultdict(set)
    for r in docs.collect():
        for span in filter(None, spans[r.doc_id].spans.split(",")):
            kind, start, end = span.split(":")
            if kind in ("access", "hex"):  # kinds whose value is the whole span
                owners[kind, r.text[int(start) : int(end)]].add(r.source)
    after, masked = {r.doc_id: r for r in out.collect()}, 0
    for r in docs.collect():
        text = after[r.doc_id].text
        assert after[r.doc_id].n_chars == len(text) and (text == r.text) == (spans[r.doc_id].n_live == 0)
        pieces = list(filter(None, spans[r.doc_id].spans.split(",")))
        masked += text.count("[SECRET]")
        for span in pieces:
            kind, start, end = span.split(":")
            value = r.text[int(start) : int(end)]
            if kind in ("access", "hex") and len(owners[kind, value]) > 2:
                assert value in text or len(pieces) > 1  # widely copied: stays, unless another span covers it
            if kind in ("access", "hex") and len(owners[kind, value]) == 1 and spans[r.doc_id].n_live == len(pieces):
                assert value not in text
    assert masked > 3 and sorted(after) == sorted(spans)


def test_mixing_stage_takes_what_the_mix_says(kept):
    docs, out = kept["mixing"]
    taken = {r.doc_id: (r.taken, r.size) for r in mixed(docs).collect()}
    times = collections.Counter(r.doc_id for r in out.collect())
    given = {r.doc_id: tuple(r) for r in docs.collect()}
    for doc_id, (words, size) in taken.items():
        whole, part = divmod(words, max(1, size))
        assert whole <= times[doc_id] <= whole + (part > 0)
    assert all(tuple(r) == given[r.doc_id] for r in out.collect())
    size = {k: s for k, (_, s) in taken.items()}
    assert abs(sum(size[k] * n for k, n in times.items()) / sum(w for w, _ in taken.values()) - 1) < 0.05


def test_packing_stage_fills_sequences_without_gaps(kept):
    docs, out = kept["packing"]
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode.encode_special_tokens = True
    expected = collections.Counter()
    for r in docs.collect():
        expected[r.doc_id, len(encode.encode(r.text or "", add_special_tokens=False).ids) + 1] += 1
    rows, lengths, sequences = out.collect(), collections.Counter(), collections.defaultdict(list)
    for r in rows:
        lengths[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    want = collections.Counter()
    for (doc_id, n), times in expected.items():
        want[doc_id] += n * times
    assert lengths == want
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= 1.05 * (sum(lengths.values()) / 2048) + 2


def test_empty_and_odd_tables(spark, odd, nothing):
    documents = ["doc_id", "text", "lang", "source", "n_chars", "size", "row", "kind"]
    for docs in (nothing.select(*documents), odd.select(*documents)):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, SF_DIR)
            assert found.count() >= 0 and (name == "packing" or found.columns == documents)
