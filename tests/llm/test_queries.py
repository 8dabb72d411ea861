"""Whole results of the registered queries that have no SQL, against plain computations."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece as library
from tokenizers import Tokenizer

from ontime.llm.queries import QUERIES
from tests.llm.test_simhash import reference_components, reference_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert len({i for i, _ in rows}) == len(rows)
    return rows


def test_op1(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, sequences = {}, []
    for r in QUERIES["op1_packing"](spark, SF).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences.append((r.sequence_id, r.offset, r.length))
    assert got.keys() == dict(docs).keys()
    for i, text in docs:
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for start, length, crc, size in sorted(got[i]):
            assert (start, size, crc) == (at, len(ids), zlib.crc32(ids[at:at + length].tobytes()))
            at += length
        assert at == len(ids)
    assert len({s for s, _, _ in sequences}) == len(sequences)  # a piece fills its sequence, so there is no padding
    assert all(offset == 0 and length <= 2048 and length & (length - 1) == 0 for _, offset, length in sequences)


def test_op3(spark, docs):
    fps = [(i, reference_fingerprint(t)) for i, t in docs]
    want = {(i, f"{fp:016x}", c) for (i, fp), c in zip(fps, reference_components(fps))}
    rows = QUERIES["op3_simhash"](spark, SF).collect()
    assert len(rows) == len(docs) and {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == want


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often, lines = Counter(windows), [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_op4(spark, docs):
    rows = {r.doc_id: r for r in QUERIES["op4_quality_rules"](spark, SF).collect()}
    assert rows.keys() == dict(docs).keys()
    for i, text in docs:
        r, want = rows[i], base_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_op5(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    rows = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and any(v)]
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    got = {}
    for r in QUERIES["op5_ann"](spark, SF).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    queries = [k for k, i in enumerate(ids) if i % 20 == 0]
    assert got.keys() == {ids[k] for k in queries}
    hits = 0
    for k in queries:
        found, scores = [got[ids[k]][n] for n in range(1, 21)], vectors @ vectors[k]
        assert len(got[ids[k]]) == 20 and ids[k] not in {i for i, _ in found}
        place = {i: n for n, i in enumerate(ids)}
        assert all(abs(scores[place[i]] - s) < 1e-9 for i, s in found)
        assert [(-s, i) for i, s in found] == sorted((-s, i) for i, s in found)
        best = [ids[n] for n in np.lexsort((ids, -scores)) if n != k][:20]
        hits += len({i for i, _ in found} & set(best))
    assert hits >= 0.9 * 20 * len(queries)


def test_op10(spark, docs):
    model = library.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = {r.doc_id: r for r in QUERIES["op10_sentencepiece"](spark, SF).collect()}
    assert rows.keys() == dict(docs).keys()
    for i, text in docs:
        ids = model.encode(text)
        back = model.decode(ids)
        assert (rows[i].n_ids, rows[i].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert rows[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest() and rows[i].round_trip == (back == text)
