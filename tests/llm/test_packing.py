import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ontime.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@given(st.integers(1, 20_000), st.sampled_from([1, 8, 2048]))
def test_piece_lengths(n, top):
    cut = packing.piece_lengths(n, top)
    assert sum(cut) == n and cut == sorted(cut, reverse=True) and all(x & (x - 1) == 0 and x <= top for x in cut)
    assert len([x for x in cut if x < top]) == len({x for x in cut if x < top})


@settings(deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(text=st.text(alphabet=st.sampled_from("abé \n\t'sl.1日　😀"), max_size=40))
def test_encoder_equals_the_tokenizer(tokenizer, text):
    ids = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))(text)
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


ADDED = ["end of one <|endoftext|> start", "<|endoftext|>", "a  <|endoftext|><|endoftext|>\n\n b", "x<|endoftext|", "<<|endoftext|>>  "]


@pytest.mark.parametrize("text", ADDED)
def test_added_tokens_in_plain_text(tokenizer, text):
    ids = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))(text)
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


@settings(deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(parts=st.lists(st.sampled_from(["<|endoftext|>", " ", "\n", "ab", "<|", "|>", "é", "\t"]), max_size=12))
def test_added_tokens_among_odd_parts(tokenizer, parts):
    ids = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))("".join(parts))
    assert ids == tokenizer.encode("".join(parts), add_special_tokens=False).ids


def test_pieces_hold_added_tokens(spark, tokenizer):
    docs = spark.createDataFrame(list(enumerate(ADDED)), "doc_id bigint, text string")
    got = {}
    for r in packing.pack_documents(docs).orderBy("doc_id", "start").collect():
        got.setdefault(r.doc_id, b"")
        got[r.doc_id] += r.tokens
    want = [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in ADDED]
    assert [got[i] for i in range(len(ADDED))] == [np.array(w, np.uint32).tobytes() for w in want]


def test_pieces_of_odd_rows(odd_docs, no_docs, tokenizer):
    got = packing.pack_documents(odd_docs, max_length=64).collect()
    assert len({r.sequence_id for r in got}) == len(got) and {r.offset for r in got} == {0}
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    for r in odd_docs.select("doc_id", "text").distinct().collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], np.uint32)
        copies = 2 if r.doc_id == 2 else 1
        pieces = sorted(by_doc[r.doc_id], key=lambda p: (p.start, p.sequence_id))[::copies]
        assert b"".join(p.tokens for p in pieces) == ids.tobytes() and {p.doc_tokens for p in pieces} == {len(ids)}
        assert [p.start for p in pieces] == [0, *np.cumsum([p.length for p in pieces])[:-1].tolist()]
        assert all(zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == zlib.crc32(p.tokens) for p in pieces)
    assert packing.pack_documents(no_docs).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(no_docs, max_length=100)


def test_write_buckets(spark, odd_docs, tmp_path):
    packing.write_buckets(packing.pack_documents(odd_docs, max_length=32), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.where("bucket <> length").count() == 0 and (tmp_path / "out" / "bucket=32").is_dir()
