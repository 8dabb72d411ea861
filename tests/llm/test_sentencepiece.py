import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece as library
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ontime.llm import sentencepiece as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", " a", "a ", "a  b   c", "日本語 テスト", "x" * 300, "\u2581\u2581a", "\n\n\t", "😀😀 é", "a" * 41 + " " + "b" * 70,
       "    if x:\n        return  1  ", "1234567 89", "unbelievably internationalization", "\x00\ufffd"]


@pytest.fixture(scope="module")
def bpe():
    return sp.load_model(PATH), library.SentencePieceProcessor(model_file=PATH)


def unigram(with_bytes):
    proto, rnd = sp.sentencepiece_model_pb2.ModelProto(), random.Random(3)
    proto.trainer_spec.model_type, proto.trainer_spec.byte_fallback = 1, with_bytes
    norm = proto.normalizer_spec
    norm.name, norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces = "identity", True, False, True
    pieces = set("abcdetinsro\u2581")
    while len(pieces) < 250:
        pieces.add(rnd.choice(["", "\u2581"]) + "".join(rnd.choices("abcdetinsro", k=rnd.randint(1, 5))))
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    rows += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if with_bytes else []
    for piece, score, kind in rows + [(p, -rnd.uniform(2, 9), 1) for p in sorted(pieces)]:
        proto.pieces.add(piece=piece, score=score, type=kind)
    return sp.PieceModel(proto), library.SentencePieceProcessor(model_proto=proto.SerializeToString())


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def streamed(model, text):
    """The ids of the whole text as one stream."""
    text = ("\u2581" + text.replace(" ", "\u2581")) if text else ""
    return ids(model._encode_stretch(text))


@pytest.mark.parametrize("text", ODD)
def test_equals_the_library(bpe, text):
    model, other = bpe
    assert ids(model.encode(text)) == streamed(model, text) == other.encode(text)
    assert model.decode(model.encode(text)) == text.replace("\u2581", " ")


@settings(deadline=None, max_examples=150)
@given(text=st.text(alphabet=st.sampled_from("abcdetinsro   .é\n日"), max_size=120))
def test_random_texts(text):
    model, other = sp.load_model(PATH), library.SentencePieceProcessor(model_file=PATH)
    assert ids(model.encode(text)) == streamed(model, text) == other.encode(text)


@pytest.mark.parametrize("with_bytes", [True, False])
def test_unigram_models(with_bytes):
    model, other = unigram(with_bytes)
    rnd = random.Random(9)
    for _ in range(200):
        text = "".join(rnd.choices("abcdetinsro  zé", k=rnd.randint(0, 150)))
        assert ids(model.encode(text)) == streamed(model, text) == other.encode(text), text


def test_window_is_bounded(bpe):
    model, _ = bpe
    held, fed, out = [], 0, 0
    text = "\u2581the" * 5000

    def chars():
        nonlocal fed
        for c in text:
            fed += 1
            yield c
    for _, piece in model.pieces(chars()):
        out += len(piece)
        held.append(fed - out)
    assert out == len(text) and max(held) <= 6 * model.longest


def test_tables_are_bounded(bpe, monkeypatch):
    model, other = bpe
    monkeypatch.setattr(sp, "_TABLE_LIMIT", 5)
    monkeypatch.setattr(sp, "_PAIR_LIMIT", 5)
    for text in ("some words of a text", "other words here", "some words of a text again"):
        assert ids(model.encode(text)) == other.encode(text)
    assert len(model.pairs) <= 5


def test_columns_on_odd_rows(odd_docs, no_docs, bpe):
    rows = (odd_docs.withColumn("ids", sp.encode(F.col("text"), PATH)).withColumn("back", sp.decode(F.col("ids"), PATH)).collect())
    assert len(rows) == 11
    for r in rows:
        assert ids(r.ids) == bpe[1].encode(r.text or "") and r.back == (r.text or "")
    assert no_docs.select(sp.encode(F.col("text"), PATH)).count() == 0
    assert odd_docs.select(sp.decode(F.lit(None).cast("binary"), PATH).alias("x")).first().x is None


def test_unsupported_models_are_refused():
    proto = sp.sentencepiece_model_pb2.ModelProto()
    proto.trainer_spec.model_type = 3
    with pytest.raises(ValueError):
        sp.PieceModel(proto)


@pytest.mark.parametrize("side, step", [(1, 20), (1, 64), (10 ** 6, 64), (48, 33)])
def test_lanes_of_every_length(bpe, monkeypatch, side, step):
    """Rounds with commits side by side, lanes that go on alone, and both in turn give the library's ids."""
    model, other = bpe
    monkeypatch.setattr(sp, "_SIDE", side)
    monkeypatch.setattr(sp, "_STEP", step)
    rnd = random.Random(side + step)
    texts = ["".join(rnd.choices("01=_-/", k=rnd.randint(1, 260))) for _ in range(40)]
    texts += ["".join(rnd.choices("etaoinshrd.,", k=rnd.randint(1, 260))) for _ in range(40)]
    texts += ["x" * n for n in (step - 1, step, step + 1, 2 * step, 500)] + ["ab" * 150, "=-" * 130, "the" * 90, "-" * 200 + "x", ""]
    model.stretches.clear()
    for text, raw in zip(texts, model.encode_all(texts)):
        assert ids(raw) == other.encode(text)
