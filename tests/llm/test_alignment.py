import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ontime.llm import alignment
from ontime.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_table():
    """The public byte-to-letter table of byte-level BPE vocabularies, built by its rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


def reference(texts, libraries):
    """Brute force: groups by walking both sequences, links and counts in dictionaries."""
    a, b = libraries
    letters = byte_table()
    rows, counts = [], Counter()
    for text in texts:
        rows.append(None)
        if not text:
            continue
        enc = a.encode(" " + text, add_special_tokens=False)
        ta = [(i, bytes(letters[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
        tb = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            tb.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(t for _, t in ta) != whole or b"".join(t for _, t in tb) != whole:
            continue
        groups, links, x, y = [], [], 0, 0
        while x < len(ta):  # walk both sequences until they have covered the same bytes
            first_x, first_y, cover_a, cover_b = x, y, len(ta[x][1]), len(tb[y][1])
            while cover_a != cover_b:
                if cover_a < cover_b:
                    x += 1
                    cover_a += len(ta[x][1])
                else:
                    y += 1
                    cover_b += len(tb[y][1])
            groups.append(",".join(str(i) for i, _ in ta[first_x:x + 1]) + "|" + ",".join(str(i) for i, _ in tb[first_y:y + 1]))
            links.append((ta[x][0], tb[y][0]))
            x, y = x + 1, y + 1
        counts.update(links)
        rows[-1] = (len(ta), len(tb), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            na, nb, ng, links, sha = r
            out.append((na, nb, ng, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha))
    return out


TEXTS = ["The quick brown fox", "The quick brown fox", None, "", " ", "  two  spaces ", "a\n\n\tb", "<|endoftext|> and <s> </s>",
         "▁mark", "naïve 日本語 😀 Ünïcödé", "x" * 3000, "ab " * 2000, "\x00\x01 zero", "é́", "<0x41>", "🇩🇪" * 9,
         "12345 67,890.12", "\r\n", "　wide", "don't WON'T I'm"]


def as_rows(df):
    return [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()]


@pytest.mark.parametrize("max_broadcast_pairs", [2_000_000, 0])
def test_report_equals_brute_force(spark, libraries, max_broadcast_pairs):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").repartition(3)
    got = as_rows(alignment.alignment_report(docs, max_broadcast_pairs=max_broadcast_pairs))
    assert sorted(got) == [(i, *r) for i, r in enumerate(reference(TEXTS, libraries))]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(alphabet="ab .'\n\t é日😀▁0<>x", max_size=30), max_size=4))
def test_groups_of_any_text(libraries, texts):
    a, b = (alignment._side(make, public_tokenizers.path(f)) for make, f in (
        (alignment.byte_bpe_side, "byte_bpe_50k.tiktoken"), (alignment.piece_side, "piece_bpe_32k.model")))
    got = alignment._align_batch(a, b, [t.encode() for t in texts])
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [(r[0], r[1], r[2], r[6]) for r in reference(texts, libraries)]


@given(st.lists(st.integers(1, 4), min_size=1, max_size=30), st.data())
def test_pointer_jumping_finds_the_common_ends(lengths, data):
    end_a = np.cumsum(lengths)
    cuts = data.draw(st.sets(st.integers(1, int(end_a[-1]))))
    end_b = np.array(sorted(cuts | {int(end_a[-1])}))
    common = np.array(sorted(set(end_a.tolist()) & set(end_b.tolist())))
    label = alignment.group_ends(end_a, end_b)
    assert end_a[label[:len(end_a)]].tolist() == common[np.searchsorted(common, end_a)].tolist()
    assert end_a[label[len(end_a):]].tolist() == common[np.searchsorted(common, end_b)].tolist()


def test_query_equals_brute_force(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [(d.doc_id, *r) for d, r in zip(docs, reference([d.text for d in docs], libraries))]
    assert sorted(as_rows(QUERIES["op11_alignment"](spark, SF))) == sorted(want)


def test_odd_tables(spark, odd_docs, no_docs, libraries):
    rows = odd_docs.collect()
    got = as_rows(alignment.alignment_report(odd_docs))
    want = [(d.doc_id, *r) for d, r in zip(rows, reference([d.text for d in rows], libraries))]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert alignment.alignment_report(no_docs).collect() == []
