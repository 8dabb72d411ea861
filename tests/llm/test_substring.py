import random
from collections import Counter

import pytest

from ontime.llm import substring


def reference(texts, width):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[p:p + width]) for w in words for p in range(len(w) - width + 1))
    out = []
    for w in words:
        covered = [False] * len(w)
        for p in range(len(w) - width + 1):
            if seen[tuple(w[p:p + width])] > 1:
                covered[p:p + width] = [True] * width
        out.append((len(w), sum(covered), b" ".join(x for x, c in zip(w, covered) if not c).decode()))
    return out


def check(spark, texts, width):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring.remove_duplicate_spans(df, width=width).collect()}
    assert [got[i] for i in range(len(texts))] == reference(texts, width)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_with_shared_passages(spark, seed):
    """Few words, so anchors repeat; passages with changed words, so factors end inside blocks."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefghijklmnop") + str(rnd.randrange(30 if seed else 3))
    passages = [[word() for _ in range(rnd.randint(10, 120))] for _ in range(6)]
    texts = []
    for _ in range(60):
        words = []
        for _ in range(rnd.randint(0, 4)):
            words += [word() for _ in range(rnd.randint(0, 30))]
            p = list(rnd.choice(passages))
            if rnd.random() < 0.4:
                p[rnd.randrange(len(p))] = word()
            cut = rnd.randrange(len(p))
            words += p[cut:] if rnd.random() < 0.5 else p[:cut]
        texts.append(" ".join(words))
    check(spark, texts, 12)


def test_repeated_words_and_lengths_at_the_width(spark):
    exact = " ".join(f"w{i}" for i in range(35))
    check(spark, ["x " * 200, "x " * 35, "x " * 36, "y " * 34, exact, exact, exact + " tail", "head " + exact[:-4],
                  None, "", "ab " * 40 + exact], 35)


def test_odd_rows(odd_docs, no_docs):
    got = substring.remove_duplicate_spans(odd_docs, width=12)
    assert set(odd_docs.columns) | {"n_words", "n_removed", "kept_text"} == set(got.columns)
    rows = odd_docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *w) for r, w in zip(rows, reference([r.text for r in rows], 12))), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()), key=str) == want
    assert {r["_row"] for r in got.collect()} == {5}
    assert substring.remove_duplicate_spans(no_docs).count() == 0
    with pytest.raises(ValueError):
        substring.duplicate_spans(no_docs, width=8)
